"""Load splits of enriched records into index tables: ``python -m scriptorium.plans.load publication concept --source ... --root ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from scriptorium.operators import indexing


def main(args: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser()
    parser.add_argument("indices", nargs="+", help=f"of {', '.join(indexing.INDICES)}")
    parser.add_argument("--source", required=True, help="what the names of the splits' folders or files begin with")
    parser.add_argument("--root", required=True, help="where the indices are")
    parser.add_argument("--replace", action="store_true", help="begin the indices anew")
    a = parser.parse_args(args)
    counts = indexing.load(SparkSession.builder.getOrCreate(), a.source, a.root, a.indices, a.replace)
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main()
