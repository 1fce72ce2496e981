"""Tables of tokens (a row for each, by sentence and place) to sentences, and to rows of what is read from their trees."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scriptorium.functions.syntax import Sentence, Token

FIELDS = ("i", "text", "idx", "lemma", "pos", "dep", "head", "space")


def sentence_of(tokens: list[dict]) -> Sentence:
    """Tokens in order of place to a tree; the text is made of them again."""
    made = [Token(t["i"], t["text"], t["idx"], t["lemma"], t["pos"], "", t["dep"], t["head"], t["space"]) for t in tokens]
    text = "".join(t.text + " " * t.space for t in made)
    return Sentence(text.rstrip(), made)


def read_trees(tokens: DataFrame, key: str, read: Callable[[Sentence], list[tuple]], schema: str) -> DataFrame:
    """A row (key, and what ``schema`` says) for each tuple that ``read`` gives of a sentence."""
    whole = tokens.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*FIELDS))).alias("tokens"))
    kind = StructType([tokens.schema[key], *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            rows = [(k, *r) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in read(sentence_of(t))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(arrow), arrow, strict=True)], schema=arrow)

    return whole.select(key, "tokens").mapInArrow(run, kind)
