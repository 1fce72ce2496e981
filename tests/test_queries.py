"""Every query with SQL gives the same rows in Spark and in DuckDB; the others run."""

import glob
import os
from collections import Counter

import __spark_entry__ as entry
import duckdb
import pytest
from tests.conftest import SMALL

from scriptorium.operators import relational
from scriptorium.plans import queries_more  # noqa: F401
from scriptorium.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    con.execute("SET TimeZone = 'UTC'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    columns = sorted(x[0] for x in cursor.description)
    at = [[x[0] for x in cursor.description].index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert sorted(df.columns) == columns
    got = Counter(tuple(plain(x) for x in r) for r in df.select(*columns).collect())
    assert sum(want.values()) > 0
    assert sum((want - got).values()) == 0 and sum((got - want).values()) == 0, (list((want - got).items())[:3], list((got - want).items())[:3])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_concepts_of_collapsed_trees(spark):
    """By hand, from the sentences' trees."""
    winter, bees = "that salt reduces the yield of winter wheat", "never harm fruit trees"
    want = {(1, "Strong tea", "prevent", "dull headaches", False, None), (1, "Strong tea", "prevent", "morning fatigue", False, None), (2, "Long night shifts", "improve", "sleep quality", True, None)}
    want |= {(3, s, "say reduces", o, False, winter) for s in ("salt", "Growers") for o in ("yield", "winter wheat")}
    want |= {(4, "filter", "remove from", o, True, None) for o in ("fine dust", "city air")} | {(5, "valve", "replaced by", "steel part", False, None)}
    want |= {(7, "Bees", "visit", "flowers", False, None), (7, "Bees", "visit harm", "fruit trees", True, bees)}
    assert Counter(map(tuple, QUERIES["tree_collapsed_concepts"](spark, SMALL).collect())) == Counter(want)


def test_upsert_meets_updates(spark, monkeypatch):
    """All events come either as the index or as its updates, and updates overwrite rows of the index."""
    seen, upsert = [], relational.upsert
    monkeypatch.setattr(relational, "upsert", lambda *a: seen.append(a) or upsert(*a))
    out = QUERIES["index_upsert"](spark, SMALL)
    target, updates, key, order = seen[0]
    assert target.count() + updates.count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
    newer = out.join(updates, [key, order], "left_semi").join(target, key, "left_semi").count()
    assert 0 < newer < out.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
