"""Every query with SQL against DuckDB on the smallest tables, and each alignment branch."""

import math
import os

import duckdb
import pytest

from tessitura.plans import queries as q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    def plain(x):
        if x is None or x != x:
            return None
        return round(float(x), 9) if isinstance(x, float) and math.isfinite(x) else str(x)

    names = sorted(frame.columns)
    return sorted(repr([plain(x) for x in r]) for r in frame[names].astype(object).where(frame[names].notna(), None).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query(spark, duck, name):
    assert rows(q.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(q.ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE)))
def test_rows(spark, name):
    assert q.QUERIES[name](spark, SF).count() > 0


def test_every_alignment_branch(spark):
    inside = q.intervals.align(q.event_lines(spark, SF), q.segments(spark, SF), mode="contains").where("speaker <> '[unknown]'").count()
    labeled = q.intervals.align(q.event_lines(spark, SF), q.segments(spark, SF)).where("speaker <> '[unknown]'").count()
    every = q.event_lines(spark, SF).count()
    assert every == 1100 and all(n > 20 for n in (inside, labeled - inside, every - labeled))
