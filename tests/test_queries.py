"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check import compare, connect
from pulse.checks.oracles import ORACLES
from pulse.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry_is_consistent():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, _, problem = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert problem is None
    assert rows > 0


def test_stored_predictions_are_computed_once(spark, monkeypatch):
    from pulse.checks import queries

    plans, write = [], queries.write_predictions

    def seen(best, *more):
        plans.append(best._jdf.queryExecution().executedPlan().toString())
        return write(best, *more)

    monkeypatch.setattr(queries, "write_predictions", seen)
    assert queries.QUERIES["predictions_stored"](spark, SF_DIR).count() > 0
    assert len(plans) == 2 and not any("Generate" in p for p in plans)


def test_crawl_objects_are_bounded(spark, monkeypatch):
    from pulse.checks import queries

    monkeypatch.setattr(queries, "CRAWL_BYTES", 4000)
    rows = [(i, "hot" if i % 3 else None, "x" * 200) for i in range(300)] + [(999, "small", "y"), (None, "small", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    got = queries._crawl_parts(docs)
    assert got.columns == docs.columns + ["part"] and got.count() == len(rows)
    sizes = {(r["source"], r["part"]): r["n"] for r in got.groupBy("source", "part").count().toDF("source", "part", "n").collect()}
    assert max(sizes.values()) <= 20 and sizes["small", 0] == 2
    assert sum(s == "hot" for s, _ in sizes) > 10 and sum(s is None for s, _ in sizes) > 5
