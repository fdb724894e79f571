"""The registered queries against SQL, and the pipeline stage by stage against brute force."""

import re

import brute
import pytest
from fixtures import documents, mixed_rows, prose, text_of

import corpus_pipeline
from check import compare, connect
from pulse.llm.oracles import ORACLES
from pulse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, _, problem = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert problem is None
    assert rows > 0


def test_every_number_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_stages_against_brute_force(spark):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    rows = [*mixed_rows(), (700, text_of(prose(3, 60)) + bench[0]["text"]), (701, text_of(prose(4, 90)) + " token=abcdefgh1")]
    docs = documents(spark, rows)
    left = dict(rows)
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality rules"](spark, docs, SF_DIR)
    failed = {i: brute.quality(t)[-1] for i, t in left.items()}
    assert sum(failed.values()) / len(failed) < 0.5  # the one host stays
    left = {i: t for i, t in left.items() if not failed[i]}
    assert {r["doc_id"] for r in docs.collect()} == set(left)

    docs = stages["near-duplicate removal"](spark, docs, SF_DIR)
    group = brute.groups(list(left.items()))
    left = {i: t for i, t in left.items() if group[i] == i}
    assert {r["doc_id"] for r in docs.collect()} == set(left)

    docs = stages["benchmark decontamination"](spark, docs, SF_DIR)
    hit = {r[0] for r in brute.contamination(left.items(), [(b["item_id"], b["text"]) for b in bench]) if r[-1]}
    assert 700 in hit
    left = {i: t for i, t in left.items() if i not in hit}
    assert {r["doc_id"] for r in docs.collect()} == set(left)

    columns = docs.columns
    docs = stages["secret redaction"](spark, docs, SF_DIR)
    assert docs.columns == columns
    got = {r["doc_id"]: r for r in docs.collect()}
    assert set(got) == set(left) and got[701]["text"].endswith(" [SECRET]")
    assert all(got[i]["text"] == left[i] for i in left if i != 701)
    assert got[701]["n_chars"] == len(got[701]["text"])

    packed = stages["best-fit packing"](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_stages_take_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(None, text_of(prose(1, 60))), (None, None), (1, text_of(prose(2, 70))), (1, text_of(prose(2, 70)))]
    for table in (rows, []):
        docs = documents(spark, table)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        assert len(docs.collect()) == (3 if table else 0)


def test_documents_without_an_id_of_their_own_get_their_own_verdicts(spark):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()
    good = [text_of(prose(100 + i, 80), i) for i in range(12)]
    rows = [(i, good[i]) for i in range(4)]
    rows += [(None, t) for t in good[3:8]]  # the first is a copy of document 3
    rows += [(None, good[4]), (None, "short"), (None, None), (None, good[8] + bench["text"])]
    rows += [(50, good[9]), (50, good[10]), (50, "short"), (50, good[9]), (2, good[2])]
    docs = documents(spark, rows).withColumnsRenamed({"id": "given_id", "key": "bad_id", "doc": "kept_id", "blob": "found_blob"})
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    left = []
    for name in list(stages)[:-1]:
        docs = stages[name](spark, docs, SF_DIR)
        assert docs.columns == columns
        left.append(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr))
    by_key = lambda rows: sorted(rows, key=repr)
    after_rules = [r for r in rows if r[1] not in ("short", None)]
    assert left[0] == by_key(after_rules)
    once = [r for r in after_rules if r[0] is not None]
    once += [(None, t) for t in good[4:8]] + [(None, good[4])]  # equal rows stay together
    once += [(None, good[8] + bench["text"])]
    assert left[1] == by_key(once)
    assert left[2] == left[3] == by_key(r for r in once if r[1] != good[8] + bench["text"])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 50
