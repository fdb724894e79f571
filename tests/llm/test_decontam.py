import pytest
from brute import contamination
from fixtures import ODD, documents, prose, text_of

from pulse.llm import decontam

ITEM = prose(50, 24)
ITEMS = [
    (1, text_of(ITEM)), (2, text_of(prose(51, 12)).upper()), (3, "w1 w2 w3"), (4, None), (5, ""), (6, "?!"),
    (11, text_of(ITEM[3:20])), (1, text_of(ITEM)), (7, "É a1 b2 c3 d4 e5 f6 g7 h8 i9"),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, words string, n string")


def rows():
    out = [*ODD, (1, text_of(ITEM)), (2, "x " + text_of(ITEM[4:14]).upper() + " y"), (3, text_of(ITEM[4:13]))]
    out += [(4, "w1, w2-w3; w1 w2 w3"), (5, text_of(prose(51, 12) + ITEM + prose(51, 11))), (6, text_of(ITEM) * 30)]
    out += [(8, "é a1 b2 c3 d4 e5 f6 g7 h8 i9"), (9, "É A1 b2 c3 d4 e5 f6 g7 h8 i9 "), (10, text_of(prose(52, 5000)))]
    return out


def result(spark, rows, bench):
    out = decontam.contamination(documents(spark, rows), bench)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("block", [20_000, 5])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(decontam.find_phrases, "__defaults__", (10, None, block))
    assert result(spark, rows(), items(spark)) == sorted(contamination(rows(), ITEMS))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    some = [(1, text_of(ITEM)), (1, text_of(ITEM)), (None, text_of(ITEM)), (2, "clean")]
    got = decontam.contamination(documents(spark, some), items(spark)).collect()
    assert [(r["doc_id"], r["n_hit"]) for r in sorted(got, key=lambda r: r["doc_id"] or 0)] == [
        (None, 24), (1, 24), (1, 24), (2, 0)
    ]
    assert result(spark, [], items(spark)) == []
    assert [r[2] for r in result(spark, some[:1], items(spark, []))] == [0]


def test_proximity(spark):
    near = ITEM[:10]
    near[3:5] = [near[4], "between", near[3]]
    docs = documents(spark, [(1, text_of(ITEM[:10])), (2, text_of(near)), (3, text_of(prose(53, 30)))])
    bench = items(spark, [(1, text_of(ITEM[:10]))])
    _, matches, _ = decontam.find_phrases(docs, bench, slop=1)
    assert sorted((r["doc_id"], r["exact"]) for r in matches.collect()) == [(1, True), (2, False)]
    _, matches, _ = decontam.find_phrases(docs, bench)
    assert [r["doc_id"] for r in matches.collect()] == [1]


def test_no_python_in_the_plan(spark):
    plan = decontam.contamination(documents(spark, rows()), items(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_an_id_are_told_apart_by_their_texts(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = [r["text"] for r in bench.orderBy("item_id").limit(2).collect()]
    some = [(None, bad[0]), (None, bad[0]), (None, bad[1]), (None, "clean text"), (None, None), (1, bad[0]), (1, "clean")]
    docs = documents(spark, some)
    got = decontam.contamination(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"] > 0) for r in got) == sorted(
        (i or 0, t in bad) for i, t in some
    )
    alone = {t: decontam.contamination(documents(spark, [(7, t)]), bench).first()["items_sha256"] for t in bad}
    assert {r["items_sha256"] for r in got if r["n_hit"]} == set(alone.values())
    kept = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, sf_dir).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, ""), (0, "clean text"), (1, "clean")]
