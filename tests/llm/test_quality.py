from brute import quality as brute
from fixtures import ODD, documents, prose, text_of

from pulse.llm import quality

REPEATED = "a b c d\n" * 20
TEXTS = [
    (1, text_of(prose(1, 80))), (2, REPEATED), (3, "x # y $$ <z>\n\nx # y\nx # y\n \n"), (4, "a b a b a b c"),
    (5, text_of(prose(2, 3000))), (6, "é b 漢 🙂 " * 30), *ODD,
]


def test_counts_equal_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[2:8] for r in quality.measure(documents(spark, TEXTS)).collect()}
    assert got == {i: brute(t) for i, t in TEXTS}


def test_hosts(spark):
    good, bad = text_of(prose(3, 60)), "bad"
    rows = [(i, bad if i % 10 else good, "spam") for i in range(100)]
    rows += [(100 + i, good if i % 10 else bad, f"host{i % 5}") for i in range(100)]
    rows += [(200, bad, "tiny"), (201, good, None), (202, None, None)]
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, rows)).collect()}
    assert not any(got[i]["kept"] for i in range(100))  # a rejected host takes its good pages along
    assert all(got[100 + i]["kept"] == bool(i % 10) for i in range(0, 100, 1) if i % 10)
    # one bad page of one: the rate is drawn to that of the other hosts
    assert got[200]["host_rate"] < 1 and got[201]["base_failed"] is False and got[202]["base_failed"]
    n, f = [100, *[20] * 5, 1, 2], [90, 10, 0, 0, 0, 0, 1, 1]
    f[1:6] = [sum(1 for i in range(100) if i % 10 == 0 and i % 5 == h) for h in range(5)]
    rates = [a / b for a, b in zip(f, n, strict=True)]
    m = sum(rates) / len(rates)
    v = sum((r - m) ** 2 for r in rates) / len(rates)
    k = max(m * (1 - m) / v - 1, 0)
    assert abs(got[0]["host_rate"] - (90 + m * k) / (100 + k)) < 1e-12


def test_no_variance_empty_table_and_repeated_rows(spark):
    good = text_of(prose(3, 60))
    got = quality.judge(documents(spark, [(1, good), (1, good), (None, good)])).collect()
    assert [r["kept"] for r in got] == [True] * 3
    assert quality.judge(documents(spark, [])).collect() == []
