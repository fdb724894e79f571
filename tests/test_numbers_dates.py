import random
from datetime import date, datetime

from pyspark.sql import functions as F

from pulse.functions import dates as d
from pulse.functions import numbers as n

X = F.col("x")


def test_rounding_is_that_of_the_exact_value(column):
    rng = random.Random(3)
    values = [0.03125, 0.00625, 0.12335, 0.12345, 1.00005, 2.5, -0.03125, -0.00625, 0.0, 1e-9, 12345.67895]
    values += [a / b for a, b in ((rng.randint(-9999, 9999), rng.randint(1, 20000)) for _ in range(2000))]
    values += [rng.randint(1, 99999) / 20000 for _ in range(2000)]
    assert column(values, n.serve_round(X), "double") == [round(v, 4) for v in values]
    assert column(values, n.round_exact(X, 1), "double") == [round(v, 1) for v in values]
    assert column([None], n.serve_round(X), "double") == [None]


def model_summary(cur, prev):
    delta = cur - prev
    sign = f"+{delta}" if delta > 0 else str(delta) if delta < 0 else "±0"
    if prev > 0:
        note = f"({delta / prev * 100.0:+.1f}%)"
    else:
        note = "(변동 없음)" if cur == 0 else "(신규 유입)"
    return f"최근10분 {cur}건 | 직전10분 {prev}건 | {sign} {note}"


def test_traffic_text(spark):
    pairs = [(0, 0), (5, 0), (5, 5), (17, 16), (15, 16), (1, 3), (0, 7), (1000, 1), (1999, 2000), (2001, 2000)]
    pairs += [(a, b) for a in range(0, 40, 3) for b in range(0, 40, 3)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, c bigint, p bigint")
    got = df.select("i", n.traffic_text(F.col("c"), F.col("p")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [model_summary(*p) for p in pairs]


def test_sigmoid_and_clip_at_the_ends(column):
    got = column([-800.0, 0.0, 800.0], n.sigmoid(X), "double")
    assert got == [0.0, 0.5, 1.0]
    assert column([-9.0, 1.5, 9.0], n.clip(X, -3.0, 6.0), "double") == [-3.0, 1.5, 6.0]


def test_share_and_rate_without_base(spark):
    df = spark.createDataFrame([(3, 0), (3, 4)], "a bigint, b bigint")
    got = df.select(
        n.share(F.col("a"), F.col("b")), n.rate(F.col("a"), F.col("b")),
        n.change_label(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in got] == [(0.0, None, "NEW"), (0.75, -0.25, None)]
    none = spark.createDataFrame([(0, 0)], "a bigint, b bigint")
    assert none.select(n.change_label(F.col("a"), F.col("b"))).first()[0] == "—"


def test_score_text_has_no_exponent(column):
    values = [12.5, 1e7, 12345678.25, 0.001, 99999999999.0, 3.0]
    assert column(values, n.plain_double(X), "double") == [str(v) for v in values]


def test_postdates(column):
    values = ["20240107", "2024-01-07", "2024-1-7", "202417", "20240230", "junk", "", None, "2024-01-07T00"]
    assert column(values, d.parse_postdate(X)) == [
        date(2024, 1, 7), date(2024, 1, 7), date(2024, 1, 7), date(2024, 1, 7), None, None, None, None, None
    ]
    assert column(values, d.clean_postdate(X)) == [
        "2024-01-07", "2024-01-07", "2024-1-7", "2024-01-07", "20240230", "junk", "", None, "2024-01-07T00"
    ]
    assert column(["20249999", "2024", None], d.iso_postdate(X)) == ["2024-99-99", "2024", None]


def test_discovery_times_keep_the_instant(column):
    values = ["2024-01-07T10:00:00Z", "2024-01-07T10:00:00+09:00", "2024-01-07T10:00:00.5", "yesterday", "", None]
    assert column(values, d.iso_z(d.parse_discovered_at(X))) == [
        "2024-01-07T10:00:00Z", "2024-01-07T01:00:00Z", "2024-01-07T10:00:00Z", None, None, None
    ]


def test_local_date_crosses_midnight(column):
    at = [datetime(2024, 1, 6, 20), datetime(2024, 1, 6, 14, 59)]
    expr = d.local_date(F.timestamp_seconds(X), "Asia/Seoul")
    seconds = [int((a - datetime(1970, 1, 1)).total_seconds()) for a in at]
    assert column(seconds, expr, "bigint") == [date(2024, 1, 7), date(2024, 1, 6)]
