"""Number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels where no rate exists, and the parts of the traffic summary.
LABEL_NONE, LABEL_NEW = "—", "NEW"
THIS_WINDOW, WINDOW_BEFORE, POSTS = "최근10분 ", "직전10분 ", "건"
UNCHANGED, NO_TRAFFIC, NEW_TRAFFIC = "±0", "(변동 없음)", "(신규 유입)"


def share(count: Column, total: Column) -> Column:
    """Part of all posts; 0 when there were none."""
    return F.when(total > 0, count.cast("double") / total).otherwise(F.lit(0.0))


def rate(cur: Column, prev: Column) -> Column:
    """Relative change; null when there is nothing to compare with."""
    return F.when(prev > 0, (cur - prev).cast("double") / prev)


def change_label(count: Column, prev: Column) -> Column:
    """Text shown where no rate exists."""
    return F.when(prev > 0, F.lit(None).cast("string")).when(count == 0, LABEL_NONE).otherwise(LABEL_NEW)


def sigmoid(c: Column) -> Column:
    """``exp`` runs to infinity for very negative input, which gives a clean 0."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def round_exact(c: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as printing to ``digits`` does.

    Spark rounds the printed decimal instead, so 6.25 and 0.00625 go other ways. The
    value times a power of ten is split in two halves that multiply without error
    (Veltkamp), which tells on which side of the midpoint it lies.
    """
    x = c.cast("double")
    scale = 10.0**digits
    big = x * F.lit(134217729.0)
    hi = big - (big - x)
    lo = x - hi
    below = F.floor(x * F.lit(scale)).cast("double")
    twice = F.lit(2.0 * scale)
    off = (hi * twice - (below * F.lit(2.0) + F.lit(1.0))) + lo * twice
    steps = (
        F.when(off > 0, below + F.lit(1.0))
        .when(off < 0, below)
        .otherwise(below + F.abs(below % F.lit(2.0)))
    )
    return F.when(F.abs(x) < F.lit(2.0**40), steps / F.lit(scale)).otherwise(x)


def serve_round(c: Column) -> Column:
    """Four decimals, for values that are shown and not computed with."""
    return round_exact(c, 4)


def plain_double(c: Column) -> Column:
    """Shortest decimal text of a double without an exponent up to 1e16."""
    text = c.cast("string")
    wide = F.regexp_replace(c.cast("decimal(38,12)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(c).between(1e7, 1e16), wide).otherwise(text)


def traffic_text(cur: Column, prev: Column) -> Column:
    """One-line comparison of this window with the one before."""
    delta = cur - prev
    signed = F.when(delta == 0, UNCHANGED).otherwise(
        F.concat(F.when(delta > 0, "+").otherwise(""), delta.cast("string"))
    )
    percent = F.format_string("%.1f", F.abs(round_exact(rate(cur, prev) * F.lit(100.0), 1)))
    note = (
        F.when(
            prev > 0,
            F.concat(F.lit("("), F.when(delta < 0, "-").otherwise("+"), percent, F.lit("%)")),
        )
        .when(cur == 0, NO_TRAFFIC)
        .otherwise(NEW_TRAFFIC)
    )
    return F.concat_ws(
        " ",
        F.concat(F.lit(THIS_WINDOW), cur.cast("string"), F.lit(f"{POSTS} |")),
        F.concat(F.lit(WINDOW_BEFORE), prev.cast("string"), F.lit(f"{POSTS} |")),
        signed,
        note,
    )
