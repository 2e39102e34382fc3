"""Conversions that yield null instead of failing, and score rules."""

from pyspark.sql import functions as F

# Score ranges.
TEN_POINT = (0.0, 10.0)
PERCENT = (0.0, 100.0)


def safe_double(col):
    text = F.trim(col.cast("string"))
    # The JVM also reads '1.5d' and '1.5f'; those are not numbers here.
    return F.when(~text.rlike("[0-9.][dDfF]$"), text.try_cast("double"))


def safe_long(col):
    """Through double, truncating towards zero; NaN and infinities become null."""
    return safe_double(col).try_cast("bigint")


def strict_long(col):
    """Whole-number text only."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def clamp(col, bounds):
    """The value when it lies in the range, else null (NaN is outside)."""
    low, high = bounds
    return F.when((col >= low) & (col <= high) & ~F.isnan(col), col)


def score_from_text(col):
    """'85%' or '8.5' to a number: keep digits and dots."""
    return F.regexp_replace(col, r"[^0-9.]", "").try_cast("double")


def year_from_text(col):
    return F.regexp_replace(col, r"[^0-9]", "").try_cast("int")


def rating_score(vote_average, tomatometer):
    """Average vote, or the tomatometer when the vote is missing or zero."""
    return F.coalesce(F.when(vote_average != 0, vote_average), tomatometer)


def rating_scale(vote_average, tomatometer, source):
    """Scale of the field the score was taken from, else of the source."""
    return (
        F.when(vote_average != 0, "0-10")
        .when(tomatometer.isNotNull() | (source == "rotten_tomatoes"), "0-100")
        .otherwise("0-10")
    )


def decade(year):
    return (F.floor(year / 10) * 10).cast("int")


def width_bin(col, low, high, bins):
    """1-based bin of equal width; the maximum belongs to the last bin."""
    return F.least(F.width_bucket(col, low, high, F.lit(bins)), F.lit(bins)).cast("int")
