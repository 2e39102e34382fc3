"""Small helpers that the text operators share."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from cinelink.runtime import materialize

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(column):
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(column):
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def split_words(column, separators):
    """Words between runs of separators; null has none."""
    return F.array_remove(F.split(text_or_empty(column), separators), "")


def let(value, body):
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def group_key(column):
    """A column to group and join by that keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def free_name(columns, name):
    """`name`, or with the first number behind it that no column has; names are compared as Spark does."""
    taken, n, out = {c.lower() for c in columns}, 1, name
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def digest(column):
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(text_or_empty(column)))


def hot_splits(counted, keys, n, rows):
    """Keys of a table of counts that hold more than a thousandth of `rows` rows, and the splits each needs; None without any.

    For `runtime.skew_join`: at most a thousand keys, however large the table.
    """
    limit = max(10_000, rows // 1000)
    hot = counted.where(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / limit).cast("int").alias("splits"))
    return None if hot.isEmpty() else materialize(hot, "hot")


@contextmanager
def arrow_rows(spark, rows):
    """Let Python workers take at most `rows` rows at a time from what is run inside: whole texts are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
