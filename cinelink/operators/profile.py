"""Counts, histograms and column profiles."""

from functools import reduce

from pyspark.sql import Observation, SparkSession, Window
from pyspark.sql import functions as F

from cinelink.functions import numbers
from cinelink.runtime import materialize


def counts_by_source(df):
    """Rows per source and in total (null source)."""
    return df.rollup("source").agg(F.count(F.lit(1)).alias("records"))


def value_counts(df, column):
    """Rows per value, most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column)


def stage_metrics(stages):
    """Rows before, after and removed per step of an ordered {stage: rows}.

    A stage is a DataFrame, which is counted, or the number of its rows where that is known
    from the time it was stored (`counted`).
    """
    spark = SparkSession.active()
    known = spark.createDataFrame(
        [(i, name, n) for i, (name, n) in enumerate(stages.items()) if isinstance(n, int)], "step int, stage string, after long")
    rows = reduce(lambda a, b: a.union(b), [known, *[
        df.agg(F.count(F.lit(1)).alias("after")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "after")
        for i, (name, df) in enumerate(stages.items()) if not isinstance(df, int)
    ]])
    before = rows.select((F.col("step") + 1).alias("step"), F.col("after").alias("before"))
    return rows.join(before, "step", "left").select(
        "step", "stage", F.coalesce("before", "after").alias("before"), "after",
        (F.coalesce("before", "after") - F.col("after")).alias("removed"),
    )


def counted(df, label, sources=()):
    """Store `df` and return (stored, rows, rows per source): rows are counted while they are written.

    `sources` are the labels to expect; rows with another one are counted in a second pass,
    which takes place only if there are any.
    """
    seen = Observation()
    n = F.count(F.lit(1)).alias("rows")
    stored = materialize(df.observe(seen, n, *[
        F.count_if(F.col("source") == name).alias(f"source {i}") for i, name in enumerate(sources)]), label)
    found = seen.get
    rows, each = found.get("rows", 0), {name: found.get(f"source {i}", 0) for i, name in enumerate(sources)}
    if sources and sum(each.values()) < rows:
        each = {r["source"]: r["count"] for r in stored.groupBy("source").count().collect()}
    return stored, rows, each


def histogram(df, column, bins=8):
    """Rows per bin of equal width between minimum and maximum, empty bins included."""
    value = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    low, high = value.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    counted = value.groupBy(
        numbers.width_bin(F.col(column).cast("double"), F.lit(low), F.lit(high), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", (low + (F.col("bin") - 1) * width).alias("bin_low"),
        (low + F.col("bin") * width).alias("bin_high"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def films_per_decade(df, date="release_date"):
    decade = numbers.decade(F.year(date)).alias("decade")
    return df.where(F.col(date).isNotNull()).groupBy(decade).agg(F.count(F.lit(1)).alias("n")).orderBy("decade")


def value_ranks(df, columns):
    """Stored (column_name, v, n, part): how often each value of numeric columns occurs, sorted within `part`.

    Counting combines map-side, so a value that most rows hold is one row per task and one
    row here. Parts are ranges of (column, value), in order.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("p")).select("p.*").where("v is not null")
    counted = pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    ranges = counted.repartitionByRange("column_name", "v").sortWithinPartitions("column_name", "v")
    return materialize(ranges.withColumn("part", F.spark_partition_id()), "ranked")


def quantiles(df, columns, points):
    """Exact quantiles, linear between neighbours, as {column: {point: value}}; one pass for all columns.

    Ranks are running sums over the distinct values: sums of parts are added up on the
    driver, one row per part and column, and the values inside a part where they are asked for.
    """
    ranked = value_ranks(df, columns)
    sizes = {c: [] for c in columns}
    for r in ranked.groupBy("column_name", "part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        sizes[r["column_name"]].append((r["part"], r["n"]))
    wanted, places = {}, {}
    for c in columns:
        total = sum(n for _, n in sizes[c])
        for p in points if total else ():
            at = p * (total - 1)
            wanted[c, p] = (int(at), min(int(at) + 1, total - 1), at - int(at))
            for rank in wanted[c, p][:2]:
                before = 0
                for part, n in sizes[c]:
                    if rank < before + n:
                        places[c, rank] = (part, rank - before)
                        break
                    before += n
    value = {}
    if places:
        asked = df.sparkSession.createDataFrame(
            [(c, part, inside, rank) for (c, rank), (part, inside) in places.items()],
            "column_name string, part int, inside long, rank long")
        running = Window.partitionBy("column_name", "part").orderBy("v")
        ends = ranked.join(asked.select("column_name", "part").distinct(), ["column_name", "part"], "left_semi").withColumn(
            "end", F.sum("n").over(running))
        found = ends.join(asked, ["column_name", "part"]).where("inside < end and inside >= end - n")
        value = {(r["column_name"], r["rank"]): r["v"] for r in found.select("column_name", "rank", "v").collect()}
    out = {c: dict.fromkeys(points) for c in columns}
    for (c, p), (low, high, share) in wanted.items():
        out[c][p] = value[c, low] + (value[c, high] - value[c, low]) * share if share else value[c, low]
    return out


def describe_numbers(df, columns):
    """count, mean, std, min, quartiles and max per numeric column."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[
        F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f in stats.items()]).alias(c) for c in columns
    ])
    points = quantiles(df, columns, (0.25, 0.5, 0.75))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"{c}.{n}").alias(n) for n in stats],
            *[F.lit(v).cast("double").alias(n) for n, v in zip(("q25", "q50", "q75"), points[c].values())],
        )
        for c in columns
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def describe_text(df, columns):
    """count, distinct values, most frequent value (ties: smallest) and its frequency."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns
    ])).alias("p")).select("p.*").where("v is not null")
    per_value = pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top"), F.max("n").alias("freq"),
    )


def preview(df, column, n=15):
    """The first rows in the order of a column."""
    return df.orderBy(column).limit(n)
