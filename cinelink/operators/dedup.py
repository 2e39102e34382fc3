"""De-duplication inside one source."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text
from cinelink.runtime import materialize


def keep_first(df, keys, order="seq"):
    """The row with the smallest order per key (null keys count as equal).

    An aggregate instead of a window: copies shrink to one row before the shuffle,
    however many share a key.
    """
    row = F.struct(*[c for c in df.columns if c not in keys])
    first = df.groupBy(*keys).agg(F.min_by(row, order).alias("row"))
    return first.select(*[
        F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns
    ])


def keep_best(df, keys, score, order):
    """The row with the highest score per key, ties to the smallest order.

    Adds `first_seen`, the smallest order among all rows of the key.
    """
    row = F.struct(*[c for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(
        F.min_by(row, F.struct(-score, F.col(order))).alias("row"),
        F.min(order).alias("first_seen"),
    )
    return best.select(*[
        F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns
    ], "first_seen")


def uncovered_ids(survivors, covering, by=(), how="left_anti"):
    """Survivors keyed by imdb_id that no id-keyed survivor covers; with "left_semi" the covered ones."""
    covered = covering.where("imdb_id is not null").select(*by, "imdb_id").distinct()
    return survivors.join(covered, [*by, "imdb_id"], how).select(survivors.columns)


def uncovered_titles(survivors, covering, by=(), how="left_anti"):
    """Survivors whose (title_norm, year) nothing else covers, nulls being equal; with "left_semi" the covered ones."""
    keys = [*by, "title_norm", "year"]
    covered = covering.select(*[F.col(k).alias(f"covered_{k}") for k in keys]).distinct()
    same = [survivors[k].eqNullSafe(F.col(f"covered_{k}")) for k in keys]
    return survivors.join(covered, same, how)


# What decides which rows are copies and which of them survives.
DECIDING = ["source", "seq", "tmdb_id", "imdb_id", "title_norm", "year"]


def deduplicate(df, columns=None):
    """Per source: by tmdb_id, else imdb_id, else (title_norm, year).

    The most complete row of a key survives, the earliest among equals. Adds `pos`,
    the position of the survivor in the priority order of all sources: source rank,
    tier, and the first sighting of the key. The survivors of each key are stored
    once, since the three tiers are read several times to cover one another.

    `columns`: those wanted besides `DECIDING` and `pos`, all by default. What nobody asks
    for is neither computed beyond whether it is null nor sorted, moved and stored.
    """
    tier = (
        F.when(F.col("tmdb_id").isNotNull(), 1).when(F.col("imdb_id").isNotNull(), 2).otherwise(3)
    )
    df = df.withColumns({
        "tier": tier, "year": F.year("release_date"), "filled_": text.completeness(S.COMPLETENESS_FIELDS)})
    if columns is not None:
        df = df.select(*dict.fromkeys([*DECIDING, *columns]), "tier", "filled_")
    # Only the identifier that decides takes part in the key.
    key = {
        "key_tmdb": F.when(F.col("tier") == 1, F.col("tmdb_id")),
        "key_imdb": F.when(F.col("tier") == 2, F.col("imdb_id")),
        "key_title": F.when(F.col("tier") == 3, F.col("title_norm")),
        "key_year": F.when(F.col("tier") == 3, F.col("year")),
    }
    best = keep_best(
        df.withColumns(key), ["source", "tier", *key], F.col("filled_"), "seq"
    ).drop(*key, "filled_")
    best = best.withColumn(
        "pos",
        F.struct(
            S.source_priority(F.col("source")).alias("priority"), F.col("tier").alias("tier"),
            F.col("first_seen.a").alias("a"), F.col("first_seen.b").alias("b"),
            F.col("first_seen.c").alias("c"),
        ),
    ).drop("first_seen")
    best = materialize(best, "survivors")
    # The tiers cover one another by their keys alone. What is covered is stored and left out
    # wherever the survivors are read: while it is small, whole rows don't move at all.
    keys = best.select("pos", "source", "tier", "imdb_id", "title_norm", "year")
    by_tmdb, by_imdb, by_title = (keys.where(F.col("tier") == n) for n in (1, 2, 3))
    by_id = by_tmdb.unionByName(uncovered_ids(by_imdb, by_tmdb, ["source"]))
    covered = uncovered_ids(by_imdb, by_tmdb, ["source"], "left_semi").unionByName(
        uncovered_titles(by_title, by_id, ["source"], "left_semi"))
    covered = materialize(covered.select(F.col("source").alias("covered_source"), F.col("pos").alias("covered")), "covered")
    # Unknown sources share a priority, so `pos` alone may name two of their rows.
    same = [best["pos"] == F.col("covered"), best["source"].eqNullSafe(F.col("covered_source"))]
    return best.join(covered, same, "left_anti").drop("tier")


def per_source(rows, name):
    """(source, `name`): rows per source. `rows` may be such numbers already, as a dict; sources without rows are left out."""
    if isinstance(rows, dict):
        known = [(source, n) for source, n in rows.items() if n]
        return SparkSession.active().createDataFrame(known, f"source string, {name} long")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias(name))


def removed_counts(before, after):
    """Rows per source before and after, and how many were removed. Takes rows, or their numbers per source."""
    both = per_source(before, "before").join(per_source(after, "after"), "source", "left")
    return both.select(
        "source", "before", F.coalesce("after", F.lit(0)).alias("after"),
        (F.col("before") - F.coalesce("after", F.lit(0))).alias("removed"),
    )
