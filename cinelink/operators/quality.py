"""Checks of the constraints the target tables declare, and the run audit."""

from functools import reduce

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators.dedup import per_source
from cinelink.runtime import hot_keys, lookup_join, skew_join


def duplicate_keys(df, keys):
    """Key values held by more than one row; keys with a null do not count."""
    filled = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing(df, columns):
    """Null count per column that must be filled, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns
    ])).alias("r")).select("r.*")


def beyond(column, low=None, high=None, above=None):
    """Condition: the value is below `low`, over `high` or not over `above`."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    if above is not None:
        bad = bad | (F.col(column) <= above)
    return bad


def out_of_range(df, column, low=None, high=None, above=None):
    return df.where(beyond(column, low, high, above))


def not_in(df, column, values):
    return df.where(~F.col(column).isin(values))


def too_long(df, column, limit):
    return df.where(F.length(column) > limit)


def orphans(child, key, parent, parent_key, hot_rows=None):
    """Child rows whose key names no parent; null keys name none and are fine.

    Parents may have very many children: keys of more than `hot_rows` rows are split.
    """
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return lookup_join(child.where(F.col(key).isNotNull()), known, [key], "left_anti", hot_rows).select(child.columns)


def cascade(child, key, parent, parent_key, hot_rows=None):
    """Child rows left after their parents were deleted."""
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return lookup_join(child.where(F.col(key).isNotNull()), known, [key], "left_semi", hot_rows).select(child.columns)


def detach(child, key, parent, parent_key, hot_rows=None):
    """All child rows; those whose parent was deleted lose the key."""
    known = parent.where(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("known_key")).distinct()
    # Rows without a key meet nothing, wherever they are sent: all of them under one key would be one task.
    spread = F.xxhash64(*[c for c in child.columns if c != key]) if len(child.columns) > 1 else F.lit(0)
    keyed = child.withColumn("known_key", F.col(key)).withColumn("lone_", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)))
    hot = hot_keys(child.where(F.col(key).isNotNull()).select(F.col(key).alias("known_key")), ["known_key"], hot_rows)
    marked = skew_join(keyed, known.withColumns({"lone_": F.lit(0).cast("long"), "held_": F.lit(True)}), ["known_key", "lone_"], "left",
                       None if hot is None else hot.withColumn("lone_", F.lit(0).cast("long")), spread_by=child.columns)
    return marked.select(*[F.when(F.col("held_"), F.col(c)).alias(c) if c == key else F.col(c) for c in child.columns])


def delete_movies(tables, doomed):
    """Delete movies by id: children go with them, log rows stay without the key."""
    movies = tables["movies"].join(doomed.select(F.col("id")).distinct(), "id", "left_anti")
    children = {c: cascade(tables[c], "movie_id", movies, "id") for c in ("movie_genres", "ratings", "rt_details")}
    return {
        **tables, **children, "movies": movies,
        "ingestion_logs": detach(tables["ingestion_logs"], "movie_id", movies, "id"),
    }


def row_rules():
    """Conditions that a single row breaks: {table: {check: condition}}."""
    rules = {
        "movies": {
            "title not null": F.col("title").isNull(),
            "runtime_minutes > 0": beyond("runtime_minutes", above=0),
        },
        "genres": {"name not null": F.col("name").isNull()},
        "ratings": {
            "source not null": F.col("source").isNull(),
            "scale not null": F.col("scale").isNull(),
            "score >= 0": beyond("score", low=0),
            "vote_count >= 0": beyond("vote_count", low=0),
            "source known": ~F.col("source").isin(S.SOURCES),
        },
        "rt_details": {
            "tomatometer_score 0-100": beyond("tomatometer_score", 0, 100),
            "audience_score 0-100": beyond("audience_score", 0, 100),
        },
        "ingestion_logs": {
            "status not null": F.col("status").isNull(),
            "status known": ~F.col("status").isin(S.LOG_STATUS),
        },
    }
    for table, limits in S.MAX_LENGTHS.items():
        for c, n in limits.items():
            rules[table][f"{c} at most {n} long"] = F.length(c) > n
    return rules


def audit(tables):
    """Violations of every declared constraint: (table_name, check_name, violations).

    All rules on single rows of a table are counted in one pass over it.
    """
    m, g, mg, r, d, logs = (tables[n] for n in S.TARGET_TABLES)
    rows = []
    for table, rules in row_rules().items():
        counted = tables[table].agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
        rows.append(counted.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                     F.col(f"`{name}`").alias("violations"))
            for name in rules
        ])).alias("r")).select("r.*"))
    between_rows = [
        ("movies", "unique tmdb_id", duplicate_keys(m, ["tmdb_id"])),
        ("movies", "unique imdb_id", duplicate_keys(m, ["imdb_id"])),
        ("genres", "unique name", duplicate_keys(g, ["name"])),
        ("ratings", "unique movie_id, source", duplicate_keys(r, ["movie_id", "source"])),
        ("rt_details", "unique movie_id", duplicate_keys(d, ["movie_id"])),
        ("movie_genres", "movie exists", orphans(mg, "movie_id", m, "id")),
        ("movie_genres", "genre exists", orphans(mg, "genre_id", g, "id")),
        ("ratings", "movie exists", orphans(r, "movie_id", m, "id")),
        ("rt_details", "movie exists", orphans(d, "movie_id", m, "id")),
        ("ingestion_logs", "movie exists", orphans(logs, "movie_id", m, "id")),
    ]
    rows += [
        df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("check_name"), "violations")
        for t, c, df in between_rows
    ]
    return reduce(lambda a, b: a.union(b), rows)


def run_audit(extracted, loaded, run_id, started, finished):
    """One row per source of a run: extracted, loaded, status, duration, start.

    `extracted` and `loaded` are rows, or their numbers per source as `profile.counted` returns them.
    """
    both = per_source(extracted, "extracted").join(per_source(loaded, "loaded"), "source", "left")
    n = F.coalesce("loaded", F.lit(0))
    return both.select(
        F.lit(run_id).alias("run_id"), "source", "extracted", n.alias("loaded"),
        F.when(n == F.col("extracted"), "success").when(n > 0, "partial").otherwise("error").alias("status"),
        (finished.cast("double") - started.cast("double")).alias("duration_seconds"),
        started.alias("started_at"),
    )
