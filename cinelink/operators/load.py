"""Gold entities to six related tables, repeatable without duplicates.

Tables are immutable snapshots: every operator takes the existing snapshot and
returns the next one. Write it to a new folder (`write_snapshot`), never over the
one being read; or keep the tables in `snapshots.Snapshots`, where a load rewrites only
the buckets that it touches.
"""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import numbers
from cinelink.runtime import hot_among, hot_keys, lookup_join, materialize, skew_join, together

MOVIE_FIELDS = [
    "tmdb_id", "imdb_id", "title", "original_title", "overview", "release_date", "runtime_minutes",
    "poster_path", "budget", "revenue", "popularity", "sources",
]

# What the six tables take from a row besides its movie; `id` only until the movie is known.
ROW_FIELDS = list(dict.fromkeys([
    "nr", "id", *MOVIE_FIELDS, "source", "genres", "vote_average", "vote_count", "tomatometer_score",
    "audience_score", "critics_consensus",
]))

# Fixed value: error messages are cut at this length.
MESSAGE_LENGTH = 500


def last_filled(name, order):
    """The last non-null value of a column in load order."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)


def title_or_unknown(title):
    return F.coalesce(F.nullif(title, F.lit("")), F.lit("Unknown"))


def movie_rows(gold):
    """Gold entities as rows of the movies table, in load order `nr`.

    `id` is the surrogate key an entity gets when it is new: a digest of its natural
    key, so a repeated load or a retried task arrives at the same key.
    """
    natural = F.coalesce(
        F.concat(F.lit("tmdb:"), F.col("tmdb_id").cast("string")),
        F.concat(F.lit("imdb:"), F.col("imdb_id")),
        F.to_json(F.struct("title_norm", "year"), {"ignoreNullFields": "false"}),
    )
    return gold.withColumns({
        "id": F.sha2(natural, 256),
        "nr": F.struct("tier", "pos"),
        "title": title_or_unknown(F.col("title")),
        "contributors": F.col("sources"),
        "sources": F.array_join("sources", ","),
    })


def rejections(rows):
    """Why a row cannot be loaded, as an array of messages (empty when it can)."""
    def message(bad, text):
        return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))

    checks = [
        message(F.col("runtime_minutes") <= 0, "runtime_minutes must be positive"),
        message(numbers.rating_score(F.col("vote_average"), F.col("tomatometer_score")) < 0, "score must not be negative"),
        message(~F.col("tomatometer_score").between(0, 100), "tomatometer_score out of range"),
        message(~F.col("audience_score").between(0, 100), "audience_score out of range"),
    ]
    checks += [
        message(F.length(c) > n, f"{c} longer than {n}") for c, n in S.MAX_LENGTHS["movies"].items()
    ]
    checks.append(message(
        F.exists("genres", lambda g: F.length(g) > S.MAX_LENGTHS["genres"]["name"]),
        "genre name too long",
    ))
    return F.array_compact(F.array(*checks))


def cut_message(message):
    """An error message as the log takes it."""
    return F.left(message, F.lit(MESSAGE_LENGTH))


def split_rejected(rows, label=None):
    """Rows that can be loaded, and rejected rows with their `error_message`.

    With a `label` the judged rows are stored under it, so that both parts follow from one pass over `rows`.
    """
    judged = rows.withColumn("reasons", rejections(rows))
    if label is not None:
        judged = materialize(judged, label)
    good = judged.where("size(reasons) = 0").drop("reasons")
    bad = judged.where("size(reasons) > 0").withColumn(
        "error_message", cut_message(F.array_join("reasons", "; ")))
    return good, bad.drop("reasons")


def judged_rows(gold):
    """Rows that can be loaded, and rejected ones, judged once; without what no table takes, which would move with them."""
    return split_rejected(movie_rows(gold).select(ROW_FIELDS), "rows")


def with_movies(rows, ids):
    """The rows with the movie each writes to, stored; the key a new one would get has served by then."""
    return materialize(rows.drop("id").join(ids, "nr"), "loaded")


def _shared(rows, key):
    """Key values that more than one row holds: (key, first, n), the first of the rows and their number; stored."""
    held = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("nr").alias("first"), F.count(F.lit(1)).alias("n"))
    return materialize(held.where("n > 1"), "shared")


def _first_of(rows, key, n, shared, hot_rows=None):
    """Each row with a key value to the first row holding it, if that is another: (nr, first)."""
    keyed = rows.where(F.col(key).isNotNull()).select("nr", key)
    linked = skew_join(keyed, shared.drop("n"), [key], "inner", hot_among(shared.drop("first"), hot_rows, at_most=n), spread_by=["nr"])
    return linked.where("first < nr").select("nr", "first")


def existing_ids(rows, movies, shared):
    """The stored movie each row denotes: by tmdb_id, else by imdb_id. (nr, by, movie_id)

    `movies` is the stored table, or the holders of each identifier as {name: (identifier, id)};
    `shared` holds what `_shared` returns by identifier.
    """
    found, n = None, rows.count()
    for by in ("tmdb_id", "imdb_id"):
        keyed = rows.where(F.col(by).isNotNull()).select("nr", by)
        held = movies[by] if isinstance(movies, dict) else movies
        stored = held.where(F.col(by).isNotNull()).groupBy(by).agg(F.min("id").alias("movie_id"))
        hit = skew_join(keyed, stored, [by], "inner", hot_among(shared[by].drop("first"), at_most=n), spread_by=["nr"])
        hit = hit.select("nr", F.lit(by).alias("by"), "movie_id")
        found = hit if found is None else found.union(hit.join(found.select("nr"), "nr", "left_anti"))
    return found


def target_ids(rows, movies, max_rounds=60, hot_rows=None):
    """The movie id each row writes to: (nr, movie_id).

    In order of precedence: the stored movie with its tmdb_id, the movie of an
    earlier row with the same tmdb_id, then the same two for imdb_id, else a new
    movie. Rows that lean on one another are resolved by doubling the step, so a
    chain of n rows takes log n rounds. A row that more than `hot_rows` others lean on is
    split, in every round.
    """
    rows = materialize(rows.select("nr", "id", "tmdb_id", "imdb_id"), "keys")
    shared = dict(zip(("tmdb_id", "imdb_id"), together(lambda: _shared(rows, "tmdb_id"), lambda: _shared(rows, "imdb_id"))))
    stored = materialize(existing_ids(rows, movies, shared), "stored")
    by_tmdb = stored.where("by = 'tmdb_id'").select("nr", "movie_id")
    by_imdb = stored.where("by = 'imdb_id'").select("nr", "movie_id")
    n = rows.count()
    leans = _first_of(rows, "tmdb_id", n, shared["tmdb_id"], hot_rows).join(by_tmdb, "nr", "left_anti")
    settled = stored.select("nr").union(leans.select("nr"))
    leans = leans.union(_first_of(rows, "imdb_id", n, shared["imdb_id"], hot_rows).join(settled, "nr", "left_anti"))
    leans = materialize(leans, "leans")
    # A row leaning on an earlier one by tmdb_id does so before its stored imdb_id counts.
    own = by_tmdb.union(by_imdb.join(leans.select("nr"), "nr", "left_anti"))
    roots = rows.select("nr", "id").join(leans.select("nr"), "nr", "left_anti").join(own, "nr", "left").select(
        "nr", F.coalesce("movie_id", "id").alias("movie_id"))
    if leans.isEmpty():
        return roots
    for _ in range(max_rounds):
        step = leans.select(F.col("nr").alias("first"), F.col("first").alias("next"))
        hot = hot_keys(leans, ["first"], hot_rows, at_most=n)
        jumped = materialize(skew_join(leans, step, ["first"], "left", hot, spread_by=["nr"]), "leans")
        if jumped.where("next is not null").isEmpty():
            break
        leans = jumped.select("nr", F.coalesce("next", "first").alias("first"))
    else:
        raise RuntimeError("rows leaning on one another did not settle")
    rest = skew_join(leans, roots.withColumnRenamed("nr", "first"), ["first"], "inner", hot, spread_by=["nr"]).select("nr", "movie_id")
    return roots.union(rest)


def upsert(existing, incoming, keys, filled, replaced=(), inserted=()):
    """Next snapshot of a keyed table.

    `filled` columns change only to non-null values, `replaced` ones also to null,
    `inserted` ones are set when the key is new.
    """
    new = incoming.select(*keys, *[
        F.col(c).alias(f"new_{c}") for c in (*filled, *replaced, *inserted)
    ], F.lit(True).alias("is_new"))
    old = existing.withColumn("is_old", F.lit(True))
    both = old.join(new, list(keys), "full")
    out = []
    for c in existing.columns:
        if c in filled:
            out.append(F.coalesce(f"new_{c}", c).alias(c))
        elif c in replaced:
            out.append(F.when(F.col("is_new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in inserted:
            out.append(F.when(F.col("is_old"), F.col(c)).otherwise(F.col(f"new_{c}")).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def upsert_movies(rows, movies, at):
    """Insert new movies; existing ones take the non-null values of the last row."""
    incoming = rows.groupBy(F.col("movie_id").alias("id")).agg(
        *[last_filled(c, "nr") for c in MOVIE_FIELDS]
    ).withColumns({"created_at": at, "updated_at": at})
    return upsert(movies, incoming, ["id"], [*MOVIE_FIELDS, "updated_at"], inserted=["created_at"])


def upsert_genres(rows, genres):
    """Get or create: unknown names get a key derived from the name."""
    names = rows.select(F.explode("genres").alias("name")).where("name <> ''").distinct()
    fresh = names.join(genres.select("name"), "name", "left_anti")
    return genres.unionByName(fresh.select(
        F.xxhash64("name").alias("id"), "name", F.lit(None).cast("bigint").alias("tmdb_genre_id")))


def upsert_movie_genres(rows, genres, movie_genres):
    """One link per movie and genre, added only when absent."""
    named = rows.select("movie_id", F.explode("genres").alias("name")).distinct()
    # One genre may sit on nearly every movie; genres are few, but that is not assumed.
    linked = skew_join(
        named, genres.select("name", F.col("id").alias("genre_id")), ["name"], "inner",
        hot_keys(named, ["name"]), spread_by=["movie_id"],
    ).select("movie_id", "genre_id")
    return movie_genres.unionByName(linked.join(movie_genres, ["movie_id", "genre_id"], "left_anti"))


def upsert_ratings(rows, ratings):
    """One rating per movie and source of the entity; unknown sources are skipped.

    A score always comes with the scale of the field it was read from.
    """
    vote, tomato = F.col("vote_average"), F.col("tomatometer_score")
    scored = rows.where(F.col("source").isin(S.SOURCES)).select(
        "movie_id", "source", "nr", "vote_count",
        numbers.rating_score(vote, tomato).alias("score"),
        numbers.rating_scale(vote, tomato, F.col("source")).alias("scale"),
    )
    told = F.when(F.col("score").isNotNull(), F.struct("score", "scale"))
    incoming = scored.withColumn("told", told).groupBy("movie_id", "source").agg(
        last_filled("told", "nr"), last_filled("vote_count", "nr"), F.min_by("scale", "nr").alias("plain"))
    incoming = incoming.select("movie_id", "source", "told.score", "vote_count", "told.scale", "plain")
    # Without a score the stored scale stays; a new rating has the scale of its source.
    plain = ratings.withColumn("plain", F.lit(None).cast("string"))
    after = upsert(plain, incoming, ["movie_id", "source"], ["score", "vote_count", "scale"], replaced=["plain"])
    return after.withColumn("scale", F.coalesce("scale", "plain")).select(ratings.columns)


def source_ratings(records, links, movie_ids, hot_rows=None):
    """One rating per movie and contributing source, from the records before merging.

    `links` is (pos, master) of every record, `movie_ids` is (pos, movie_id) of the
    entities. A master of more than `hot_rows` records is split.
    """
    vote, tomato = F.col("vote_average"), F.col("tomatometer_score")
    # Copies shrink to one row per master and source before they meet the master's movie.
    voted = records.where(F.col("source").isin(S.SOURCES)).join(links, "pos")
    row = F.struct(
        numbers.rating_score(vote, tomato).alias("score"), "vote_count",
        numbers.rating_scale(vote, tomato, F.col("source")).alias("scale"),
    )
    first = voted.groupBy("master", "source").agg(F.min("pos").alias("pos"), F.min_by(row, "pos").alias("r"))
    named = lookup_join(first, movie_ids.withColumnRenamed("pos", "master"), ["master"], "inner", hot_rows)
    # Several masters may have become one movie.
    first = named.groupBy("movie_id", "source").agg(F.min_by("r", "pos").alias("r"))
    return first.select("movie_id", "source", "r.score", "r.vote_count", "r.scale")


def upsert_rt_details(rows, rt_details, at):
    """Review details when any is filled; an update replaces all three, nulls included."""
    told = rows.where(
        (F.coalesce("tomatometer_score", F.lit(0.0)) != 0)
        | (F.coalesce("audience_score", F.lit(0.0)) != 0)
        | (F.coalesce("critics_consensus", F.lit("")) != "")
    )
    fields = ["tomatometer_score", "audience_score", "critics_consensus"]
    last = told.groupBy("movie_id").agg(F.max_by(F.struct(*fields), "nr").alias("r"))
    incoming = last.select("movie_id", *[f"r.{c}" for c in fields]).withColumn("scraped_at", at)
    return upsert(rt_details, incoming, ["movie_id"], [], replaced=fields, inserted=["scraped_at"])


def log_rows(loaded, rejected, at):
    """One success row per loaded entity, one error row per rejected one."""
    label = F.coalesce("source", F.lit("unknown"))
    ok = loaded.select(
        "movie_id", label.alias("source_name"), F.lit("success").alias("status"),
        F.lit(1).alias("records_ingested"), F.lit(None).cast("string").alias("error_message"),
    )
    failed = rejected.select(
        F.lit(None).cast("string").alias("movie_id"), label.alias("source_name"),
        F.lit("error").alias("status"), F.lit(0).alias("records_ingested"), "error_message",
    )
    return ok.union(failed).withColumn("ingested_at", at).transform(S.conform, S.INGESTION_LOGS)


def load(gold, existing=None, at=None):
    """All six tables after loading `gold` on top of the `existing` snapshots.

    `at` is the load time (a timestamp Column, default now). Only the log differs
    between loading the same gold once and twice.
    """
    spark = gold.sparkSession
    at = F.current_timestamp() if at is None else at
    have = {
        name: S.conform((existing or {})[name], schema) if name in (existing or {}) else S.empty(spark, schema)
        for name, schema in S.TARGET_TABLES.items()
    }
    good, bad = judged_rows(gold)
    loaded = with_movies(good, target_ids(good, have["movies"]))
    genres = materialize(upsert_genres(loaded, have["genres"]), "genres")
    return {
        "movies": upsert_movies(loaded, have["movies"], at),
        "genres": genres,
        "movie_genres": upsert_movie_genres(loaded, genres, have["movie_genres"]),
        "ratings": upsert_ratings(loaded, have["ratings"]),
        "rt_details": upsert_rt_details(loaded, have["rt_details"], at),
        "ingestion_logs": have["ingestion_logs"].unionByName(log_rows(loaded, bad, at)),
    }


def load_counts(logs):
    """Successes and errors of a load."""
    return logs.agg(
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )


def write_snapshot(tables, path):
    """Write every table below a new folder; an existing one is an error."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")


def read_snapshot(spark, path):
    return {name: spark.read.schema(s).parquet(f"{path}/{name}") for name, s in S.TARGET_TABLES.items()}


def export_columns(gold):
    """Public columns of the gold table, numbers coerced, bad ones null."""
    public = [f.name for f in S.RAW.fields if f.name not in ("seq", "detail_url") and f.name in gold.columns]
    coerced = {c: _exact_long(F.col(c)) for c in S.LONG_FIELDS if c in public}
    coerced |= {c: numbers.safe_double(F.col(c)) for c in S.DOUBLE_FIELDS if c in public}
    return gold.select(public).withColumns(coerced)


def _exact_long(col):
    """Whole numbers only; a fraction is bad input, not a rounding case."""
    value = numbers.safe_double(col)
    return F.coalesce(numbers.strict_long(col), F.when(value == F.floor(value), value.try_cast("bigint")))


def lists_to_json(df):
    """List columns as JSON text."""
    lists = [c for c, t in df.dtypes if t.startswith("array")]
    return df.withColumns({c: F.to_json(c) for c in lists}) if lists else df


def export_gold(gold, path):
    export_columns(gold).write.mode("overwrite").parquet(path)
