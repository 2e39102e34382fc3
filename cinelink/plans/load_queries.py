"""Loading into the related tables and the checks on them.

The entities to load come from `part`, the stored movies from `customer`, the stored
ratings and review details from `orders`; identifiers overlap in part, so inserts
and updates by either identifier all occur.
"""

import datetime
from functools import reduce

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text
from cinelink.operators import load, quality
from cinelink.operators.dedup import deduplicate
from cinelink.operators.normalize import normalize_records
from cinelink.operators.profile import counted
from cinelink.operators.resolve import link_records
from cinelink.plans import statements as Q
from cinelink.plans.catalogue import FILM_COLUMNS, raw_films
from cinelink.operators.snapshots import Snapshots
from cinelink.plans.registry import ORACLES, query, select_list
from cinelink.runtime import materialize, new_path, spread, together

AT = datetime.datetime(2024, 1, 1)

ENTITY_COLUMNS = [
    c for c in FILM_COLUMNS if not c.endswith((" AS tmdb_id", " AS imdb_id", " AS title", " AS release_date"))
] + [
    "CASE WHEN p_partkey % 6 <> 5 THEN p_partkey END AS tmdb_id",
    "CASE WHEN p_partkey % 5 <> 0 THEN concat('tt', p_partkey) END AS imdb_id",
    "CASE WHEN p_partkey % 41 <> 0 THEN p_name END AS title",
    "p_name AS title_norm",
    "1950 + p_size AS year",
    "CASE WHEN p_partkey % 6 <> 5 THEN 1 WHEN p_partkey % 5 <> 0 THEN 2 ELSE 3 END AS tier",
    "CASE WHEN p_partkey % 3 = 0 THEN 'tmdb,kaggle' ELSE 'imdb' END AS source_list",
]


def entities(t):
    """Gold-like entities, one per part."""
    return spread(t.part, "p_partkey").selectExpr(*ENTITY_COLUMNS).withColumns({
        "pos": F.struct(F.lit(0).alias("priority"), F.col("k").alias("a")),
        "genres": text.parse_genres(F.col("genre_text")), "sources": F.split("source_list", ","),
        "release_date": F.make_date("year", F.lit(1), F.lit(1)),
    })


def stored_movies(t):
    return t.customer.selectExpr(
        "concat('c', c_custkey) AS id", "CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS tmdb_id",
        "CASE WHEN c_custkey % 2 = 1 THEN concat('tt', c_custkey) END AS imdb_id", "c_name AS title",
        "c_mktsegment AS original_title", "c_mktsegment AS overview", "CAST(c_nationkey AS BIGINT) AS budget",
        "c_acctbal AS popularity").transform(S.conform, S.MOVIES)


STORED_RATINGS = """
    SELECT concat('c', o_custkey) AS movie_id, CASE o_orderstatus WHEN 'F' THEN 'tmdb' WHEN 'O' THEN 'kaggle'
        ELSE 'imdb' END AS source, max(CAST(CAST(floor(o_totalprice) AS BIGINT) % 10 AS DOUBLE)) AS score,
        count(*) AS vote_count, 'old' AS scale
    FROM orders GROUP BY 1, 2"""
STORED_DETAILS = """
    SELECT concat('c', o_custkey) AS movie_id, CAST(count(*) AS DOUBLE) AS tomatometer_score,
        max(CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS DOUBLE)) AS audience_score, 'old' AS critics_consensus
    FROM orders GROUP BY 1"""


def stored(t):
    def from_orders(statement):
        return t.spark.sql(statement.replace("FROM orders", "FROM {orders}"), orders=t.orders)

    genres = t.part.select(F.col("p_brand").alias("name")).union(t.part.select(F.initcap("p_type"))).distinct()
    return {
        "movies": stored_movies(t),
        "ratings": S.conform(from_orders(STORED_RATINGS), S.RATINGS),
        "rt_details": S.conform(from_orders(STORED_DETAILS), S.RT_DETAILS),
        "genres": genres.select(F.xxhash64("name").alias("id"), "name").transform(S.conform, S.GENRES),
    }


def loaded_tables(t):
    return load.load(entities(t), stored(t), F.lit(AT))


ENTITIES = f"""
    entity AS (SELECT {', '.join(ENTITY_COLUMNS)} FROM part),
    stored AS (
        SELECT concat('c', c_custkey) AS id, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS tmdb_id,
            CASE WHEN c_custkey % 2 = 1 THEN concat('tt', c_custkey) END AS imdb_id, c_name AS title,
            c_mktsegment AS original_title, c_mktsegment AS overview, CAST(c_nationkey AS BIGINT) AS budget,
            c_acctbal AS popularity FROM customer),
    judged AS (
        SELECT *, concat_ws('; ',
            CASE WHEN tomatometer_score > 100 THEN 'tomatometer_score out of range' END,
            CASE WHEN audience_score > 100 THEN 'audience_score out of range' END) AS why FROM entity),
    good AS (
        SELECT e.*, coalesce(a.id, b.id, CASE WHEN e.tmdb_id IS NOT NULL THEN sha256(concat('tmdb:', e.tmdb_id))
            WHEN e.imdb_id IS NOT NULL THEN sha256(concat('imdb:', e.imdb_id))
            ELSE sha256(concat('{{"title_norm":"', title_norm, '","year":', year, '}}')) END) AS movie_id
        FROM judged e LEFT JOIN stored a ON a.tmdb_id = e.tmdb_id LEFT JOIN stored b ON b.imdb_id = e.imdb_id
        WHERE why = '')"""


MOVIE_COLUMNS = [
    "id", "tmdb_id", "imdb_id", "title", "original_title", "overview", "budget", "popularity", "runtime_minutes",
    "sources", "CAST(release_date AS STRING) AS release_date",
]


def _last(column):
    return f"arg_max({column}, tier * 1000000000::BIGINT + k) FILTER ({column} IS NOT NULL)"


@query("movie_ids", f"WITH {ENTITIES} SELECT k, movie_id FROM good")
def movie_ids(t):
    rows, _ = load.split_rejected(load.movie_rows(entities(t)))
    rows = materialize(rows, "rows")
    return rows.join(load.target_ids(rows, stored_movies(t)), "nr").select("k", "movie_id")


# Two entities in three lean on an earlier one: one on the first of their title by tmdb_id, one on that of their size by imdb_id.
LEANING = ["CASE WHEN p_partkey % 3 = 0 THEN 1 END AS tmdb_id", "CASE WHEN p_partkey % 3 = 1 OR p_partkey < 50 THEN concat('tt', p_size % 2) END AS imdb_id"]


@query("split_movie_ids", f"""
    WITH RECURSIVE e AS (SELECT p_partkey AS k, {', '.join(LEANING)} FROM part),
    leans AS (SELECT k, CASE WHEN min(k) FILTER (tmdb_id IS NOT NULL) OVER (PARTITION BY tmdb_id) < k
            THEN min(k) FILTER (tmdb_id IS NOT NULL) OVER (PARTITION BY tmdb_id)
        WHEN min(k) FILTER (imdb_id IS NOT NULL) OVER (PARTITION BY imdb_id) < k
            THEN min(k) FILTER (imdb_id IS NOT NULL) OVER (PARTITION BY imdb_id) END AS first FROM e),
    up AS (SELECT k, k AS top FROM leans WHERE first IS NULL
           UNION ALL SELECT leans.k, up.top FROM leans JOIN up ON up.k = leans.first)
    SELECT k, top FROM up""")
def split_movie_ids(t):
    """Entities that write one movie, named by the first of them, where an identifier is on a third of all rows."""
    rows = t.part.selectExpr("p_partkey AS k", "CAST(p_partkey AS STRING) AS id", *LEANING).withColumn("nr", F.struct("k"))
    ids = load.target_ids(rows.withColumn("tmdb_id", F.col("tmdb_id").cast("bigint")), S.empty(t.spark, S.MOVIES), hot_rows=20)
    return ids.select(F.col("nr.k").alias("k"), F.col("movie_id").cast("bigint").alias("top"))


@query("upserted_movies", f"""
    WITH {ENTITIES}, incoming AS (
        SELECT movie_id, {_last('tmdb_id')} AS tmdb_id, {_last('imdb_id')} AS imdb_id,
            {_last("coalesce(title, 'Unknown')")} AS title, {_last('original_title')} AS original_title,
            {_last('overview')} AS overview, {_last('budget')} AS budget, {_last('popularity')} AS popularity,
            {_last('runtime_minutes')} AS runtime_minutes, {_last('source_list')} AS sources,
            {_last('year')} AS year FROM good GROUP BY movie_id)
    SELECT coalesce(n.movie_id, o.id) AS id, coalesce(n.tmdb_id, o.tmdb_id) AS tmdb_id,
        coalesce(n.imdb_id, o.imdb_id) AS imdb_id, coalesce(n.title, o.title) AS title,
        coalesce(n.original_title, o.original_title) AS original_title, coalesce(n.overview, o.overview) AS overview,
        coalesce(n.budget, o.budget) AS budget, coalesce(n.popularity, o.popularity) AS popularity,
        n.runtime_minutes, n.sources, CASE WHEN n.year IS NOT NULL THEN concat(n.year, '-01-01') END AS release_date
    FROM stored o FULL JOIN incoming n ON n.movie_id = o.id""")
def upserted_movies(t):
    return loaded_tables(t)["movies"].selectExpr(*MOVIE_COLUMNS)


_GENRES = Q.genre_list("genre_text")


@query("upserted_genres", f"""
    WITH {ENTITIES} SELECT DISTINCT name FROM (
        SELECT unnest({_GENRES}) AS name FROM good UNION ALL SELECT p_brand FROM part
        UNION ALL SELECT concat(left(p_type, 1), lower(substr(p_type, 2))) FROM part)""")
def upserted_genres(t):
    return loaded_tables(t)["genres"].select("name")


@query("movie_genre_links", f"WITH {ENTITIES} SELECT DISTINCT movie_id, unnest({_GENRES}) AS name FROM good")
def movie_genre_links(t):
    tables = loaded_tables(t)
    names = tables["genres"].select(F.col("id").alias("genre_id"), "name")
    return tables["movie_genres"].join(names, "genre_id").select("movie_id", "name")


@query("upserted_ratings", f"""
    WITH {ENTITIES}, rated AS (
        SELECT movie_id, source, {_last('coalesce(CASE WHEN vote_average <> 0 THEN vote_average END, tomatometer_score)')} AS score,
            {_last('vote_count')} AS vote_count,
            arg_max(CASE WHEN vote_average <> 0 THEN '0-10' ELSE '0-100' END, tier * 1000000000::BIGINT + k)
                FILTER (vote_average <> 0 OR tomatometer_score IS NOT NULL) AS scale,
            CASE WHEN source = 'rotten_tomatoes' THEN '0-100' ELSE '0-10' END AS plain
        FROM good GROUP BY movie_id, source)
    SELECT coalesce(n.movie_id, o.movie_id) AS movie_id, coalesce(n.source, o.source) AS source,
        coalesce(n.score, o.score) AS score, coalesce(n.vote_count, o.vote_count) AS vote_count,
        coalesce(n.scale, o.scale, n.plain) AS scale
    FROM ({STORED_RATINGS}) o FULL JOIN rated n ON n.movie_id = o.movie_id AND n.source = o.source""")
def upserted_ratings(t):
    return loaded_tables(t)["ratings"]


@query("upserted_rt_details", f"""
    WITH {ENTITIES}, told AS (
        SELECT movie_id, arg_max({{'t': tomatometer_score, 'a': audience_score, 'c': critics_consensus}},
            tier * 1000000000::BIGINT + k) AS r
        FROM good WHERE coalesce(tomatometer_score, 0) <> 0 OR coalesce(audience_score, 0) <> 0
            OR coalesce(critics_consensus, '') <> '' GROUP BY movie_id)
    SELECT coalesce(n.movie_id, o.movie_id) AS movie_id,
        CASE WHEN n.movie_id IS NOT NULL THEN r.t ELSE tomatometer_score END AS tomatometer_score,
        CASE WHEN n.movie_id IS NOT NULL THEN r.a ELSE audience_score END AS audience_score,
        CASE WHEN n.movie_id IS NOT NULL THEN r.c ELSE critics_consensus END AS critics_consensus
    FROM ({STORED_DETAILS}) o FULL JOIN told n ON n.movie_id = o.movie_id""")
def upserted_rt_details(t):
    return loaded_tables(t)["rt_details"].drop("scraped_at")


@query("ingestion_log", f"""
    WITH {ENTITIES}
    SELECT movie_id, source AS source_name, 'success' AS status, 1 AS records_ingested, NULL AS error_message FROM good
    UNION ALL SELECT NULL, source, 'error', 0, why FROM judged WHERE why <> ''""")
def ingestion_log(t):
    return loaded_tables(t)["ingestion_logs"].drop("ingested_at")


@query("load_counts", f"""
    WITH {ENTITIES} SELECT count(*) FILTER (why = '') AS success, count(*) FILTER (why <> '') AS errors,
        count(*) AS total FROM judged""")
def load_counts(t):
    return load.load_counts(loaded_tables(t)["ingestion_logs"])


COUNTS = f"""
    counts AS (
        SELECT 'movies' AS table_name, (SELECT count(*) FROM stored) + (SELECT count(DISTINCT movie_id) FROM good
            WHERE NOT starts_with(movie_id, 'c') OR length(movie_id) = 64) AS n
        UNION ALL SELECT 'genres', count(DISTINCT name) FROM (
            SELECT unnest({_GENRES}) AS name FROM good UNION ALL SELECT p_brand FROM part
            UNION ALL SELECT concat(left(p_type, 1), lower(substr(p_type, 2))) FROM part)
        UNION ALL SELECT 'movie_genres', count(*) FROM (SELECT DISTINCT movie_id, unnest({_GENRES}) FROM good)
        UNION ALL SELECT 'ratings', count(*) FROM (
            SELECT movie_id, source FROM ({STORED_RATINGS}) UNION SELECT movie_id, source FROM good)
        UNION ALL SELECT 'rt_details', count(*) FROM (
            SELECT movie_id FROM ({STORED_DETAILS}) UNION SELECT movie_id FROM good
            WHERE coalesce(tomatometer_score, 0) <> 0 OR coalesce(audience_score, 0) <> 0 OR coalesce(critics_consensus, '') <> '')
        UNION ALL SELECT 'ingestion_logs', count(*) FROM judged)"""


def count_rows(tables):
    """Rows per table: (table_name, n)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.union(b), counted)


def compare_rows(tables):
    """Rows of the second of two tables, and rows that one has more often than the other: (table_name, n, changed).

    Equal rows meet in one aggregate, so both numbers take one pass.
    """
    counted = []
    for name, (before, after) in tables.items():
        both = before.withColumn("side_", F.lit(0)).union(after.withColumn("side_", F.lit(1)))
        each = both.groupBy(before.columns).agg(
            F.sum("side_").alias("n_"), F.abs(F.sum(2 * F.col("side_") - 1)).alias("changed_"))
        counted.append(each.agg(
            F.coalesce(F.sum("n_"), F.lit(0)).alias("n"), F.coalesce(F.sum("changed_"), F.lit(0)).alias("changed"),
        ).select(F.lit(name).alias("table_name"), "n", "changed"))
    return reduce(lambda a, b: a.union(b), counted)


def snapshots_with_stored(t, buckets=16):
    """The stored tables as the first snapshot of a new folder."""
    store = Snapshots(t.spark, new_path(t.spark, "snapshots"), buckets)
    store.adopt(stored(t))
    return store


@query("six_table_load", f"WITH {ENTITIES}, {COUNTS} SELECT * FROM counts")
def six_table_load(t):
    """Rows of all six tables after a load onto the stored snapshot."""
    store = snapshots_with_stored(t)
    store.load(entities(t), F.lit(AT))
    return count_rows(store.tables())


@query("incremental_load", ORACLES["upserted_movies"])
def incremental_load(t):
    """Movies after two loads, of which the second, of one entity in a hundred, rewrites only their buckets."""
    store, rows = snapshots_with_stored(t, 64), entities(t)
    store.load(rows.where("k % 100 <> 0"), F.lit(AT))
    store.load(rows.where("k % 100 = 0"), F.lit(AT))
    return store.read("movies").selectExpr(*MOVIE_COLUMNS)


@query("repeated_load", f"WITH {ENTITIES}, {COUNTS} SELECT table_name, n, 0 AS changed FROM counts WHERE table_name <> 'ingestion_logs'")
def repeated_load(t):
    """Rows of each table after loading the same entities twice, and those that differ from the first load: none."""
    store = snapshots_with_stored(t)
    store.load(entities(t), F.lit(AT))
    once = store.tables()
    store.load(entities(t), F.lit(AT))
    twice = store.tables()
    names = [n for n in S.TARGET_TABLES if n != "ingestion_logs"]
    return compare_rows({n: (once[n], twice[n]) for n in names})


_RATINGS_SQL = f"""
    WITH RECURSIVE {Q.settled(S.FUZZY_THRESHOLD)}
    SELECT m.k AS master_k, r.source, arg_min({{'v': coalesce(CASE WHEN r.vote_average <> 0 THEN r.vote_average END,
            r.tomatometer_score)}}, r.pos).v AS score,
        arg_min({{'v': r.vote_count}}, r.pos).v AS vote_count,
        arg_min(CASE WHEN r.vote_average <> 0 THEN '0-10' WHEN r.tomatometer_score IS NOT NULL
            OR r.source = 'rotten_tomatoes' THEN '0-100' ELSE '0-10' END, r.pos) AS scale
    FROM links JOIN kept r USING (pos) JOIN kept m ON m.pos = links.master GROUP BY m.k, r.source"""


def _ratings_per_source(t, hot_rows=None):
    kept = deduplicate(normalize_records(raw_films(t)), ["vote_average", "vote_count", "tomatometer_score"])
    links = link_records(kept).select("pos", "master")
    ids = kept.select("pos", F.col("seq.a").alias("movie_id"))
    return load.source_ratings(kept, links, ids, hot_rows).withColumnRenamed("movie_id", "master_k")


@query("ratings_per_source", _RATINGS_SQL)
def ratings_per_source(t):
    return _ratings_per_source(t)


@query("split_ratings", _RATINGS_SQL)
def split_ratings(t):
    """The same ratings, with masters of more than one source split over tasks."""
    return _ratings_per_source(t, hot_rows=1)


# --- checks -------------------------------------------------------------------

@query("duplicate_keys", """
    SELECT p_name, p_size, count(*) AS n FROM part GROUP BY p_name, p_size HAVING count(*) > 1""")
def duplicate_keys(t):
    return quality.duplicate_keys(t.part, ["p_name", "p_size"])


@query("missing_values", f"""
    WITH {Q.NORMAL} SELECT unnest(['title', 'source', 'release_date', 'overview']) AS column_name, unnest([
        count(*) - count(title), count(*) - count(source), count(*) - count(release_date), count(*) - count(overview)
        ]) AS violations FROM normal""")
def missing_values(t):
    return quality.missing(normalize_records(raw_films(t)), ["title", "source", "release_date", "overview"])


@query("values_out_of_range", "SELECT event_id, value FROM events WHERE value < 1 OR value > 100")
def values_out_of_range(t):
    return quality.out_of_range(t.events, "value", 1, 100).select("event_id", "value")


@query("unknown_labels", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def unknown_labels(t):
    return quality.not_in(t.orders, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query("texts_too_long", "SELECT doc_id, n_chars FROM documents WHERE length(text) > 500")
def texts_too_long(t):
    return quality.too_long(t.documents, "text", 500).select("doc_id", "n_chars")


@query("orphan_rows", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
        SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey IS NOT NULL)""")
def orphan_rows(t):
    rich = t.customer.where("c_acctbal > 0")
    return quality.orphans(t.orders, "o_custkey", rich, "c_custkey").select("o_orderkey", "o_custkey")


@query("cascaded_delete", """
    SELECT o_orderkey, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0""")
def cascaded_delete(t):
    rich = t.customer.where("c_acctbal > 0")
    return quality.cascade(t.orders, "o_custkey", rich, "c_custkey").select("o_orderkey", "o_custkey")


@query("detached_rows", """
    SELECT o_orderkey, c_custkey AS o_custkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""")
def detached_rows(t):
    rich = t.customer.where("c_acctbal > 0")
    return quality.detach(t.orders, "o_custkey", rich, "c_custkey").select("o_orderkey", "o_custkey")


@query("split_orphans", ORACLES["orphan_rows"])
def split_orphans(t):
    """The same orphans, with customers of more than five orders split over tasks."""
    rich = t.customer.where("c_acctbal > 0")
    return quality.orphans(t.orders, "o_custkey", rich, "c_custkey", hot_rows=5).select("o_orderkey", "o_custkey")


@query("split_deletes", f"""
    SELECT 'kept' AS kind, o_orderkey, o_custkey FROM ({ORACLES["cascaded_delete"]})
    UNION ALL SELECT 'detached', o_orderkey, o_custkey FROM ({ORACLES["detached_rows"]})""")
def split_deletes(t):
    """Both ways to treat the children of deleted rows, with customers of more than five orders split over tasks."""
    rich = t.customer.where("c_acctbal > 0")
    kept = quality.cascade(t.orders, "o_custkey", rich, "c_custkey", hot_rows=5)
    loose = quality.detach(t.orders, "o_custkey", rich, "c_custkey", hot_rows=5)
    return kept.select(F.lit("kept").alias("kind"), "o_orderkey", "o_custkey").union(
        loose.select(F.lit("detached"), "o_orderkey", "o_custkey"))


# Tables that break every kind of constraint somewhere.
FAULTY = {
    "movies": """SELECT CAST(p_partkey AS VARCHAR(20)) AS id, CAST(floor(p_partkey / 2) AS BIGINT) AS tmdb_id,
        concat('tt', p_name, p_size) AS imdb_id, CASE WHEN p_size <> 7 THEN p_name END AS title,
        CAST(p_size - 3 AS BIGINT) AS runtime_minutes FROM part""",
    "genres": """SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS name
        FROM customer""",
    "movie_genres": "SELECT CAST(l_orderkey AS VARCHAR(20)) AS movie_id, l_partkey AS genre_id FROM lineitem",
    "ratings": """SELECT CAST(l_orderkey AS VARCHAR(20)) AS movie_id,
        CASE l_returnflag WHEN 'A' THEN 'imdb' WHEN 'N' THEN 'radio' END AS source,
        l_discount - 0.05 AS score, l_suppkey - 5 AS vote_count, l_linestatus AS scale FROM lineitem""",
    "rt_details": """SELECT CAST(o_custkey AS VARCHAR(20)) AS movie_id, o_totalprice / 1000 AS tomatometer_score,
        o_totalprice / 5000 - 1 AS audience_score FROM orders""",
    "ingestion_logs": """SELECT CAST(user_id * 100 AS VARCHAR(20)) AS movie_id,
        concat(event_type, ' ', repeat('x', CAST(floor(value) AS INT))) AS source_name,
        CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'success' WHEN 'view' THEN 'seen' END AS status
        FROM events""",
}


def _audit_sql():
    """Counts over the faulty tables, and the zeros expected after a load."""
    count = lambda table, where: f"(SELECT count(*) FROM f_{table} WHERE {where})"
    twice = lambda table, *keys: (
        f"(SELECT count(*) FROM (SELECT 1 FROM f_{table} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)} "
        f"GROUP BY {', '.join(keys)} HAVING count(*) > 1))")
    lost = lambda child, key, parent: count(child, f"{key} IS NOT NULL AND {key} NOT IN (SELECT id FROM f_{parent})")
    found = {
        ("movies", "unique tmdb_id"): twice("movies", "tmdb_id"),
        ("movies", "unique imdb_id"): twice("movies", "imdb_id"),
        ("genres", "unique name"): twice("genres", "name"),
        ("ratings", "unique movie_id, source"): twice("ratings", "movie_id", "source"),
        ("rt_details", "unique movie_id"): twice("rt_details", "movie_id"),
        ("movies", "title not null"): count("movies", "title IS NULL"),
        ("genres", "name not null"): count("genres", "name IS NULL"),
        ("ratings", "source not null"): count("ratings", "source IS NULL"),
        ("ratings", "scale not null"): count("ratings", "scale IS NULL"),
        ("ingestion_logs", "status not null"): count("ingestion_logs", "status IS NULL"),
        ("movies", "runtime_minutes > 0"): count("movies", "runtime_minutes <= 0"),
        ("ratings", "score >= 0"): count("ratings", "score < 0"),
        ("ratings", "vote_count >= 0"): count("ratings", "vote_count < 0"),
        ("rt_details", "tomatometer_score 0-100"): count("rt_details", "tomatometer_score NOT BETWEEN 0 AND 100"),
        ("rt_details", "audience_score 0-100"): count("rt_details", "audience_score NOT BETWEEN 0 AND 100"),
        ("ratings", "source known"): count("ratings", "source = 'radio'"),
        ("ingestion_logs", "status known"): count("ingestion_logs", "status = 'seen'"),
        ("movie_genres", "movie exists"): lost("movie_genres", "movie_id", "movies"),
        ("movie_genres", "genre exists"): lost("movie_genres", "genre_id", "genres"),
        ("ratings", "movie exists"): lost("ratings", "movie_id", "movies"),
        ("rt_details", "movie exists"): lost("rt_details", "movie_id", "movies"),
        ("ingestion_logs", "movie exists"): lost("ingestion_logs", "movie_id", "movies"),
        ("movies", "title at most 500 long"): "0", ("movies", "original_title at most 500 long"): "0",
        ("movies", "poster_path at most 500 long"): "0",
        ("movies", "imdb_id at most 20 long"): count("movies", "length(imdb_id) > 20"),
        ("movies", "sources at most 200 long"): "0", ("genres", "name at most 100 long"): "0",
        ("ingestion_logs", "source_name at most 50 long"): count("ingestion_logs", "length(source_name) > 50"),
    }
    tables = ", ".join(f"f_{n} AS ({s})" for n, s in FAULTY.items())
    return f"WITH {tables} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, CAST({n} AS BIGINT) AS violations"
        for (t, c), n in found.items()), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, 0 AS violations" for t, c in found)


@query("constraint_audit", _audit_sql()[0])
def constraint_audit(t):
    def table(name):
        expressions, source = FAULTY[name].split("SELECT", 1)[1].rsplit("FROM", 1)
        return S.conform(getattr(t, source.strip()).selectExpr(*select_list(expressions)), S.TARGET_TABLES[name])

    return quality.audit({name: table(name) for name in S.TARGET_TABLES})


@query("audit_of_load", f"WITH {ENTITIES}, {COUNTS} SELECT found.*, n FROM ({_audit_sql()[1]}) found JOIN counts USING (table_name)")
def audit_of_load(t):
    """Violations in the loaded tables, none, next to the rows that were checked."""
    tables = loaded_tables(t)
    tables = dict(zip(tables, together(*[lambda n=n, df=df: materialize(df, n) for n, df in tables.items()])))
    return quality.audit(tables).join(count_rows(tables), "table_name")


@query("run_audit", f"""
    WITH {Q.KEPT}
    SELECT 'run-1' AS run_id, source, extracted, coalesce(loaded, 0) AS loaded,
        CASE WHEN coalesce(loaded, 0) = extracted THEN 'success' WHEN loaded > 0 THEN 'partial' ELSE 'error' END AS status,
        60.0::DOUBLE AS duration_seconds
    FROM (SELECT source, count(*) AS extracted FROM normal GROUP BY source)
    LEFT JOIN (SELECT source, count(*) AS loaded FROM kept GROUP BY source) USING (source)""")
def run_audit(t):
    normal, _, extracted = counted(normalize_records(raw_films(t)), "normal", S.SOURCES)
    _, _, kept = counted(deduplicate(normal), "kept", S.SOURCES)
    started = F.lit(AT)
    return quality.run_audit(
        extracted, kept, "run-1", started, started + F.expr("INTERVAL 60 SECONDS")).drop("started_at")
