"""De-duplication, matching, election of masters and survivorship over the derived films."""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators import filters, resolve
from cinelink.operators.dedup import deduplicate, uncovered_ids, uncovered_titles
from cinelink.operators.normalize import normalize_records
from cinelink.operators.similarity import similar_titles
from cinelink.plans import statements as Q
from cinelink.plans.catalogue import raw_films
from cinelink.plans.registry import query
from cinelink.runtime import lookup_join

T = S.FUZZY_THRESHOLD


def kept_films(t, columns=None):
    return deduplicate(normalize_records(raw_films(t)), columns)


def numbered(kept):
    """Position to part key of the kept row."""
    return kept.select("pos", F.col("seq.a").alias("k"))


@query("deduplicated_records", f"""
    WITH {Q.KEPT} SELECT k, source, title_norm, CAST(year AS BIGINT) AS year, tmdb_id, imdb_id, overview,
        CAST(priority AS BIGINT) AS priority, CAST(tier AS BIGINT) AS tier, first_seen FROM kept""")
def deduplicated_records(t):
    return kept_films(t).select(
        F.col("seq.a").alias("k"), "source", "title_norm", F.col("year").cast("bigint").alias("year"), "tmdb_id",
        "imdb_id", "overview", F.col("pos.priority").cast("bigint").alias("priority"),
        F.col("pos.tier").cast("bigint").alias("tier"), F.col("pos.a").alias("first_seen"))


@query("uncovered_ids", f"""
    WITH {Q.NORMAL} SELECT k, source, imdb_id FROM normal a WHERE imdb_id IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM normal b WHERE b.tier = 1 AND b.imdb_id = a.imdb_id AND b.source = a.source)""")
def uncovered_by_ids(t):
    n = normalize_records(raw_films(t)).withColumn("k", F.col("seq.a"))
    covering = n.where("tmdb_id is not null")
    return uncovered_ids(n.where("imdb_id is not null"), covering, ["source"]).select("k", "source", "imdb_id")


@query("uncovered_titles", f"""
    WITH {Q.NORMAL} SELECT k, title_norm FROM normal a WHERE tier = 3 AND NOT EXISTS (
        SELECT 1 FROM normal b WHERE b.tier < 3 AND b.title_norm IS NOT DISTINCT FROM a.title_norm
          AND b.year IS NOT DISTINCT FROM a.year)""")
def uncovered_by_titles(t):
    n = normalize_records(raw_films(t)).withColumns({"k": F.col("seq.a"), "year": F.year("release_date")})
    has_id = F.col("tmdb_id").isNotNull() | F.col("imdb_id").isNotNull()
    return uncovered_titles(n.where(~has_id), n.where(has_id)).select("k", "title_norm")


def _links_sql(column):
    return f"""WITH {Q.KEPT}, firsts AS (
        SELECT k, pos, {column}, first_value(k) OVER w AS first_k, min(pos) OVER w AS first_pos
        FROM kept WHERE {column} IS NOT NULL WINDOW w AS (PARTITION BY {column} ORDER BY pos))
    SELECT k AS later, first_k AS earlier, {column} FROM firsts WHERE pos > first_pos"""


def _links(t, column, hot_rows=None):
    kept = kept_films(t, [])
    links = resolve.same_id_links(kept, column, hot_rows)
    number = numbered(kept)
    later = number.select(F.col("pos").alias("later"), F.col("k").alias("k_later"))
    earlier = number.select(F.col("pos").alias("earlier"), F.col("k").alias("k_earlier"))
    # The earliest record of an identifier is named by all others that hold it.
    return lookup_join(links.join(later, "later"), earlier, ["earlier"], "inner", hot_rows).select(
        F.col("k_later").alias("later"), F.col("k_earlier").alias("earlier"), column)


@query("same_tmdb_links", _links_sql("tmdb_id"))
def same_tmdb_links(t):
    return _links(t, "tmdb_id")


@query("split_links", _links_sql("tmdb_id"))
def split_links(t):
    """The same links, with identifiers of more than two records split over tasks."""
    return _links(t, "tmdb_id", hot_rows=2)


@query("same_imdb_links", _links_sql("imdb_id"))
def same_imdb_links(t):
    return _links(t, "imdb_id")


def _similar_sql(threshold):
    return f"""
    WITH {Q.matches(threshold)},
    titles AS (SELECT DISTINCT token_key AS s, year AS y FROM kept WHERE token_key <> ''),
    sized AS (SELECT s, y, length(s) AS n, coalesce(y, -1) AS o FROM titles)
    SELECT a.s AS s_a, CAST(a.y AS BIGINT) AS y_a, b.s AS s_b, CAST(b.y AS BIGINT) AS y_b, round(w.score, 6) AS score
    FROM sized a JOIN both_ways w ON w.wa = a.s JOIN sized b ON b.s = w.wb
    WHERE (a.n, a.s, a.o) > (b.n, b.s, b.o) AND (a.y IS NULL OR b.y IS NULL OR abs(a.y - b.y) <= 1)"""


# Titles per block and task in the queries that show blocks being split.
CROWD = 4


def _similar(t, threshold, hot_block=None):
    nodes = resolve.match_nodes(kept_films(t, [])).where("token_key <> ''")
    pairs = similar_titles(nodes.select("token_key", "year").distinct(), threshold, hot_block)
    return pairs.select(
        "s_a", F.col("y_a").cast("bigint").alias("y_a"), "s_b", F.col("y_b").cast("bigint").alias("y_b"),
        F.round("score", 6).alias("score"))


@query("similar_titles", _similar_sql(T))
def similar_titles_default(t):
    return _similar(t, T)


@query("similar_titles_loose", _similar_sql(70.0))
def similar_titles_loose(t):
    return _similar(t, 70.0)


@query("crowded_titles", _similar_sql(T))
def crowded_titles(t):
    return _similar(t, T, CROWD)


def _links_statement(strict_ids=False):
    return f"""
    WITH RECURSIVE {Q.settled(T, strict_ids)}
    SELECT a.k, m.k AS master_k, CAST(level AS BIGINT) AS level, round(score, 6) AS score
    FROM links JOIN kept a USING (pos) JOIN kept m ON m.pos = links.master"""


_LINKS_SQL = _links_statement()


def _entity_links(t, hot_block=None, **options):
    kept = kept_films(t, [])
    number = numbered(kept)
    links = resolve.link_records(kept, T, hot_block=hot_block, **options)
    masters = number.select(F.col("pos").alias("master"), F.col("k").alias("master_k"))
    return lookup_join(links.join(number, "pos"), masters, ["master"], "inner").select(
        "k", "master_k", F.col("level").cast("bigint").alias("level"), F.round("score", 6).alias("score"))


@query("entity_links", _LINKS_SQL)
def entity_links(t):
    return _entity_links(t)


@query("crowded_links", _LINKS_SQL)
def crowded_links(t):
    return _entity_links(t, CROWD)


@query("split_masters", _LINKS_SQL)
def split_masters(t):
    """The same links, with identifiers, titles and similar titles of more than five records split over tasks."""
    return _entity_links(t, hot_rows=5)


@query("strict_links", _links_statement(strict_ids=True))
def strict_links(t):
    """Links of which no entity holds two tmdb_ids."""
    return _entity_links(t, strict_ids=True)


@query("strict_crowded_links", _links_statement(strict_ids=True))
def strict_crowded_links(t):
    return _entity_links(t, CROWD, strict_ids=True)


@query("elected_masters", f"""
    WITH RECURSIVE {Q.settled(T)} SELECT k, source FROM kept JOIN final USING (pos) WHERE status = 'master'""")
def elected_masters(t):
    kept = kept_films(t, [])
    links = resolve.link_records(kept, T).where("level = 0")
    return kept.join(links.select("pos"), "pos").select(F.col("seq.a").alias("k"), "source")


_FIELDS = [
    "source", "tmdb_id", "imdb_id", "title", "title_norm", "original_title", "overview", "vote_average", "vote_count",
    "runtime_minutes", "budget", "revenue", "poster_path", "popularity", "tomatometer_score", "audience_score",
    "critics_consensus",
]


def _entity_columns(df):
    return df.select(
        *_FIELDS, F.col("release_date").cast("string").alias("release_date"),
        F.array_join("genres", "|").alias("genres"), F.array_join("sources", ",").alias("sources"))


_ENTITY_SQL = f"""{', '.join(_FIELDS)}, strftime(release_date, '%Y-%m-%d') AS release_date,
    array_to_string(genres, '|') AS genres, sources"""


@query("filled_entities", f"""
    WITH RECURSIVE {Q.gold(T)} SELECT {_ENTITY_SQL} FROM filled JOIN contributors USING (master)""")
def filled_entities(t):
    kept = kept_films(t)
    links = resolve.link_records(kept, T).select("pos", "master")
    return _entity_columns(resolve.fill_fields(kept.join(links, "pos")))


@query("gold_entities", f"WITH RECURSIVE {Q.gold(T)} SELECT {_ENTITY_SQL} FROM gold")
def gold_entities(t):
    return _entity_columns(resolve.resolve(kept_films(t), T))


@query("themed_gold", f"""
    WITH RECURSIVE {Q.gold(T)} SELECT {_ENTITY_SQL} FROM gold
    WHERE source IN ('tmdb', 'imdb', 'spark')
       OR contains(lower(concat_ws(' ', array_to_string(genres, ' '), title, overview)), 'horror')""")
def themed_gold(t):
    return _entity_columns(filters.thematic_filter(resolve.resolve(kept_films(t), T)))


@query("missing_overviews", f"WITH RECURSIVE {Q.gold(T)} SELECT title, sources FROM gold WHERE overview IS NULL")
def missing_overviews(t):
    lost = filters.missing_overview(resolve.resolve(kept_films(t), T))
    return lost.select("title", F.array_join("sources", ",").alias("sources"))
