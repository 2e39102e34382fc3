"""Counts, histograms, profiles, orderings and set operations over the whole tables."""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators import filters, profile
from cinelink.operators.dedup import deduplicate, keep_first, removed_counts
from cinelink.operators.normalize import normalize_records
from cinelink.plans import statements as Q
from cinelink.plans.catalogue import FILMS, films, raw_films
from cinelink.plans.registry import query
from cinelink.sources.files import extract_all


@query("records_by_source", f"SELECT source, count(*) AS records FROM ({FILMS}) GROUP BY ROLLUP (source)")
def records_by_source(t):
    return profile.counts_by_source(films(t))


@query("stage_metrics", f"""
    WITH {Q.KEPT}, counts AS (
        SELECT 0 AS step, 'extracted' AS stage, count(*) AS after FROM films
        UNION ALL SELECT 1, 'deduplicated', count(*) FROM kept
        UNION ALL SELECT 2, 'themed', count(*) FROM kept WHERE source IN ('tmdb', 'imdb', 'spark')
            OR contains(lower(concat_ws(' ', array_to_string(genres, ' '), title, overview)), 'horror'))
    SELECT CAST(step AS BIGINT) AS step, stage, coalesce(before, after) AS before, after,
        coalesce(before, after) - after AS removed
    FROM (SELECT *, lag(after) OVER (ORDER BY step) AS before FROM counts)""")
def stage_metrics(t):
    # Counted by the writes that store them, not by a second scan.
    raw, extracted, _ = profile.counted(raw_films(t), "raw")
    kept, deduplicated, _ = profile.counted(deduplicate(normalize_records(raw)), "kept")
    _, themed, _ = profile.counted(filters.thematic_filter(kept), "themed")
    stages = {"extracted": extracted, "deduplicated": deduplicated, "themed": themed}
    return profile.stage_metrics(stages).withColumn("step", F.col("step").cast("bigint"))


@query("removed_per_source", f"""
    WITH {Q.KEPT}
    SELECT source, before, after, before - after AS removed
    FROM (SELECT source, count(*) AS before FROM normal GROUP BY source)
    JOIN (SELECT source, count(*) AS after FROM kept GROUP BY source) USING (source)""")
def removed_per_source(t):
    normal, _, before = profile.counted(normalize_records(raw_films(t)), "normal", S.SOURCES)
    _, _, after = profile.counted(deduplicate(normal), "kept", S.SOURCES)
    return removed_counts(before, after)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(t):
    return profile.value_counts(t.events, "event_type")


@query("score_histogram", """
    WITH edge AS (SELECT min(value) AS low, max(value) AS high FROM events),
    binned AS (SELECT least(floor((value - low) * 8 / (high - low)) + 1, 8) AS bin FROM events, edge)
    SELECT CAST(b.bin AS BIGINT) AS bin, round(low + (b.bin - 1) * (high - low) / 8, 6) AS bin_low,
        round(low + b.bin * (high - low) / 8, 6) AS bin_high, count(binned.bin) AS n
    FROM (SELECT unnest(range(1, 9)) AS bin) b CROSS JOIN edge LEFT JOIN binned ON binned.bin = b.bin
    GROUP BY b.bin, low, high""")
def score_histogram(t):
    h = profile.histogram(t.events, "value", 8)
    return h.select(
        F.col("bin").cast("bigint").alias("bin"), F.round("bin_low", 6).alias("bin_low"),
        F.round("bin_high", 6).alias("bin_high"), "n")


@query("films_per_decade", f"""
    WITH {Q.NORMAL} SELECT CAST(floor(year / 10) * 10 AS BIGINT) AS decade, count(*) AS n
    FROM normal WHERE release_date IS NOT NULL GROUP BY 1""")
def films_per_decade(t):
    counted = profile.films_per_decade(normalize_records(raw_films(t)))
    return counted.select(F.col("decade").cast("bigint").alias("decade"), "n")


def _describe_sql(table, column):
    return f"""SELECT '{column}' AS column_name, count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
        round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
        round(quantile_cont({column}, 0.75), 6) AS q75 FROM {table}"""


def _described(df, columns):
    d = profile.describe_numbers(df, columns)
    return d.select("column_name", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                    "min", "max", *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")])


@query("number_profile", " UNION ALL ".join(
    _describe_sql("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_partkey")))
def number_profile(t):
    return _described(t.lineitem, ["l_quantity", "l_extendedprice", "l_partkey"])


HOT_VALUES = ["CASE WHEN event_id % 10 = 0 THEN value ELSE 42.5 END AS hot", "CASE WHEN event_id % 4 = 0 THEN user_id END AS rare", "value"]


@query("hot_value_profile", " UNION ALL ".join(
    _describe_sql(f"(SELECT {', '.join(HOT_VALUES)} FROM events)", c) for c in ("hot", "rare", "value")))
def hot_value_profile(t):
    """Figures of columns of which one holds one value on nine rows in ten."""
    return _described(t.events.selectExpr(*HOT_VALUES), ["hot", "rare", "value"])


def _text_sql(table, column):
    return f"""SELECT '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
        arg_min(v, [CAST(-n AS VARCHAR)]) FILTER (n = top_n AND v = top_v) AS top, max(n) AS freq
        FROM (SELECT *, max(n) OVER () AS top_n,
                first_value(v) OVER (ORDER BY n DESC, v) AS top_v
              FROM (SELECT {column} AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1))"""


@query("text_profile", " UNION ALL ".join(
    _text_sql("part", c) for c in ("p_name", "p_brand", "p_type")))
def text_profile(t):
    return profile.describe_text(t.part, ["p_name", "p_brand", "p_type"])


@query("keep_first_document", """
    SELECT lang, text, doc_id, source FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def keep_first_document(t):
    return keep_first(t.documents.drop("n_chars"), ["lang", "text"], "doc_id")


@query("keep_first_part", """
    SELECT p_name, p_size, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand
    FROM part GROUP BY p_name, p_size""")
def keep_first_part(t):
    first = keep_first(t.part, ["p_name", "p_size"], "p_partkey")
    return first.select("p_name", "p_size", "p_partkey", "p_brand")


@query("sorted_preview", """
    SELECT title, p_partkey FROM (
        SELECT concat(p_name, ' ', lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS title, p_partkey FROM part)
    ORDER BY title LIMIT 15""")
def sorted_preview(t):
    titled = t.part.select(
        F.concat("p_name", F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("title"), "p_partkey")
    return profile.preview(titled, "title", 15)


@query("union_of_sources", """
    SELECT 'customer' AS source, c_name AS title, c_acctbal AS score FROM customer
    UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier
    UNION ALL SELECT 'part', p_name, NULL FROM part""")
def union_of_sources(t):
    """The union that the registry makes of readers with different columns."""
    def reader(table, *columns):
        return lambda spark: getattr(t, table).selectExpr(f"'{table}' AS source", *columns)

    union, _ = extract_all(t.spark, {
        "customer": reader("customer", "c_name AS title", "c_acctbal AS vote_average"),
        "supplier": reader("supplier", "s_name AS title", "s_acctbal AS vote_average"),
        "part": reader("part", "p_name AS title"),
    })
    return union.select("source", "title", F.col("vote_average").alias("score"))
