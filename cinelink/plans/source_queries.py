"""Readers over files derived from the tables: JSON pages, CSV, TSV, landed HTML, Parquet."""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text
from cinelink.operators import load
from cinelink.operators.normalize import normalize_records
from cinelink.operators.profile import preview
from cinelink.plans import statements as Q
from cinelink.plans.catalogue import FILMS, films, raw_films
from cinelink.plans.registry import query, select_list
from cinelink.runtime import new_path
from cinelink.sources import files, landed_html

NO_CAP = 1 << 30


def written(df, label, write):
    """Write a derived file set to the shared folder and return its path."""
    path = new_path(df.sparkSession, label)
    write(df.write, path)
    return path


def columns_of(statement):
    """The select list of a one-table statement."""
    return select_list(statement.split("SELECT", 1)[1].rsplit("FROM", 1)[0])


def spelled(df):
    """Dates as text, lists joined, order keys as plain numbers: easy to compare."""
    return df.withColumns({
        "genres": F.array_join("genres", "|"), "release_date": F.col("release_date").cast("string"),
    }).drop("seq")


# --- API pages: twenty parts a page ------------------------------------------

@query("api_pages", """
    SELECT 'tmdb' AS source, p_partkey AS tmdb_id, p_name AS title, concat(1950 + p_size, '-01-01') AS release_date,
        p_retailprice AS popularity, p_partkey % 20 + 1 AS place, CASE WHEN p_size % 3 = 0 THEN 'Horror' END AS genres
    FROM part WHERE (p_size % 3 = 0 OR p_size % 3 = 1) AND p_brand <> 'Brand#13'""")
def api_pages(t):
    film = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.concat((F.col("p_size") + 1950).cast("string"), F.lit("-01-01")).alias("release_date"),
        F.col("p_retailprice").alias("popularity"), (F.col("p_brand") == "Brand#13").alias("adult"),
        F.expr("CASE p_size % 3 WHEN 0 THEN array(18, 27) WHEN 2 THEN array(35) END").alias("genre_ids"),
    )
    pages = t.part.groupBy((F.floor(F.col("p_partkey") / 20) + 1).alias("page")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("p_partkey", film.alias("film")))), lambda e: e["film"]
        ).alias("results")).withColumns({"total_pages": F.lit(NO_CAP), "total_results": F.lit(0)})
    path = written(pages, "pages", lambda w, p: w.json(p))
    read = files.read_api_pages(t.spark, path, max_pages=NO_CAP)
    return read.select(
        "source", "tmdb_id", "title", "release_date", "popularity", (F.col("seq.b") + 1).alias("place"),
        F.array_join("genres", "|").alias("genres"),
    ).withColumn("genres", F.nullif("genres", F.lit("")))


# --- catalogue CSV: odd headers, null tokens, bad cells -----------------------

CATALOGUE = """
    SELECT p_partkey, concat('tt', p_partkey) AS imdb, concat(p_name, ' ', p_brand) AS title,
        CASE WHEN p_partkey % 10 = 0 THEN 'N/A' ELSE concat(1950 + p_size, '') END AS year,
        CASE WHEN p_partkey % 13 = 0 THEN 'n.a.' WHEN p_partkey % 17 = 0 THEN 'None'
             ELSE concat(p_size, '.5') END AS rating,
        CASE WHEN p_partkey % 19 = 0 THEN 'null' ELSE concat(p_partkey, '.9') END AS votes,
        concat(60 + p_size, '') AS runtime,
        CASE p_type WHEN 'PROMO' THEN 'HORROR, Drama' WHEN 'SMALL' THEN 'Comedy' WHEN 'LARGE' THEN 'Thriller|Horror'
             WHEN 'MEDIUM' THEN 'NA' ELSE '[{"name": "horror"}]' END AS genre,
        concat('He said "no",', chr(10), 'twice') AS description
    FROM part"""


@query("catalogue_csv", f"""
    WITH film AS ({CATALOGUE}),
    typed AS (
        SELECT p_partkey AS tmdb_id, imdb AS imdb_id, title, CASE WHEN year <> 'N/A' THEN year END AS release_date,
            TRY_CAST(rating AS DOUBLE) AS vote_average, CASE WHEN votes <> 'null' THEN p_partkey END AS vote_count,
            CAST(runtime AS BIGINT) AS runtime_minutes, {Q.genre_list('genre')} AS g, description AS overview
        FROM film WHERE genre <> 'NA')
    SELECT 'kaggle' AS source, * EXCLUDE (g), array_to_string(g, '|') AS genres
    FROM typed WHERE contains(lower(array_to_string(g, '|')), 'horror')
    QUALIFY row_number() OVER (PARTITION BY title, release_date ORDER BY tmdb_id) = 1""")
def catalogue_csv(t):
    film = t.part.selectExpr(
        *columns_of(CATALOGUE)
    ).select(
        F.col("p_partkey").alias("ID"), F.col("imdb").alias("Imdb_Id"), F.col("title").alias("Title"),
        F.col("year").alias("Year"), F.col("rating").alias("RATING"), F.col("votes").alias("Votes"),
        F.col("runtime").alias("Runtime (Minutes)"), F.col("genre").alias("Genre"),
        F.col("description").alias("Description"),
    )
    # Copies of a film stay in one file, in key order.
    path = written(
        film.repartition("Title", "Year").sortWithinPartitions("ID"), "catalogue",
        lambda w, p: w.option("header", True).option("escape", '"').csv(p))
    return spelled(files.read_catalogue_csv(t.spark, path, multiline=True)).select(
        "source", "tmdb_id", "imdb_id", "title", "release_date", "vote_average", "vote_count",
        "runtime_minutes", "genres", "overview")


@query("split_csv", f"""
    SELECT 'spark' AS source, tmdb_id, imdb_id, title, release_date, vote_average, popularity, budget, runtime_minutes,
        array_to_string(g, '|') AS genres
    FROM (SELECT k AS tmdb_id, imdb_id, nullif(trim(title), '') AS title, release_date, vote_average, popularity, budget,
            runtime_minutes, {Q.genre_list('genre_text')} AS g FROM ({FILMS}))
    WHERE contains(lower(array_to_string(g, '|')), 'horror')
    QUALIFY row_number() OVER (PARTITION BY title, release_date ORDER BY tmdb_id) = 1""")
def split_csv(t):
    parts = films(t).select(
        F.col("k").alias("id"), "imdb_id", "title", "original_title", "overview", "release_date", "vote_average",
        "vote_count", "popularity", "poster_path", "budget", "revenue", F.col("runtime_minutes").alias("runtime"),
        F.col("genre_text").alias("genres"))
    # Rows that may share title and date stay in one file, in key order.
    path = written(
        parts.repartition(F.trim("title"), "release_date").sortWithinPartitions("id"), "split",
        lambda w, p: w.option("header", True).option("escape", '"').csv(p))
    read = spelled(files.read_split_csv(t.spark, path))
    return read.select(
        "source", "tmdb_id", "imdb_id", F.nullif("title", F.lit("")).alias("title"), "release_date", "vote_average",
        "popularity", "budget", "runtime_minutes", "genres")


# --- title TSV ----------------------------------------------------------------

BASICS = """
    SELECT concat('tt', p_partkey) AS tconst, CASE WHEN p_size % 5 = 0 THEN 'short' ELSE 'movie' END AS titleType,
        p_name AS primaryTitle, upper(p_name) AS originalTitle,
        CASE WHEN p_partkey % 9 = 0 THEN '\\N' ELSE concat(1950 + p_size, '') END AS startYear,
        CASE WHEN p_partkey % 7 = 0 THEN '\\N' ELSE concat(60 + p_size, '') END AS runtimeMinutes,
        CASE p_type WHEN 'PROMO' THEN 'Drama,Horror' WHEN 'LARGE' THEN 'Horror' WHEN 'SMALL' THEN 'horror'
             WHEN 'MEDIUM' THEN 'Horror,Thriller' ELSE '\\N' END AS genres
    FROM part"""


def _basics_path(t):
    cols = [c.replace("'\\N'", "'\\\\N'") for c in columns_of(BASICS)]
    b = t.part.selectExpr("p_partkey", *cols)
    # Every film is followed by a second row of the same id, which must lose, and by a
    # row that is too short.
    line = F.concat_ws("\t", "tconst", "titleType", "primaryTitle", "originalTitle", F.lit("0"), "startYear",
                       F.lit("\\N"), "runtimeMinutes", "genres")
    again = F.concat_ws("\t", "tconst", "titleType", F.lit("later"), "originalTitle", F.lit("0"), "startYear",
                        F.lit("\\N"), "runtimeMinutes", "genres")
    lines = b.select("p_partkey", F.posexplode(F.array(line, again, F.concat("tconst", F.lit("\tmovie")))).alias("i", "value"))
    header = t.spark.range(1).select(F.lit(-1).alias("p_partkey"), F.lit(0).alias("i"), F.lit("\t".join(files.BASICS_HEADER)).alias("value"))
    rows = header.unionByName(lines).repartition("p_partkey").sortWithinPartitions("p_partkey", "i")
    return written(rows.select("value"), "basics", lambda w, p: w.option("compression", "gzip").text(p))


def _ratings_path(t):
    line = F.concat_ws("\t", F.concat(F.lit("tt"), "l_partkey"), F.col("average"), F.col("votes"))
    r = t.lineitem.groupBy("l_partkey").agg(
        F.concat((F.sum(F.col("l_quantity").cast("int")) % 100).cast("string"), F.lit(".5")).alias("average"),
        F.sum("l_suppkey").alias("votes"))
    lines = r.select("l_partkey", line.alias("value"))
    header = t.spark.range(1).select(F.lit(-1).alias("l_partkey"), F.lit("\t".join(files.RATINGS_HEADER)).alias("value"))
    return written(header.unionByName(lines).select("value"), "ratings", lambda w, p: w.text(p))


RATINGS = """
    SELECT concat('tt', l_partkey) AS tconst,
        CAST(concat(CAST(sum(CAST(l_quantity AS INT)) % 100 AS BIGINT), '.5') AS DOUBLE) AS averageRating,
        CAST(sum(l_suppkey) AS BIGINT) AS numVotes
    FROM lineitem GROUP BY l_partkey"""


@query("title_basics", f"""
    SELECT tconst, titleType, primaryTitle, originalTitle, startYear, runtimeMinutes, genres
    FROM ({BASICS}) WHERE titleType = 'movie' AND contains(genres, 'Horror')""")
def title_basics(t):
    read = files.title_basics(files.read_tsv(t.spark, _basics_path(t), files.BASICS_HEADER))
    return read.drop("seq", "isAdult", "endYear")


@query("title_ratings", RATINGS)
def title_ratings(t):
    return files.title_ratings(files.read_tsv(t.spark, _ratings_path(t), files.RATINGS_HEADER))


@query("rated_titles", f"""
    SELECT 'imdb' AS source, tconst AS imdb_id, primaryTitle AS title, originalTitle AS original_title,
        concat(startYear, '-01-01') AS release_date, averageRating AS vote_average, numVotes AS vote_count,
        TRY_CAST(runtimeMinutes AS BIGINT) AS runtime_minutes, replace(genres, ',', '|') AS genres
    FROM ({BASICS}) JOIN ({RATINGS}) USING (tconst)
    WHERE titleType = 'movie' AND contains(genres, 'Horror') AND startYear <> '\\N' AND numVotes >= 1000""")
def rated_titles(t):
    read = files.read_titles(t.spark, _basics_path(t), _ratings_path(t))
    return spelled(read).select(
        "source", "imdb_id", "title", "original_title", "release_date", "vote_average", "vote_count",
        "runtime_minutes", "genres")


@query("orders_by_votes", f"""
    SELECT CAST(row_number() OVER (ORDER BY votes DESC) AS INT) AS place, votes FROM (
        SELECT numVotes AS votes FROM ({BASICS}) JOIN ({RATINGS}) USING (tconst)
        WHERE titleType = 'movie' AND contains(genres, 'Horror') AND startYear <> '\\N' AND numVotes >= 1000
        ORDER BY votes DESC LIMIT 25)""")
def orders_by_votes(t):
    """Votes of the first 25 titles, in the order in which the reader numbers them."""
    read = files.read_titles(t.spark, _basics_path(t), _ratings_path(t))
    first = preview(read.select("seq", "vote_count"), "seq", 25)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("seq", "vote_count"))), lambda r: r["vote_count"])
    return first.agg(in_order.alias("votes")).select(F.posexplode("votes").alias("at", "votes")).select(
        (F.col("at") + 1).alias("place"), "votes")


# --- landed HTML --------------------------------------------------------------

def listing_pages(t):
    """Listing pages of thirty cards, one card per part; some cards miss an element."""
    k = F.col("p_partkey")
    title = F.concat(F.lit('<span class="t" data-qa="discovery-media-list-item-title">\n <span>'), "p_name", F.lit("</span> &amp; <span><span/>co</span> </span><span>no</span>"))
    year = F.concat(F.lit("<span data-qa='discovery-media-list-item-start-year'>("), (F.col("p_size") + 1950).cast("string"), F.lit(")</span>"))
    score = F.concat(F.lit('<rt-text data-qa="tomatometer"><rt-text></rt-text><b>'), (k % 101).cast("string"), F.lit("%</b></rt-text>"))
    link = F.concat(F.lit('<a data-qa="discovery-media-list-item-caption" href="/m/'), k.cast("string"), F.lit('?a=1&amp;b=2">more</a>'))
    card = F.concat(
        F.lit('<div class="c" data-qa="discovery-media-list-item">'),
        F.when(k % 23 == 0, "").otherwise(title), F.when(k % 29 == 0, "").otherwise(year),
        F.when(k % 3 == 0, "").otherwise(score), F.when(k % 31 == 0, "").otherwise(link), F.lit("</div>"))
    by_page = t.part.select((F.floor(k / 30)).alias("page_id"), k.alias("k"), card.alias("card")).groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "card"))), lambda e: e["card"]), "\n").alias("cards"))
    return by_page.select(
        "page_id", F.concat(F.lit("/browse?page="), F.col("page_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), "cards", F.lit("<p>end</p></body></html>")).alias("html"))


CARDS = """
    SELECT concat(p_name, ' & co') AS title, concat(1950 + p_size, '-01-01') AS release_date,
        CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey % 101 AS DOUBLE) END AS tomatometer_score,
        concat('/m/', p_partkey, '?a=1&b=2') AS detail_url, p_partkey
    FROM part WHERE p_partkey % 23 <> 0 AND p_partkey % 29 <> 0 AND p_partkey % 31 <> 0"""


@query("listing_cards", f"SELECT * EXCLUDE (p_partkey) FROM ({CARDS})")
def listing_cards(t):
    return landed_html.listing_records(listing_pages(t)).select("title", "release_date", "tomatometer_score", "detail_url")


@query("first_cards", f"SELECT title, detail_url FROM ({CARDS}) ORDER BY p_partkey LIMIT {S.CARD_LIMIT}")
def first_cards(t):
    return landed_html.listing_records(listing_pages(t), S.CARD_LIMIT).select("title", "detail_url")


def detail_pages(t):
    """One detail page per ordered part; some miss the score or the consensus."""
    k = F.col("l_partkey")
    n = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        k.alias("page_id"), F.concat(F.lit("/m/"), k.cast("string"), F.lit("?a=1&b=2")).alias("url"),
        F.concat(
            F.lit("<html><body>"),
            F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("<span data-qa='audience-score'>"), F.col("n").cast("string"), F.lit("%</span>"))),
            F.when(k % 5 == 0, "").otherwise(F.concat(F.lit('<p data-qa="critics-consensus">Seen <p>at</p> <em>'), F.col("n").cast("string"), F.lit("</em>\n times</p>"))),
            F.lit("</body></html>")).alias("html"))


DETAILS = """
    SELECT concat('/m/', l_partkey, '?a=1&b=2') AS url,
        CASE WHEN l_partkey % 4 <> 0 THEN CAST(count(*) AS DOUBLE) END AS audience_score,
        CASE WHEN l_partkey % 5 <> 0 THEN concat('Seen at ', count(*), ' times') END AS critics_consensus
    FROM lineitem GROUP BY l_partkey"""


@query("detail_pages", DETAILS)
def detail_page_fields(t):
    return landed_html.details(detail_pages(t))


@query("cards_with_details", f"""
    SELECT title, release_date, tomatometer_score, detail_url, audience_score, critics_consensus
    FROM ({CARDS}) LEFT JOIN ({DETAILS}) ON url = detail_url""")
def cards_with_details(t):
    cards = landed_html.listing_records(listing_pages(t))
    return landed_html.with_details(cards, detail_pages(t)).select(
        "title", "release_date", "tomatometer_score", "detail_url", "audience_score", "critics_consensus")


# --- registry and gold files --------------------------------------------------

@query("source_registry", f"""
    SELECT source, 'success' AS status, count(*) AS rows, NULL AS message FROM ({FILMS}) WHERE source IN ('tmdb', 'imdb') GROUP BY source
    UNION ALL SELECT unnest(['rotten_tomatoes', 'spark', 'prices', 'late']), 'error', 0,
        unnest(['source is down', 'path not found', 'missing columns: title, release_date', 'row 7 is corrupt'])
    UNION ALL SELECT 'kaggle', 'skipped', 0, NULL""")
def source_registry(t):
    """Outcome of every source: two are read, one is down, one has no file, one lacks columns, one breaks while it is read."""
    def broken(spark):
        raise OSError("source is down")

    def late(spark):
        corrupt = F.when(F.col("seq.a") == 7, F.raise_error(F.lit("row 7 is corrupt"))).otherwise(F.col("title"))
        return raw_films(t).withColumn("title", corrupt)

    one = lambda name: lambda spark: raw_films(t).where(F.col("source") == name)
    readers = {
        "tmdb": one("tmdb"), "rotten_tomatoes": broken, "kaggle": one("kaggle"), "imdb": one("imdb"),
        "spark": lambda spark: files.read_split_csv(spark, f"{t.folder}/no-such-folder"),
        "prices": lambda spark: files.catalogue_records(t.part.selectExpr("p_retailprice AS price", "p_brand AS genre")),
        "late": late,
    }
    _, report = files.extract_all(t.spark, readers, skip={"kaggle"})
    # Spark puts its own words around a fault inside a task.
    own = F.regexp_extract("message", r"row \d+ is corrupt", 0)
    return report.withColumn("message", F.when(own != "", own).otherwise(F.col("message")))


@query("gold_export", f"""
    WITH {Q.NORMAL} SELECT source, tmdb_id, imdb_id, title, original_title, overview,
        strftime(release_date, '%Y-%m-%d') AS release_date, vote_average, vote_count, popularity, poster_path,
        tomatometer_score, audience_score, critics_consensus, budget, revenue, runtime_minutes,
        array_to_string(genres, '|') AS genres FROM normal""")
def gold_export(t):
    path = new_path(t.spark, "gold")
    load.export_gold(normalize_records(raw_films(t)), path)
    return files.read_gold(t.spark, path).withColumns({
        "release_date": F.col("release_date").cast("string"), "genres": F.array_join("genres", "|")})


@query("coerced_columns", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS n, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS budget,
        CASE WHEN l_returnflag <> 'A' THEN l_discount END AS vote_average FROM lineitem""")
def coerced_columns(t):
    # Fractions and words are bad values of a whole-number column, words of a number column.
    budget = F.when(F.col("l_linenumber") % 2 == 0, F.concat("l_partkey", F.lit(".0"))).otherwise(F.concat("l_partkey", F.lit(".5")))
    vote = F.when(F.col("l_returnflag") == "A", "bad").otherwise(F.col("l_discount").cast("string"))
    rows = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("n"), budget.alias("budget"), vote.alias("vote_average"))
    public = load.export_columns(rows.withColumn("source", F.to_json(F.struct("l_orderkey", "n"))))
    key = F.from_json("source", "l_orderkey bigint, n bigint")
    return public.select(key.alias("k"), "budget", "vote_average").select("k.l_orderkey", "k.n", "budget", "vote_average")


@query("lists_as_json", f"""
    SELECT k, CAST(to_json({Q.genre_list('genre_text')}) AS VARCHAR) AS genres FROM ({FILMS})""")
def lists_as_json(t):
    return load.lists_to_json(raw_films(t).select(F.col("seq.a").alias("k"), "genres"))
