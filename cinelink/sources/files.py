"""Readers of API pages, catalogue CSV, split CSV and title TSV files."""

from contextvars import ContextVar
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelink import schema as S
from cinelink.functions import dates, numbers, text
from cinelink.operators.dedup import keep_first
from cinelink.operators.filters import genre_filter
from cinelink.operators.profile import counted

# Header synonyms of the catalogue CSV, in order of preference.
CATALOGUE_HEADER = {
    "id": "tmdb_id",
    "imdb_id": "imdb_id",
    "title": "title",
    "original_title": "original_title",
    "overview": "overview",
    "description": "overview",
    "release_date": "release_date",
    "year": "release_date",
    "vote_average": "vote_average",
    "rating": "vote_average",
    "vote_count": "vote_count",
    "votes": "vote_count",
    "popularity": "popularity",
    "poster_path": "poster_path",
    "budget": "budget",
    "revenue": "revenue",
    "runtime": "runtime_minutes",
    "runtime (minutes)": "runtime_minutes",
    "genres": "genres",
    "genre": "genres",
}
CATALOGUE_REQUIRED = ["title", "release_date"]

# Header of the split CSV.
SPLIT_HEADER = {
    "id": "tmdb_id",
    "imdb_id": "imdb_id",
    "title": "title",
    "original_title": "original_title",
    "overview": "overview",
    "release_date": "release_date",
    "vote_average": "vote_average",
    "vote_count": "vote_count",
    "popularity": "popularity",
    "poster_path": "poster_path",
    "budget": "budget",
    "revenue": "revenue",
    "runtime": "runtime_minutes",
    "genres": "genres",
}

# Columns of the title files.
BASICS_HEADER = [
    "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear", "endYear",
    "runtimeMinutes", "genres",
]
RATINGS_HEADER = ["tconst", "averageRating", "numVotes"]

API_PAGE = (
    "page INT, total_pages INT, total_results INT, results ARRAY<STRUCT<"
    "id BIGINT, title STRING, original_title STRING, overview STRING, release_date STRING,"
    "vote_average DOUBLE, vote_count BIGINT, popularity DOUBLE, poster_path STRING,"
    "runtime BIGINT, adult BOOLEAN, genre_ids ARRAY<INT>>>"
)


def file_order():
    """Position of a row in its file: stable under retries and other split sizes.

    Only valid in the select directly above a file scan, where the running number
    counts the rows of the block.
    """
    return S.seq_key(
        F.xxhash64(F.col("_metadata.file_path")),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    )


# Why a reader that is run by `extract_all` returns nothing.
_reasons = ContextVar("reasons", default=None)


def explain(reason):
    """Tell `extract_all`, if it is what runs the reader, why a source is empty."""
    if _reasons.get() is not None:
        _reasons.get().append(reason)


def or_empty(spark, read, schema):
    """The reader's DataFrame, or an empty one when the path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        explain("path not found" if e.getCondition() == "PATH_NOT_FOUND" else "no file with a header found")
        return S.empty(spark, schema)


# --- API pages ---------------------------------------------------------------

def api_movies(pages, max_pages=None, genre_id=S.API_GENRE_ID, genre_name="Horror"):
    """Landed result pages to records of one genre; all pages, or up to a cap."""
    last = F.coalesce("total_pages", F.lit(1))
    films = pages.where(
        F.col("page") <= (last if max_pages is None else F.least(last, F.lit(max_pages)))
    ).select("page", F.posexplode("results").alias("i", "m"))
    in_genre = F.coalesce(F.array_contains("m.genre_ids", genre_id), F.lit(True))
    films = films.where(in_genre & ~F.coalesce("m.adult", F.lit(False)))
    return films.select(
        F.lit("tmdb").alias("source"),
        S.seq_key(F.col("page"), F.col("i")).alias("seq"),
        F.col("m.id").alias("tmdb_id"),
        F.col("m.runtime").alias("runtime_minutes"),
        F.when(F.array_contains("m.genre_ids", genre_id), F.array(F.lit(genre_name))).alias("genres"),
        *[f"m.{c}" for c in (
            "title", "original_title", "overview", "release_date", "vote_average", "vote_count",
            "popularity", "poster_path",
        )],
    ).transform(S.conform, S.RAW)


def read_api_pages(spark, path, max_pages=None, genre_id=S.API_GENRE_ID, genre_name="Horror"):
    return or_empty(
        spark, lambda: api_movies(spark.read.schema(API_PAGE).json(path), max_pages, genre_id, genre_name), S.RAW
    )


# --- catalogue CSV -----------------------------------------------------------

def lower_header(df):
    """Lower-case header; of two equal names the first one stays."""
    seen, picked = set(), []
    for c in df.columns:
        if c.lower() not in seen:
            seen.add(c.lower())
            picked.append(F.col(f"`{c}`").alias(c.lower()))
    return df.select(*picked)


def rename_synonyms(df, synonyms):
    """One text column per target field: its first filled synonym, else null."""
    targets = list(dict.fromkeys(synonyms.values()))
    names = {t: [h for h, x in synonyms.items() if x == t and h in df.columns] for t in targets}
    return df.select(
        *[c for c in df.columns if c == "seq"],
        *[
            F.coalesce(*[F.col(f"`{h}`").cast("string") for h in names[t]], F.lit(None).cast("string")).alias(t)
            for t in targets
        ],
    )


def typed_record(df, source):
    """Text columns to the canonical record."""
    typed = {
        **{c: numbers.safe_long(F.col(c)) for c in S.LONG_FIELDS},
        **{c: numbers.safe_double(F.col(c)) for c in ("vote_average", "popularity")},
        **{c: F.trim(c) for c in ("title", "original_title")},
        "genres": text.parse_genres(F.col("genres")),
        "source": F.lit(source),
    }
    return df.withColumns(typed).transform(S.conform, S.RAW)


def has_quoted_breaks(spark, path):
    """Whether a line of a CSV file holds an odd number of quotes, as lines of records with quoted line breaks do."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_catalogue_csv(spark, path, source="kaggle", term=S.GENRE_TERM, multiline=None):
    """Catalogue CSV with any known header spelling.

    `multiline` keeps quoted line breaks, at the price of one task per file. By default a
    scan, which splits files, looks whether there are any; with False they end a record.
    """
    def read():
        split = has_quoted_breaks(spark, path) if multiline is None else multiline
        raw = (
            spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
            .option("multiLine", split).csv(path)
        )
        cells = raw.select(
            *[dates.null_tokens(F.col(f"`{c}`"), S.CSV_NULL_TOKENS).alias(c) for c in raw.columns],
            file_order().alias("seq"),
        )
        return catalogue_records(lower_header(cells), source, term)

    return or_empty(spark, read, S.RAW)


def catalogue_records(cells, source="kaggle", term=S.GENRE_TERM):
    """Text table with a `seq` column to records; empty when a required column is missing."""
    named = {CATALOGUE_HEADER.get(c) for c in cells.columns}
    missing = [c for c in CATALOGUE_REQUIRED if c not in named]
    if missing:
        explain(f"missing columns: {', '.join(missing)}")
        return S.empty(cells.sparkSession, S.RAW)
    records = typed_record(rename_synonyms(cells, CATALOGUE_HEADER), source)
    if "genres" in named:
        records = genre_filter(records, term)
    return keep_first(records, ["title", "release_date"])


def read_split_csv(spark, path, source="spark", term=S.GENRE_TERM):
    """Directory of CSV parts sharing one header."""
    def read():
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
        return split_records(raw.select("*", file_order().alias("seq")), source, term)

    return or_empty(spark, read, S.RAW)


def split_records(cells, source="spark", term=S.GENRE_TERM):
    records = typed_record(rename_synonyms(cells, SPLIT_HEADER), source)
    if "genres" in cells.columns:
        records = genre_filter(records, term)
    return keep_first(records, ["title", "release_date"])


# --- title TSV ---------------------------------------------------------------

def tsv_columns(spark, path, header):
    """Where the columns of `header` stand: by the file's own header line, else in the order of `header`."""
    cells = F.split(F.regexp_replace("value", rf"^{text.BLANK}+|{text.BLANK}+$", ""), "\t")
    named = spark.read.text(path).select(cells.alias("f")).where(F.array_contains("f", header[0])).limit(1).collect()
    found = named[0]["f"] if named else []
    missing = [h for h in header if h not in found]
    if missing and named:
        explain(f"missing columns: {', '.join(missing)}")
        return None
    return [found.index(h) for h in header] if named else list(range(len(header)))


def read_tsv(spark, path, header):
    """Tab-separated text, plain or gzipped, with its columns in any order.

    Rows shorter than the header are dropped; a header without one of the columns makes the source empty.
    """
    def read():
        places = tsv_columns(spark, path, header)
        if places is None:
            return S.empty(spark, layout)
        line = F.regexp_replace("value", rf"^{text.BLANK}+|{text.BLANK}+$", "")
        rows = spark.read.text(path).select(F.split(line, "\t").alias("f"), file_order().alias("seq"))
        return rows.where(
            (F.size("f") > max(places)) & (F.size("f") >= len(header)) & (F.col("f")[places[0]] != header[0])
        ).select(*[F.col("f")[i].alias(h) for i, h in zip(places, header)], "seq")

    layout = T.StructType([T.StructField(h, T.StringType()) for h in header]).add("seq", S.SEQ)
    return or_empty(spark, read, layout)


def title_basics(rows, genre="Horror"):
    """Films of one genre, first row per id. The genre test is case-sensitive."""
    films = rows.where((F.col("titleType") == "movie") & F.col("genres").contains(genre))
    return keep_first(films, ["tconst"])


def title_ratings(rows):
    """First row per id, typed."""
    first = keep_first(rows, ["tconst"])
    return first.select(
        "tconst",
        numbers.safe_double(F.col("averageRating")).alias("averageRating"),
        numbers.strict_long(F.col("numVotes")).alias("numVotes"),
    )


def rated_titles(basics, ratings, min_votes=S.MIN_VOTES, genre="Horror"):
    """Films of the genre with enough votes and a known year, most voted first by `seq`."""
    films = basics.where(
        F.col("genres").contains(genre)
        & (F.col("titleType") == "movie")
        & (F.col("startYear") != "\\N")
    ).drop("seq")
    rated = films.join(ratings.where(F.col("numVotes") >= min_votes), "tconst")
    return rated.select(
        F.lit("imdb").alias("source"),
        S.seq_key(-F.col("numVotes"), F.xxhash64("tconst")).alias("seq"),
        F.col("tconst").alias("imdb_id"),
        F.trim("primaryTitle").alias("title"),
        F.trim("originalTitle").alias("original_title"),
        dates.year_start(F.col("startYear")).alias("release_date"),
        F.col("averageRating").alias("vote_average"),
        F.col("numVotes").alias("vote_count"),
        numbers.strict_long(F.col("runtimeMinutes")).alias("runtime_minutes"),
        F.filter(F.split("genres", ","), lambda g: g != "\\N").alias("genres"),
    ).transform(S.conform, S.RAW)


def read_titles(spark, basics_path, ratings_path, min_votes=S.MIN_VOTES):
    basics = title_basics(read_tsv(spark, basics_path, BASICS_HEADER))
    ratings = title_ratings(read_tsv(spark, ratings_path, RATINGS_HEADER))
    return rated_titles(basics, ratings, min_votes)


# --- registry ----------------------------------------------------------------

def extract_all(spark, readers, skip=()):
    """Union of all sources not skipped, and a row (source, status, rows, message) for each.

    `readers` maps a source name to a function of the session. Every source is read
    and stored here, so one that fails while it is read counts as empty as well, and
    the others go on. Status is skipped, success or error; the message of an error says
    what failed, which columns are missing or that there is no file. Rows are counted by
    the write.
    """
    frames, status = [], []
    for name, read in readers.items():
        if name in skip:
            status.append((name, "skipped", 0, None))
            continue
        reasons = []
        token = _reasons.set(reasons)
        try:
            stored, rows, _ = counted(read(spark).transform(S.conform, S.RAW), f"source-{name}")
            frames.append(stored)
            status.append((name, "error" if reasons else "success", rows, "; ".join(reasons) or None))
        except Exception as e:
            status.append((name, "error", 0, (str(e).splitlines() or [type(e).__name__])[0]))
        finally:
            _reasons.reset(token)
    report = spark.createDataFrame(status, "source string, status string, rows long, message string")
    if not frames:
        return S.empty(spark, S.RAW), report
    return reduce(lambda a, b: a.unionByName(b), frames), report


def read_gold(spark, path):
    return spark.read.parquet(path)
