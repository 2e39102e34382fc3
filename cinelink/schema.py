"""Canonical record, target tables and the fixed rules attached to them."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source labels in descending priority.
SOURCES = ["tmdb", "rotten_tomatoes", "kaggle", "imdb", "spark"]
UNKNOWN_PRIORITY = 99

# Sources whose extraction already applies the theme.
PREFILTERED_SOURCES = ["tmdb", "imdb", "spark"]

# Null tokens of the catalogue CSV.
CSV_NULL_TOKENS = ["", "N/A", "NA", "null", "None"]

# Thematic keywords, genre term, genre id of the API.
THEME_KEYWORDS = ["horror", "gore", "horreur", "épouvante", "slasher"]
GENRE_TERM = "horror"
API_GENRE_ID = 27

# Default parameters.
API_MAX_PAGES = 20
MIN_VOTES = 1000
FUZZY_THRESHOLD = 85.0
CARD_LIMIT = 50

# Fields counted by the completeness score.
COMPLETENESS_FIELDS = [
    "overview", "release_date", "vote_average", "vote_count", "poster_path", "runtime_minutes",
]

# Survivorship. A field not listed keeps the master's value.
FILL_FROM_ANY = [
    "overview", "vote_average", "vote_count", "runtime_minutes", "budget", "revenue",
    "poster_path", "tmdb_id", "imdb_id",
]
FILL_FROM_SOURCE = {
    "tomatometer_score": "rotten_tomatoes",
    "audience_score": "rotten_tomatoes",
    "critics_consensus": "rotten_tomatoes",
    "popularity": "spark",
}
MASTER_ONLY = ["source", "title", "original_title", "release_date", "title_norm", "genres"]

LONG_FIELDS = ["tmdb_id", "vote_count", "runtime_minutes", "budget", "revenue"]
DOUBLE_FIELDS = ["vote_average", "popularity", "tomatometer_score", "audience_score"]

# Ordering key inside a source. Three numbers are enough for page/index, votes/id
# and file/block/row, and compare quickly inside joins and aggregates.
SEQ = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "c")])

# What a reader returns: dates and bytes are still as the source wrote them.
RAW = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("seq", SEQ),
    T.StructField("tmdb_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("tomatometer_score", T.DoubleType()),
    T.StructField("audience_score", T.DoubleType()),
    T.StructField("critics_consensus", T.StringType()),
    T.StructField("budget", T.LongType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("runtime_minutes", T.LongType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("detail_url", T.StringType()),
])

MOVIES = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("tmdb_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("runtime_minutes", T.LongType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("budget", T.LongType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("sources", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
GENRES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("tmdb_genre_id", T.LongType()),
])
MOVIE_GENRES = T.StructType([
    T.StructField("movie_id", T.StringType(), False),
    T.StructField("genre_id", T.LongType(), False),
])
RATINGS = T.StructType([
    T.StructField("movie_id", T.StringType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("scale", T.StringType()),
])
RT_DETAILS = T.StructType([
    T.StructField("movie_id", T.StringType(), False),
    T.StructField("tomatometer_score", T.DoubleType()),
    T.StructField("audience_score", T.DoubleType()),
    T.StructField("critics_consensus", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
])
INGESTION_LOGS = T.StructType([
    T.StructField("movie_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_ingested", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
TARGET_TABLES = {
    "movies": MOVIES,
    "genres": GENRES,
    "movie_genres": MOVIE_GENRES,
    "ratings": RATINGS,
    "rt_details": RT_DETAILS,
    "ingestion_logs": INGESTION_LOGS,
}

# Status labels and column lengths of the target tables.
LOG_STATUS = ["success", "partial", "error"]
MAX_LENGTHS = {
    "movies": {"title": 500, "original_title": 500, "poster_path": 500, "imdb_id": 20, "sources": 200},
    "genres": {"name": 100},
    "ingestion_logs": {"source_name": 50},
}


def seq_key(a, b=None, c=None):
    """Ordering key of a record inside its source."""
    zero = F.lit(0)
    parts = [a, zero if b is None else b, zero if c is None else c]
    return F.struct(*[p.cast("bigint").alias(n) for p, n in zip(parts, "abc")])


def source_priority(source):
    """Rank of a source label, unknown labels last."""
    rank = F.lit(UNKNOWN_PRIORITY)
    for i, name in reversed(list(enumerate(SOURCES))):
        rank = F.when(source == name, i).otherwise(rank)
    return rank


def conform(df, schema):
    """Select exactly the columns of `schema`; absent ones become typed nulls."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def empty(spark, schema):
    return spark.createDataFrame([], schema)
