"""Row filters by genre, theme and title."""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import text


def genre_filter(df, term=S.GENRE_TERM):
    """Rows with a genre containing the term; all rows when there is no genre column."""
    if "genres" not in df.columns:
        return df
    return df.where(text.has_genre(F.col("genres"), term))


def thematic_filter(df, keywords=S.THEME_KEYWORDS, prefiltered=S.PREFILTERED_SOURCES):
    """Keep pre-filtered sources, else a keyword in the genres, title or overview."""
    genres = (
        F.concat_ws(" ", "genres")
        if dict(df.dtypes)["genres"].startswith("array") else F.col("genres")
    )
    told = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("overview", F.lit("")))
    return df.where(
        F.coalesce(F.col("source").isin(prefiltered), F.lit(False))
        | text.mentions(genres, keywords)
        | text.mentions(told, keywords)
    )


def title_contains(df, word):
    return df.where(F.lower("title").contains(word.lower()))


def missing_overview(df):
    """Entities no source gave an overview for, with their contributors."""
    return df.where(F.col("overview").isNull()).select("title", "sources")
