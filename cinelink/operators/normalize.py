"""Record normaliser: raw reader output to clean, typed records."""

from pyspark.sql import functions as F

from cinelink.functions import dates, numbers, text


def normalize_records(df):
    """Clean dates, scores and texts and add the match key `title_norm`.

    Votes are range-checked for the two ten-point sources only.
    """
    votes = F.when(
        F.col("source").isin("tmdb", "imdb"),
        numbers.clamp(F.col("vote_average"), numbers.TEN_POINT),
    ).otherwise(F.col("vote_average"))
    clean = df.withColumns({
        "release_date": dates.parse_date(F.col("release_date")),
        "vote_average": votes,
        "tomatometer_score": numbers.clamp(F.col("tomatometer_score"), numbers.PERCENT),
        "audience_score": numbers.clamp(F.col("audience_score"), numbers.PERCENT),
        "imdb_id": F.nullif(F.col("imdb_id"), F.lit("")),
        **{c: text.clean_text(F.col(c)) for c in (
            "title", "original_title", "overview", "critics_consensus",
        )},
    })
    # Matching keys come from the cleaned title.
    return clean.withColumn("title_norm", text.title_key(F.col("title")))
