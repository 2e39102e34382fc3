"""Extraction from landed listing and detail pages (columns: page_id, url, html)."""

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import numbers, text
from cinelink.sources.files import or_empty

# Markers of the page layout.
CARD = "discovery-media-list-item"
CARD_TITLE = "discovery-media-list-item-title"
CARD_YEAR = "discovery-media-list-item-start-year"
CARD_LINK = "discovery-media-list-item-caption"
TOMATOMETER = "tomatometer"
AUDIENCE = "audience-score"
CONSENSUS = "critics-consensus"


def _open_tag(element, marker):
    return rf"<{element}\b[^>]*\bdata-qa\s*=\s*[\"']{marker}[\"'][^>]*>"


def _inside(rest, name):
    """What stands before the tag that closes element `name`; null when nothing closes it.

    Elements of the same name may be nested inside.
    """
    # Every piece but the first starts with an opening or closing tag of that name.
    pieces = F.split(rest, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"(?![\w-]))")))

    def step(seen, piece):
        opens = F.when(piece.startswith("</"), -1).when(piece.rlike(r"^<[^>]*/>"), 0).otherwise(1)
        depth = (seen["depth"] + opens).cast("int")
        still = F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(seen["text"], piece)).otherwise(
            seen["text"]).alias("text"))
        return F.when(seen["depth"] == 0, seen).otherwise(still)

    # The text starts with a blank, so the first piece is never a tag.
    start = F.struct(F.lit(1).alias("depth"), F.element_at(pieces, 1).alias("text"))
    return F.aggregate(
        F.slice(pieces, F.lit(2), F.size(pieces)), start, step, lambda seen: F.when(seen["depth"] == 0, seen["text"]))


def element_text(html, marker, element=r"[A-Za-z][\w-]*"):
    """Text of the first element carrying the marker, nested elements included; null when there is none."""
    pattern = rf"(?s)<({element})\b[^>]*\bdata-qa\s*=\s*[\"']{marker}[\"'][^>]*>(.*)$"
    inner = _inside(F.concat(F.lit(" "), F.regexp_extract(html, pattern, 2)), F.regexp_extract(html, pattern, 1))
    plain = F.trim(F.regexp_replace(text.strip_markup(inner), text.BLANK + "+", " "))
    return F.when(html.rlike(pattern), plain)


def cards(pages):
    """One row per card of a listing page; cards without title, year or link are dropped."""
    piece = F.split("html", "(?s)" + _open_tag("div", CARD))
    found = pages.select("page_id", F.posexplode(piece).alias("i", "card")).where("i > 0")
    link = F.regexp_extract("card", "(?s)" + _open_tag("a", CARD_LINK), 0)
    href = F.regexp_extract(link, r"\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)
    card = F.col("card")
    return found.select(
        S.seq_key(F.col("page_id"), F.col("i")).alias("seq"),
        element_text(card, CARD_TITLE, "span").alias("title"),
        element_text(card, CARD_YEAR, "span").alias("year_text"),
        numbers.score_from_text(element_text(card, TOMATOMETER)).alias("tomatometer_score"),
        F.when(link != "", text.decode_entities(href)).alias("detail_url"),
    ).where("title is not null and year_text is not null and detail_url is not null").select(
        "seq", "title", numbers.year_from_text(F.col("year_text")).alias("year"),
        "tomatometer_score", "detail_url",
    )


def details(pages):
    """Audience score and consensus per detail page, the first page of each address."""
    html = F.col("html")
    found = pages.select(
        "url", "page_id",
        F.struct(
            numbers.score_from_text(element_text(html, AUDIENCE)).alias("audience_score"),
            element_text(html, CONSENSUS).alias("critics_consensus"),
        ).alias("found"),
    )
    # Pages are read before they are shuffled, so two short fields travel instead of the page.
    return found.groupBy("url").agg(F.min_by("found", "page_id").alias("found")).select("url", "found.*")


def listing_records(pages, limit=None):
    """Cards as canonical records, the first `limit` in page order when given."""
    found = cards(pages)
    if limit is not None:
        found = found.orderBy("seq").limit(limit)
    return found.select(
        F.lit("rotten_tomatoes").alias("source"),
        "seq",
        "title",
        F.col("title").alias("original_title"),
        F.when(
            F.col("year").between(1, 9999), F.make_date("year", F.lit(1), F.lit(1))
        ).alias("release_date"),
        "tomatometer_score",
        "detail_url",
    ).transform(S.conform, S.RAW)


def with_details(records, detail_pages):
    """Fill audience score and consensus from the record's detail page."""
    extra = details(detail_pages)
    plain = records.drop("audience_score", "critics_consensus")
    return plain.join(
        extra.withColumnRenamed("url", "detail_url"), "detail_url", "left"
    ).transform(S.conform, S.RAW)


def read_landed_pages(spark, listings, detail_pages=None, limit=None):
    """Records from folders of landed pages, Parquet with page_id, url and html."""
    def read():
        records = listing_records(spark.read.parquet(listings), limit)
        return records if detail_pages is None else with_details(records, spark.read.parquet(detail_pages))

    return or_empty(spark, read, S.RAW)
