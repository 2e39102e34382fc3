"""Entry point for landed files: every source has a reader, and failures stay with their source."""

import pytest
from pyspark.sql import functions as F

from cinelink.plans.ingest import file_readers
from cinelink.sources import files

CARD = (
    '<div data-qa="discovery-media-list-item"><a data-qa="discovery-media-list-item-caption" href="/m/{0}">'
    '<span data-qa="discovery-media-list-item-title">Film {0}</span>'
    '<span data-qa="discovery-media-list-item-start-year">2001</span><b data-qa="tomatometer">7{0}%</b></a></div>')


def test_landed_pages_have_a_reader(spark, tmp_path):
    listing, detail = str(tmp_path / "lists"), str(tmp_path / "details")
    schema = "page_id long, url string, html string"
    spark.createDataFrame([(1, "l", "<body>" + CARD.format(1) + CARD.format(2))], schema).write.parquet(listing)
    spark.createDataFrame(
        [(5, "/m/1", '<i data-qa="audience-score">55%</i>'), (6, "/m/1", '<i data-qa="audience-score">66%</i>')], schema).write.parquet(detail)
    readers = file_readers({"rotten_tomatoes": (listing, detail)})
    raw, status = files.extract_all(spark, readers)
    got = {r["title"]: (r["tomatometer_score"], r["audience_score"]) for r in raw.collect()}
    assert got == {"Film 1": (71.0, 55.0), "Film 2": (72.0, None)}
    assert status.first()["status"] == "success"
    raw, _ = files.extract_all(spark, file_readers({"rotten_tomatoes": (listing, detail)}, {"rotten_tomatoes": {"limit": 1}}))
    assert raw.count() == 1


def test_unknown_source_raises():
    with pytest.raises(ValueError, match="nowhere"):
        file_readers({"nowhere": "x"})


def test_source_that_fails_while_it_is_read_is_left_out(spark, tmp_path):
    path = tmp_path / "ok"
    spark.createDataFrame([(1, "l", CARD.format(3))], "page_id long, url string, html string").write.parquet(str(path))
    good = file_readers({"rotten_tomatoes": str(path)})["rotten_tomatoes"]

    def late(session):
        return good(session).withColumn("title", F.raise_error(F.lit("lost while reading")).cast("string"))

    raw, status = files.extract_all(spark, {"a": late, "b": good})
    assert raw.count() == 1
    assert {r["source"]: r["status"] for r in status.collect()} == {"a": "error", "b": "success"}
    assert "lost while reading" in status.where("source = 'a'").first()["message"]
