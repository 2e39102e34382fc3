"""Registered queries against their SQL statements in DuckDB, over the smallest tables."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import cinelink.plans as plans
from cinelink.operators import load
from cinelink.plans.catalogue import raw_films
from cinelink.plans.load_queries import entities, loaded_tables
from cinelink.plans.registry import Tables

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import compare, database  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not there")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", plans.QUERIES)
def test_query_equals_sql(spark, con, name):
    message, _ = compare(spark, con, name, FOLDER)
    assert message is None, message


def test_page_text_leaves_references_cut_off_as_written(spark, tmp_path):
    texts = ["<p>a&amp&amp; b &am &amp</p> &copy; &quo", "<i>&lt;b&gt &quot;x&quot;</i>&middot", "x &amp &amp;", None]
    rows = [(i, x, x) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "page_id long, html string, text string").write.parquet(f"{tmp_path}/rows")
    con = duckdb.connect()
    for table, key in (("pages", "page_id"), ("documents", "doc_id")):
        spark.read.parquet(f"{tmp_path}/rows").withColumnRenamed("page_id", key).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name in ("page_text", "clean_texts", "title_keys"):
        message, n = compare(spark, con, name, str(tmp_path))
        assert message is None and n == len(texts), message


def test_rows_of_a_small_file_are_dealt_over_tasks(spark):
    t = Tables(spark, FOLDER)
    rows = [r[0] for r in t.part.select("p_partkey").collect()]
    for df in (raw_films(t).select(F.col("seq.a").alias("k")), entities(t)):
        dealt = df.select("k", F.spark_partition_id().alias("task")).collect()
        assert sorted(r["k"] for r in dealt) == sorted(rows)
        assert len({r["task"] for r in dealt}) == 8


def test_a_load_judges_its_rows_once(spark):
    t = Tables(spark, FOLDER)
    rows = load.movie_rows(entities(t))
    good, bad = load.split_rejected(rows, "rows")
    assert good.inputFiles() == bad.inputFiles() and "reasons" not in [*good.columns, *bad.columns]
    wrong = {r["k"] for r in rows.where("tomatometer_score > 100 or audience_score > 100").select("k").collect()}
    assert wrong and {r["k"] for r in bad.select("k").collect()} == wrong
    assert good.count() + len(wrong) == t.part.count()
    # The log's rejected rows come from the stored ones too, not from a second pass over the source.
    assert not [f for f in loaded_tables(t)["ingestion_logs"].inputFiles() if f.endswith("/part.parquet")]
