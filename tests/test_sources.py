"""Readers over small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators.profile import histogram, quantiles
from cinelink.sources import files, landed_html


def test_api_pages(spark, tmp_path):
    film = lambda i, **more: {"id": i, "title": f" T{i} ", "popularity": 1.5, **more}
    pages = [
        {"page": 1, "total_pages": 3, "results": [film(1, genre_ids=[27]), film(2, adult=True)]},
        {"page": 2, "total_pages": 3, "results": [film(3, genre_ids=[18]), film(4)]},
        {"page": 3, "total_pages": 3, "results": [film(5)]},
    ]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    got = files.read_api_pages(spark, str(tmp_path), max_pages=2).orderBy("seq").collect()
    assert [r.tmdb_id for r in got] == [1, 4]
    assert files.read_api_pages(spark, str(tmp_path)).count() == 3
    assert got[0].genres == ["Horror"]


def test_catalogue_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        b'ID,Title,Year,RATING,Votes,Runtime (Minutes),Genre,overview,Description\n'
        b'1,"The ""Thing""",1982,8.2,18000.9,109,"Horror, Drama",,"line\nbreak"\n'
        b'2,Comedy,1990,5,1,90,Comedy,,\n'
        b'x,"The ""Thing""",1982,n.a.,None,100,horror,kept,lost\n'
        b'3,Caf\xe9,N/A,7,10,,HORROR,,\n')
    got = files.read_catalogue_csv(spark, str(tmp_path / "a.csv")).orderBy("seq").collect()
    assert [(r.tmdb_id, r.title, r.release_date) for r in got] == [(1, 'The "Thing"', "1982"), (3, "Caf�", None)]
    assert (got[0].vote_count, got[0].vote_average, got[0].runtime_minutes) == (18000, 8.2, 109)
    assert (got[0].genres, got[0].overview) == (["Horror", "Drama"], "line\nbreak")


def test_catalogue_csv_without_required_column_or_file_is_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title\n1,x\n")
    assert files.read_catalogue_csv(spark, str(tmp_path / "a.csv")).count() == 0
    (tmp_path / "plain.csv").write_text("title,year,genre\n\"a \"\"b\"\"\",1990,horror\n")
    (tmp_path / "breaks.csv").write_text('title,year,genre\n"a\nb",1990,horror\n')
    assert not files.has_quoted_breaks(spark, str(tmp_path / "plain.csv")) and files.has_quoted_breaks(spark, str(tmp_path / "breaks.csv"))
    assert files.read_catalogue_csv(spark, str(tmp_path / "plain.csv")).first().title == 'a "b"'
    missing = files.read_catalogue_csv(spark, str(tmp_path / "no.csv"))
    assert missing.count() == 0 and missing.schema == S.RAW


def test_split_csv(spark, tmp_path):
    head = "id,imdb_id,title,release_date,genres,extra\n"
    (tmp_path / "a.csv").write_text(head + "1,tt1,It,2017-09-08,Horror,e\n2,tt2,Up,2009,Family,e\n")
    (tmp_path / "b.csv").write_text(head + "3,tt3,Saw,2004,\"Horror, Crime\",e\n4,tt4,Saw,2004,Horror,e\n")
    got = files.read_split_csv(spark, str(tmp_path)).collect()
    assert sorted((r.tmdb_id, r.source) for r in got) == [(1, "spark"), (3, "spark")]


def test_titles(spark, tmp_path):
    row = lambda *c: "\t".join(c) + "\n"
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write(row(*files.BASICS_HEADER))
        f.write(row("tt1", "movie", '"Quoted', "O", "0", "1980", "\\N", "144", "Drama,Horror"))
        f.write(row("tt1", "movie", "Second", "O", "0", "1981", "\\N", "1", "Horror"))
        f.write(row("tt2", "short", "S", "S", "0", "1980", "\\N", "1", "Horror"))
        f.write(row("tt3", "movie", "H", "H", "0", "\\N", "\\N", "\\N", "Horror"))
        f.write(row("tt4", "movie", "lower", "H", "0", "1980", "\\N", "\\N", "horror"))
        f.write(row("tt5", "movie", "too short", "Horror"))
        f.write(row("tt6", "movie", "Few", "F", "0", "1999", "\\N", "x", "Horror"))
    (tmp_path / "r.tsv").write_text(
        row(*files.RATINGS_HEADER) + row("tt1", "8.4", "950000") + row("tt1", "1.0", "5") + row("tt2", "9", "5000")
        + row("tt3", "9", "5000") + row("tt4", "9", "5000") + row("tt6", "5.0", "999") + row("tt7"))
    got = files.read_titles(spark, str(tmp_path / "b.tsv.gz"), str(tmp_path / "r.tsv")).collect()
    assert [(r.imdb_id, r.title, r.release_date, r.vote_average, r.vote_count, r.runtime_minutes, r.genres) for r in got] == [
        ("tt1", '"Quoted', "1980-01-01", 8.4, 950000, 144, ["Drama", "Horror"])]
    assert files.read_titles(spark, str(tmp_path / "b.tsv.gz"), str(tmp_path / "r.tsv"), min_votes=999).count() == 2
    assert files.read_titles(spark, str(tmp_path / "none"), str(tmp_path / "r.tsv")).count() == 0


CARD = """<div class=x data-qa="discovery-media-list-item"><a href="{url}" data-qa="discovery-media-list-item-caption">
 {title}<span data-qa='discovery-media-list-item-start-year'>{year}</span>{score}</a></div>"""
NAME = '<span data-qa="discovery-media-list-item-title"> {} </span>'


def test_landed_pages(spark):
    listing = "".join([
        CARD.format(url="/m/a?x=1&amp;y=2", title=NAME.format("A &amp; B"), year="1980", score='<i data-qa="tomatometer">84%</i>'),
        CARD.format(url="/m/b", title="", year="1981", score=""),
        CARD.format(url="/m/c", title=NAME.format("C"), year="soon", score=""),
    ])
    pages = spark.createDataFrame([(1, "/l", listing)], "page_id long, url string, html string")
    got = landed_html.listing_records(pages).orderBy("seq").collect()
    assert [(r.title, r.release_date, r.tomatometer_score, r.detail_url) for r in got] == [
        ("A & B", "1980-01-01", 84.0, "/m/a?x=1&y=2"), ("C", None, None, "/m/c")]
    assert landed_html.listing_records(pages, 1).count() == 1
    detail = '<p data-qa="critics-consensus">Dread <em>filled</em>.</p><b data-qa="audience-score">94%</b>'
    details = spark.createDataFrame(
        [(7, "/m/c", detail), (8, "/m/c", "<p>later copy</p>")], "page_id long, url string, html string")
    full = landed_html.with_details(landed_html.listing_records(pages), details).orderBy("seq").collect()
    assert [(r.audience_score, r.critics_consensus) for r in full] == [(None, None), (94.0, "Dread filled .")]


def test_registry(spark):
    def broken(_):
        raise OSError("down")

    one = lambda s: s.range(2).select(F.lit("tmdb").alias("source"), F.col("id").alias("tmdb_id"))
    union, status = files.extract_all(spark, {"a": one, "b": broken, "c": one}, skip={"c"})
    assert union.count() == 2 and union.dtypes == S.empty(spark, S.RAW).dtypes
    assert {(r.source, r.status) for r in status.collect()} == {("a", "success"), ("b", "error"), ("c", "skipped")}


def test_quantiles_and_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 2, 2, 9, 7, 4]] + [(None,)], "v double")
    assert quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.75, 1.0))["v"] == {0.0: 1.0, 0.25: 2.0, 0.5: 4.0, 0.75: 6.0, 1.0: 9.0}
    assert quantiles(df.where("v > 100"), ["v"], (0.5,))["v"] == {0.5: None}
    assert [r.n for r in histogram(df, "v", 8).orderBy("bin").collect()] == [1, 2, 0, 1, 1, 0, 1, 1]
    assert sum(r.n for r in histogram(df.where("v = 2"), "v", 8).collect()) == 2


@pytest.mark.parametrize("html, expected", [
    ('<b data-qa="m"><b>The</b> <i>Thing</i></b> tail', "The Thing"),
    ('<b data-qa="m"></b><b>tail</b>', ""),
    ('<b class=x data-qa="m"><br><big>One</big><b/> two<B> three</B></b></b>', "One two three"),
    ('<b data-qa="m">never closed', None),
    ("<b>no marker</b>", None),
    (None, None),
])
def test_an_element_ends_at_its_own_closing_tag(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(landed_html.element_text(F.col("html"), "m").alias("t")).first().t == expected


def test_quantiles_count_a_hot_value_once(spark):
    from cinelink.operators.profile import quantiles, value_ranks

    df = spark.range(2000).selectExpr("CASE WHEN id % 10 = 0 THEN id ELSE 3 END AS hot", "CAST(id AS DOUBLE) / 7 AS v", "CAST(NULL AS INT) AS none")
    ranked = value_ranks(df, ["hot", "v"])
    assert ranked.where("column_name = 'hot' and v = 3").count() == 1 and ranked.where("column_name = 'hot'").count() == 201
    points = (0.0, 0.1, 0.5, 0.93, 0.999, 1.0)
    got = quantiles(df, ["hot", "v", "none"], points)
    rows = df.toPandas()
    for c in ("hot", "v"):
        assert [round(got[c][p], 9) for p in points] == [round(float(rows[c].astype(float).quantile(p)), 9) for p in points]
    assert set(got["none"].values()) == {None}


def test_rows_are_counted_while_they_are_stored(spark):
    from cinelink.operators.profile import counted, stage_metrics

    df = spark.createDataFrame([("tmdb",), ("tmdb",), ("imdb",), (None,), ("elsewhere",)], "source string")
    stored, rows, each = counted(df, "rows", S.SOURCES)
    assert (stored.count(), rows, each) == (5, 5, {"tmdb": 2, "imdb": 1, None: 1, "elsewhere": 1})
    assert counted(df.where("source = 'tmdb'"), "rows", S.SOURCES)[2] == {s: 2 * (s == "tmdb") for s in S.SOURCES}
    assert counted(df.limit(0), "rows", S.SOURCES)[1:] == (0, dict.fromkeys(S.SOURCES, 0))
    steps = [tuple(r) for r in stage_metrics({"a": 5, "b": df.where("source is not null"), "c": 1}).orderBy("step").collect()]
    assert steps == [(0, "a", 5, 5, 0), (1, "b", 5, 4, 1), (2, "c", 4, 1, 3)]


def test_outcome_of_sources(spark, tmp_path):
    from cinelink.sources import files

    (tmp_path / "no-title.csv").write_text("year,genre\n1999,horror\n")
    (tmp_path / "good.csv").write_text("Title,Year,Genre\nA,1999,horror\nB,1998,horror\n")
    (tmp_path / "broken.gz").write_bytes(b"no gzip at all")
    readers = {
        "kaggle": lambda s: files.read_catalogue_csv(s, str(tmp_path / "good.csv")),
        "untitled": lambda s: files.read_catalogue_csv(s, str(tmp_path / "no-title.csv")),
        "nowhere": lambda s: files.read_split_csv(s, str(tmp_path / "nothing")),
        "imdb": lambda s: files.read_titles(s, str(tmp_path / "broken.gz"), str(tmp_path / "broken.gz")),
        "left": lambda s: 1 / 0,
    }
    union, report = files.extract_all(spark, readers, skip={"left"})
    told = {r["source"]: (r["status"], r["rows"], r["message"]) for r in report.collect()}
    assert union.count() == 2 and told["kaggle"] == ("success", 2, None) and told["left"] == ("skipped", 0, None)
    assert told["untitled"] == ("error", 0, "missing columns: title") and told["nowhere"] == ("error", 0, "path not found")
    assert told["imdb"][:2] == ("error", 0) and told["imdb"][2]


def test_tsv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("numVotes\ttconst\textra\taverageRating\n5000\ttt1\tx\t7.5\n10\ttt2\n")
    read = files.read_tsv(spark, str(tmp_path / "r.tsv"), files.RATINGS_HEADER)
    assert [(r.tconst, r.averageRating, r.numVotes) for r in read.collect()] == [("tt1", "7.5", "5000")]
    (tmp_path / "bare.tsv").write_text("tt1\t7.5\t5000\n")
    assert files.read_tsv(spark, str(tmp_path / "bare.tsv"), files.RATINGS_HEADER).first().numVotes == "5000"
    (tmp_path / "lacks.tsv").write_text("tconst\tnumVotes\ntt1\t5000\n")
    assert files.read_tsv(spark, str(tmp_path / "lacks.tsv"), files.RATINGS_HEADER).count() == 0
