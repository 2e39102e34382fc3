"""Scalar rules on literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.functions import dates, numbers, text
from cinelink.operators import filters
from cinelink.operators.normalize import normalize_records
from cinelink.operators.similarity import common_subsequence, similarity
from statement import lcs
from test_resolve import frame


def apply(spark, function, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_dates(spark):
    d = datetime.date
    cases = {
        "2023-10-31": d(2023, 10, 31), "2019": d(2019, 1, 1), "\\N": None, None: None, "": None,
        "31/10/2023": d(2023, 10, 31), "October 31, 2023": d(2023, 10, 31), "1/2/2020": d(2020, 1, 2),
        "October 2018": d(2018, 10, 1), "19800523": d(1980, 5, 23), "5 Mar 1999": d(1999, 3, 5),
        "2020-05": d(2020, 5, 1), "2020-01-02 10:11:12": d(2020, 1, 2), "N/A": None, "NA": None,
        "null": None, "2020-13-45": None, "02/30/2020": None, "soon": None, "  2019 ": d(2019, 1, 1),
        "12": d(12, 1, 1), "2018-4-6": d(2018, 4, 6),
        "11/9/72": d(1972, 11, 9), "25/12/08": d(2008, 12, 25), "9-Nov-1972": d(1972, 11, 9), "1972-Nov-09": d(1972, 11, 9),
        "Nov. 9, 1972": d(1972, 11, 9), "Sept 5, 2010": d(2010, 9, 5), "Thu, 9 Nov 1972": d(1972, 11, 9),
        "November 9th, 1972": d(1972, 11, 9), "9th of NOVEMBER 1972": d(1972, 11, 9), "1972.11.09": d(1972, 11, 9),
        "19721109T101010": d(1972, 11, 9), "November 9 1972 10:00 PM": d(1972, 11, 9), "11/09/1972 10:00": d(1972, 11, 9),
        "1972/11/9 08:15": d(1972, 11, 9), "Octopus 9, 1972": None, "31-Feb-1972": None, "3rd 1972": None,
    }
    assert apply(spark, dates.parse_date, list(cases)) == list(cases.values())
    assert apply(spark, dates.year_start, ["1980", "\\N", "x", None]) == [d(1980, 1, 1), None, None, None]


def test_scores(spark):
    ten = lambda c: numbers.clamp(c, numbers.TEN_POINT)
    percent = lambda c: numbers.clamp(c, numbers.PERCENT)
    assert apply(spark, ten, [7.5, 11.0, -1.0, None, float("nan"), 0.0, 10.0], "double") == [
        7.5, None, None, None, None, 0.0, 10.0]
    assert apply(spark, percent, [85.0, 105.0, 92.0], "double") == [85.0, None, 92.0]
    assert apply(spark, numbers.score_from_text, ["85%", "8.5", "", "n/a", "1.2.3"]) == [85.0, 8.5, None, None, None]
    assert apply(spark, numbers.year_from_text, ["(1980)", "soon"]) == [1980, None]


def test_numbers(spark):
    values = ["12.7", "-3.9", "nan", "inf", "1e3", "abc", None, "1.5d", " 7 ", "1e30"]
    assert apply(spark, numbers.safe_long, values) == [12, -3, None, None, 1000, None, None, None, 7, None]
    assert apply(spark, numbers.strict_long, values) == [None] * 8 + [7, None]
    assert apply(spark, numbers.safe_double, ["12.7", "x", "1.5f"]) == [12.7, None, None]


def test_texts(spark):
    cases = {
        " \n two words ": "two words", "three\t\tmore  words": "three more words", "   ": None, None: None,
        "<li>An <em>old</em>, mill</li>": "An old , mill", "a < b": "a < b", "x &amp; y": "x &amp; y",
        "<i>a &amp;amp; &eacute;&#233;&#xE9; &bogus; &#0;</i>": "a &amp; ééé &bogus; �",
        "<script>var a='</p>';</script>ok<!-- <b>no</b> -->": "ok", "a  \x1cb": "a b",
        "<!DOCTYPE html><style>p{}</style>x": "x",
        "<b>It&apos;s</b>": "It's", "<i>&#146;&#x80;</i>": "’€", "<i>A &amp B &copy 2020 &notit; &hellip</i>": "A & B © 2020 ¬it; &hellip",
        "<i>&NotEqualTilde;&ZeroWidthSpace;x&#x110000;</i>": "≂̸​x�",
    }
    assert apply(spark, text.clean_text, list(cases)) == list(cases.values())
    assert apply(spark, text.valid_utf8, ["Où dort l’été".encode(), b"a\xffb"], "binary") == ["Où dort l’été", "a�b"]


def test_title_keys(spark):
    cases = {
        "The Lantern House": "the lantern house", "It's Alive!": "its alive", None: None, "!!!": "", "ÉTÉ-1 _x": "été-1 _x",
        "  A   B ": "a b", "Épouvante": "épouvante",
    }
    assert apply(spark, text.title_key, list(cases)) == list(cases.values())
    assert apply(spark, text.token_key, ["the lantern house", "", None]) == ["house lantern the", "", None]


def test_genres(spark):
    values = ['[{"name":"Horror","id":1},{"id":2}]', "a, b|c,,", "[bad", "", None]
    assert apply(spark, text.parse_genres, values) == [["Horror"], ["a", "b", "c"], ["[bad"], [], []]


def test_similarity(spark):
    pairs = [("orchardist", "orcherdist"), ("abc", "xyz"), ("", "a"), ("a", "a"), (None, "a"), ("é b", "b é")]
    for a, b in pairs[:4]:
        assert common_subsequence(a, b) == lcs(a, b)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(similarity("a", "b")).collect()]
    assert got[0] == pytest.approx(90.0) and got[1:5] == [0.0, 0.0, 100.0, None]


def test_normalized_record(spark):
    raw = {"source": "tmdb", "tmdb_id": 90617, "title": "  The Lantern House  ", "release_date": "1972-11-09",
           "vote_average": 5.5, "overview": "<p>Rooms that move at night.</p>"}
    r = normalize_records(frame(spark, [raw, {**raw, "source": "kaggle", "vote_average": 11.0},
                                        {**raw, "vote_average": 11.0}])).orderBy("seq").collect()
    assert (r[0].title, r[0].release_date, r[0].vote_average) == ("The Lantern House", datetime.date(1972, 11, 9), 5.5)
    assert (r[0].overview, r[0].title_norm) == ("Rooms that move at night.", "the lantern house")
    # Only the ten-point sources are range-checked.
    assert (r[1].vote_average, r[2].vote_average) == (11.0, None)


def test_thematic_filter(spark):
    rows = [("tmdb", "The Lantern House", "Horror", ""), ("kaggle", "Teapot Parade", "Comedy", "cheerful"), ("tmdb", "Grey Orchard", "", ""),
            ("kaggle", "Slasher night", None, None), ("kaggle", None, None, "une ÉPOUVANTE"), (None, "x", None, None)]
    df = spark.createDataFrame(rows, "source string, title string, genres string, overview string")
    kept = filters.thematic_filter(df)
    assert {(r.source, r.title) for r in kept.collect()} == {
        ("tmdb", "The Lantern House"), ("tmdb", "Grey Orchard"), ("kaggle", "Slasher night"), ("kaggle", None)}
    assert filters.genre_filter(df.drop("genres")).count() == 6
    assert filters.title_contains(df, "lant").count() == 1


def test_rating_rules(spark):
    rows = [(8.0, 90.0, "rotten_tomatoes"), (0.0, 90.0, "tmdb"), (None, None, "rotten_tomatoes"), (None, None, "imdb")]
    df = spark.createDataFrame(rows, "v double, t double, s string")
    v, t, s = F.col("v"), F.col("t"), F.col("s")
    got = df.select(numbers.rating_score(v, t), numbers.rating_scale(v, t, s)).collect()
    assert [tuple(r) for r in got] == [(8.0, "0-10"), (90.0, "0-100"), (None, "0-100"), (None, "0-10")]


def test_priorities(spark):
    got = apply(spark, S.source_priority, ["tmdb", "rotten_tomatoes", "kaggle", "imdb", "spark", "other", None])
    assert got == [0, 1, 2, 3, 4, 99, 99]


def test_markup_without_content_to_drop_and_usual_references_take_the_short_way(spark):
    pieces = ["<!--", "-->", "<SCRIPT x>", "</script >", "<scripts>", "<style>", "<p>", "&amp;", "&amp", "&lt;", "&", "amp;", "a"]
    texts = ["".join(pieces[(i * 7 + j * j * (i % 11 + 1) + i // 13) % len(pieces)] for j in range(i % 9)) for i in range(400)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string")
    for unclosed in (True, False):
        whole = F.col("x")
        for pattern in text.MARKUP:
            whole = F.regexp_replace(whole, pattern, " ")
        whole = text.decode_entities(whole, unclosed)
        assert df.where(~text.strip_markup(F.col("x"), unclosed).eqNullSafe(whole)).count() == 0
