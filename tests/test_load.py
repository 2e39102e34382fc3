"""Loading: inserts, updates, rejected rows, chains of shared identifiers, repeats."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators import load, quality
from cinelink.plans import load_queries
from cinelink.runtime import materialize, together

GOLD = """tier int, pos struct<priority:int,a:bigint>, source string, tmdb_id long, imdb_id string, title string,
    title_norm string, year int, original_title string, overview string, release_date date, vote_average double,
    vote_count long, popularity double, poster_path string, tomatometer_score double, audience_score double,
    critics_consensus string, budget long, revenue long, runtime_minutes long, genres array<string>,
    sources array<string>"""
NAMES = [c.strip().split(" ")[0] for c in GOLD.replace("\n", " ").replace("priority:int,a:bigint", "x").split(",")]
AT = datetime.datetime(2024, 1, 1)


def gold(spark, *rows):
    filled = [
        {"tier": 1, "pos": (0, i), "source": "tmdb", "sources": ["tmdb"], "genres": [], "title": "x", "title_norm": "x", **r}
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in filled], GOLD)


def stored(tables):
    return {n: materialize(df, n) for n, df in tables.items()}


def test_rows_move_without_what_no_table_takes(spark, monkeypatch):
    moved, store = {}, load.materialize
    monkeypatch.setattr(load, "materialize", lambda df, label, *a: moved.update({label: set(df.columns)}) or store(df, label, *a))
    tables = load.load(gold(spark, {"tmdb_id": 1, "title_norm": "a", "year": 1990, "genres": ["Horror"]}), at=F.lit(AT))
    assert not moved["rows"] & {"title_norm", "year", "tier", "pos", "contributors"}
    assert "movie_id" in moved["loaded"] and "id" not in moved["loaded"]
    assert [r.id for r in tables["movies"].collect()] == [r.movie_id for r in tables["movie_genres"].collect()]


def test_first_load_and_repeat(spark):
    g = gold(
        spark,
        {"tmdb_id": 1, "title": "A", "genres": ["Horror", "Drama"], "vote_average": 8.0, "vote_count": 5},
        {"imdb_id": "tt2", "title": None, "genres": ["Horror"], "source": "rotten_tomatoes", "tomatometer_score": 90.0,
         "sources": ["rotten_tomatoes", "imdb"]},
        {"title_norm": "c", "title": "C", "year": 1990, "source": "elsewhere"},
        {"tmdb_id": 9, "title": "bad", "runtime_minutes": 0},
    )
    once = stored(load.load(g, at=F.lit(AT)))
    assert {(r.title, r.sources) for r in once["movies"].collect()} == {
        ("A", "tmdb"), ("Unknown", "rotten_tomatoes,imdb"), ("C", "tmdb")}
    assert {r.name for r in once["genres"].collect()} == {"Horror", "Drama"}
    assert once["movie_genres"].count() == 3
    assert {(r.source, r.score, r.scale) for r in once["ratings"].collect()} == {
        ("tmdb", 8.0, "0-10"), ("rotten_tomatoes", 90.0, "0-100")}
    assert [r.tomatometer_score for r in once["rt_details"].collect()] == [90.0]
    log = once["ingestion_logs"].collect()
    assert sorted(r.status for r in log) == ["error", "success", "success", "success"]
    assert [r.error_message for r in log if r.status == "error"] == ["runtime_minutes must be positive"]
    assert load.load_counts(once["ingestion_logs"]).first().asDict() == {"success": 3, "errors": 1, "total": 4}
    twice = load.load(g, once, F.lit(AT))
    for name in S.TARGET_TABLES:
        if name != "ingestion_logs":
            assert sorted(map(str, twice[name].collect())) == sorted(map(str, once[name].collect()))
    assert twice["ingestion_logs"].count() == 8
    assert {r.violations for r in quality.audit(once).collect()} == {0}


def test_updates_keep_what_is_not_given(spark):
    once = stored(load.load(gold(spark, {
        "tmdb_id": 1, "imdb_id": "tt1", "overview": "old", "budget": 5, "vote_average": 7.0, "vote_count": 3,
        "tomatometer_score": 50.0, "critics_consensus": "good"}), at=F.lit(AT)))
    # Found by imdb_id; null fields stay, review details are replaced whole.
    later = F.lit(datetime.datetime(2024, 2, 1))
    twice = load.load(gold(spark, {"imdb_id": "tt1", "budget": 6, "title": "new", "audience_score": 40.0}), once, later)
    m = twice["movies"].collect()
    assert [(r.tmdb_id, r.overview, r.budget, r.title) for r in m] == [(1, "old", 6, "new")]
    assert (m[0].created_at, m[0].updated_at) == (datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1))
    assert [(r.score, r.vote_count) for r in twice["ratings"].collect()] == [(7.0, 3)]
    d = twice["rt_details"].collect()
    assert [(r.tomatometer_score, r.audience_score, r.critics_consensus) for r in d] == [(None, 40.0, None)]
    assert d[0].scraped_at == datetime.datetime(2024, 1, 1)


def test_rows_sharing_identifiers_write_one_movie(spark):
    # 2 leans on 1 by imdb_id, 3 on 2 by tmdb_id, 4 on 3 by imdb_id; 5 is alone.
    g = gold(
        spark, {"tmdb_id": 1, "imdb_id": "tta", "title": "one"}, {"tmdb_id": 2, "imdb_id": "tta", "title": "two"},
        {"tmdb_id": 2, "imdb_id": "ttb", "title": "three"}, {"imdb_id": "ttb", "title": "four"},
        {"tmdb_id": 7, "title": "five"})
    rows = materialize(load.movie_rows(g), "rows")
    ids = {r.nr.pos.a: r.movie_id for r in load.target_ids(rows, S.empty(spark, S.MOVIES)).collect()}
    assert ids[0] == ids[1] == ids[2] == ids[3] != ids[4]
    assert {r.title for r in load.load(g, at=F.lit(AT))["movies"].collect()} == {"four", "five"}


def test_snapshot_round_trip(spark, tmp_path):
    tables = load.load(gold(spark, {"tmdb_id": 1, "genres": ["Horror"]}), at=F.lit(AT))
    load.write_snapshot(tables, str(tmp_path / "s1"))
    back = load.read_snapshot(spark, str(tmp_path / "s1"))
    assert {n: df.count() for n, df in back.items()} == {
        "movies": 1, "genres": 1, "movie_genres": 1, "ratings": 1, "rt_details": 0, "ingestion_logs": 1}
    left = quality.delete_movies(back, back["movies"].select("id"))
    assert {n: df.count() for n, df in left.items()} == {
        "movies": 0, "genres": 1, "movie_genres": 0, "ratings": 0, "rt_details": 0, "ingestion_logs": 1}
    assert left["ingestion_logs"].first().movie_id is None


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("tmdb", 7.5, "8.5", "k")], "source string, budget double, vote_average string, title_norm string")
    load.export_gold(df.withColumn("genres", F.array(F.lit("a"))), str(tmp_path / "g"))
    back = spark.read.parquet(str(tmp_path / "g"))
    assert set(back.columns) == {"source", "budget", "vote_average", "genres"}
    assert (back.first().budget, back.first().vote_average) == (None, 8.5)
    assert load.lists_to_json(back).first().genres == '["a"]'


def test_rows_are_compared_in_one_pass(spark):
    columns = "movie_id string, score double"
    before = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None), ("c", 3.0)], columns)
    after = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 4.0), ("d", None), ("d", None)], columns)
    got = load_queries.compare_rows({"x": (before, after), "same": (after, after), "none": (before.limit(0), after.limit(0))})
    assert {tuple(r) for r in got.collect()} == {("x", 5, 5), ("same", 5, 0), ("none", 0, 0)}
    plan = got.where("table_name = 'x'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2


def test_a_rating_without_score_keeps_the_stored_scale(spark):
    ratings = spark.createDataFrame(
        [("m1", "tmdb", 7.0, 1, "old"), ("m2", "imdb", None, None, None), ("m3", "tmdb", 2.0, 2, "old")], S.RATINGS)
    rows = spark.createDataFrame(
        [(1, "m1", "tmdb", None, 9, None), (2, "m2", "imdb", None, 4, None), (3, "m4", "rotten_tomatoes", None, 5, None),
         (4, "m3", "tmdb", 8.0, None, None)],
        "nr int, movie_id string, source string, vote_average double, vote_count long, tomatometer_score double")
    after = load.upsert_ratings(rows, ratings)
    assert {tuple(r) for r in after.collect()} == {
        ("m1", "tmdb", 7.0, 9, "old"), ("m2", "imdb", None, 4, "0-10"), ("m3", "tmdb", 8.0, 2, "0-10"),
        ("m4", "rotten_tomatoes", None, 5, "0-100")}
    # The stored ratings, which may be a costly table, meet the new ones in a single join.
    assert after._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_steps_run_at_the_same_time_and_leave_the_session_as_it_was(spark):
    key, meet = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", threading.Barrier(3, timeout=60)
    before = spark.conf.get(key, None)

    def step(n):
        meet.wait()
        return materialize(spark.range(n).groupBy("id").count(), "step").count()

    assert together(*[lambda n=n: step(n) for n in (3, 5, 7)]) == [3, 5, 7]
    assert spark.conf.get(key, None) == before and together() == []
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1 / 0, lambda: step)
