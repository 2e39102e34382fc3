"""Bucketed snapshots: what a load rewrites, loads that stop halfway, races, moved identifiers, clean-up."""

import pytest
from pyspark.sql import functions as F
from test_load import AT, gold

from cinelink import schema as S
from cinelink.operators import load, snapshots


@pytest.fixture
def store(spark, tmp_path):
    return snapshots.Snapshots(spark, f"{tmp_path}/store", buckets=40)


def films(n, **more):
    return [{"tmdb_id": i, "title": f"film {i}", "genres": ["Horror"], "vote_average": 5.0, "tomatometer_score": 50.0, **more} for i in range(n)]


def plain(tables):
    """Rows of all tables but the log, apart from the times they were written at."""
    drop = {"movies": ["created_at", "updated_at"], "rt_details": ["scraped_at"]}
    return {n: sorted(map(str, tables[n].drop(*drop.get(n, [])).collect())) for n in S.TARGET_TABLES if n != "ingestion_logs"}


def test_load_equals_whole_table_load_and_writes_only_touched_buckets(spark, store):
    first = gold(spark, *films(200))
    store.load(first, F.lit(AT))
    whole = load.load(first, at=F.lit(AT))
    assert plain(store.tables()) == plain(whole)
    old = store.manifest()
    # One key in a hundred changes, one is new.
    change = gold(spark, {"tmdb_id": 7, "overview": "now told", "genres": ["Drama"]}, {"tmdb_id": 150, "title": "renamed"}, {"imdb_id": "tt5", "title": "new"})
    report = {t: (written, held) for t, written, held in store.load(change, F.lit(AT))}
    assert plain(store.tables()) == plain(load.load(change, {n: df for n, df in whole.items()}, F.lit(AT)))
    new = store.manifest()
    for name in ("movies", "movie_genres", "ratings", "rt_details"):
        (before, held), = old["tables"][name].items()
        assert report[name][0] <= 3 < report[name][1] and len(set(held) - set(new["tables"][name][before])) <= 3
    assert report["tmdb_ids"][0] == 0 and report["imdb_ids"][0] == 1
    assert store.read("ingestion_logs").count() == 203


def test_a_load_that_stops_halfway_leaves_the_old_snapshot(spark, store, monkeypatch):
    store.load(gold(spark, *films(20)), F.lit(AT))
    before = plain(store.tables())
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.load(gold(spark, *films(20, overview="never seen")), F.lit(AT))
    again = snapshots.Snapshots(spark, store.path)
    assert again.version() == 1 and again.buckets == 40 and plain(again.tables()) == before
    again.load(gold(spark, *films(20, overview="seen")), F.lit(AT))
    assert {r.overview for r in again.read("movies").collect()} == {"seen"}
    assert plain(again.tables(version=1)) == before


def test_two_loads_at_once(spark, store):
    store.load(gold(spark, *films(3)), F.lit(AT))
    late = store.manifest()
    store.load(gold(spark, *films(5)), F.lit(AT))
    with pytest.raises(snapshots.LostRace):
        store._publish(2, late)
    assert store.version() == 2 and store.read("movies").count() == 5


def test_identifiers_that_move(spark, store):
    store.load(gold(spark, {"imdb_id": "tt1", "tmdb_id": None, "title": "a"}), F.lit(AT))
    store.load(gold(spark, {"imdb_id": "tt1", "tmdb_id": 11, "title": "a"}), F.lit(AT))
    # The movie is found by imdb_id and takes another tmdb_id; the one it had names nothing any more.
    store.load(gold(spark, {"imdb_id": "tt1", "tmdb_id": 12, "title": "a"}), F.lit(AT))
    assert [(r.tmdb_id, r.imdb_id) for r in store.read("movies").collect()] == [(12, "tt1")]
    assert [r.tmdb_id for r in store.read("tmdb_ids").collect()] == [12]
    store.load(gold(spark, {"tmdb_id": 11, "title": "b"}), F.lit(AT))
    assert store.read("movies").count() == 2


def test_vacuum_keeps_what_kept_snapshots_name(spark, store):
    for i in range(4):
        store.load(gold(spark, {"tmdb_id": i, "title": f"film {i}"}), F.lit(AT))
    before = plain(store.tables())
    store.vacuum(keep=1)
    assert store.versions() == [4] and plain(store.tables()) == before and store.read("ingestion_logs").count() == 4
    store.vacuum(keep=1)
    assert plain(snapshots.Snapshots(spark, store.path).tables()) == before


def test_empty_folder_and_adopted_tables(spark, store):
    assert store.version() == 0 and all(df.count() == 0 for df in store.tables().values())
    tables = load.load(gold(spark, *films(10)), at=F.lit(AT))
    store.adopt(tables)
    assert plain(store.tables()) == plain(tables) and store.read("ingestion_logs").count() == 10
    with pytest.raises(ValueError):
        store.adopt(tables)
