"""All steps over five small sources, twice."""

from cinelink.plans.ingest import ingest
from test_resolve import film, frame

SOURCES = {
    "tmdb": [
        film("The Lantern House", 1972, "tmdb", tmdb_id=90617, genres=["Horror", "Drama"], vote_average=5.5, vote_count=813,
             overview="Rooms that move at night."),
        film("Cellar Door", 1948, "tmdb", tmdb_id=90718, genres=["Horror", "War"], vote_average=7.1),
    ],
    "rotten_tomatoes": [
        film("The Lantern House", 1972, "rotten_tomatoes", tomatometer_score=61.0, audience_score=58.0,
             critics_consensus="Its corridors <b>outlast</b> its plot."),
    ],
    "kaggle": [
        film("Ox", 2003, "kaggle", imdb_id="tt9000021", genres=["Horror", "Western"]),
        film("Teapot Parade", 2013, "kaggle", imdb_id="tt9000022", genres=["Family"], overview="A kettle."),
        film("Lantern House, The", 1972, "kaggle", imdb_id="tt9000023", genres=["Horror"], budget=250_000),
    ],
    "imdb": [film("The Lantern House", 1972, "imdb", imdb_id="tt9000023", vote_average=5.9, runtime_minutes=101)],
    "spark": [film("Grey Orchard", 2016, "spark", genres=["Horror"], popularity=3.25)],
}


def test_all_steps(spark, tmp_path):
    readers = {name: (lambda s, rows=rows: frame(s, rows)) for name, rows in SOURCES.items()}
    out = ingest(spark, readers, gold_path=str(tmp_path / "gold"), snapshot_path=str(tmp_path / "s1"))
    rows = {r.title: r for r in out["gold"].collect()}
    assert set(rows) == {"The Lantern House", "Cellar Door", "Ox", "Grey Orchard"}
    house = rows["The Lantern House"]
    assert house.sources == ["tmdb", "rotten_tomatoes", "kaggle", "imdb"]
    assert (house.imdb_id, house.budget, house.runtime_minutes) == ("tt9000023", 250_000, 101)
    assert (house.tomatometer_score, house.critics_consensus) == (61.0, "Its corridors outlast its plot.")
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 4
    stages = {r.stage: r.after for r in out["stages"].collect()}
    assert stages == {"extracted": 8, "deduplicated": 8, "merged": 5, "themed": 4}
    assert {r.source: r.status for r in out["runs"].collect()} == {s: "success" for s in SOURCES}
    again = ingest(spark, readers, existing=out["tables"], skip={"spark"}, snapshot_path=str(tmp_path / "s2"))
    assert again["tables"]["movies"].count() == 4
    assert again["tables"]["ingestion_logs"].count() == 7
