"""From sources to gold table and related tables, in one call."""

import datetime
import uuid

from pyspark.sql import functions as F

from cinelink import schema as S
from cinelink.operators import filters, load, profile, quality
from cinelink.operators.dedup import deduplicate
from cinelink.operators.normalize import normalize_records
from cinelink.operators.resolve import resolve
from cinelink.sources import files, landed_html


def file_readers(spark_paths, options=None):
    """Readers for landed files: {source: path or (path, path)} to {source: function}.

    `options` maps a source to keyword arguments of its reader, as {"tmdb": {"max_pages": 20}}.
    """
    read = {
        "tmdb": files.read_api_pages, "rotten_tomatoes": landed_html.read_landed_pages,
        "kaggle": files.read_catalogue_csv, "imdb": files.read_titles, "spark": files.read_split_csv,
    }
    options = options or {}
    unknown = sorted((set(spark_paths) | set(options)) - set(read))
    if unknown:
        raise ValueError(f"no file reader for {', '.join(unknown)}")

    def reader(name, paths):
        paths = (paths,) if isinstance(paths, str) else paths
        return lambda spark: read[name](spark, *paths, **options.get(name, {}))

    return {name: reader(name, paths) for name, paths in spark_paths.items()}


def ingest(
    spark, readers, skip=(), threshold=None, existing=None, gold_path=None, snapshot_path=None, strict_ids=False, store=None,
):
    """Run all steps and return their results.

    `readers` maps source names to functions of the session (see `extract_all`);
    `existing` holds the snapshot to load on top of. The gold table and the six
    tables are written only where a path is given. With `store`, a `snapshots.Snapshots`, the
    tables are loaded on top of its current snapshot, of which only what the gold rows touch
    is rewritten. `strict_ids` keeps different tmdb_ids apart. Returns a dict with `gold`,
    `tables`, `sources` (status per reader), `stages` and `runs` (audits).
    """
    started = datetime.datetime.now()
    raw, status = files.extract_all(spark, readers, skip)
    # Every stage is counted by the write that stores it.
    raw, n_raw, raw_by_source = profile.counted(raw, "raw", S.SOURCES)
    kept, n_kept, kept_by_source = profile.counted(deduplicate(normalize_records(raw)), "kept", S.SOURCES)
    merged, n_merged, _ = profile.counted(resolve(kept, threshold, strict_ids=strict_ids), "merged")
    gold, n_gold, _ = profile.counted(filters.thematic_filter(merged), "gold")
    if gold_path is not None:
        load.export_gold(gold, gold_path)
    if store is not None:
        store.load(gold)
        tables = store.tables()
    else:
        tables = load.load(gold, existing)
    if snapshot_path is not None:
        load.write_snapshot(tables, snapshot_path)
        tables = load.read_snapshot(spark, snapshot_path)
    stages = profile.stage_metrics({"extracted": n_raw, "deduplicated": n_kept, "merged": n_merged, "themed": n_gold})
    runs = quality.run_audit(
        raw_by_source, kept_by_source, str(uuid.uuid4()), F.lit(started), F.lit(datetime.datetime.now()))
    return {"gold": gold, "tables": tables, "sources": status, "stages": stages, "runs": runs}


def counts(tables):
    """Rows per table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items() if name in S.TARGET_TABLES
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out
