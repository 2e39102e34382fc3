"""Snapshots of the six tables in hash buckets, and loads that rewrite only what they touch.

A table is cut into buckets by a hash of its key: movies by id, what belongs to a movie by
movie id, genres by name. Two lookup tables, cut by identifier, tell which movies hold one,
so a load never reads all movies. A bucket's files are never changed: a load writes new
files for the buckets it touches, and a manifest lists, for every table, which folder holds
which bucket. Log rows are only added.

The manifest with the highest number is the snapshot. Writing it is the commit: it is
written under another name and renamed, which fails when another load has taken the number.
Until then nothing that the old manifest lists has been touched, so readers see the old
snapshot, and a load that stops halfway leaves files behind that no manifest names;
`vacuum` removes them, with the snapshots that are not kept.
"""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelink import schema as S
from cinelink.operators import load as loading
from cinelink.runtime import materialize, together

BUCKETS = 256

# What a row's bucket follows from; the log has none.
KEYS = {"movies": "id", "genres": "name", "movie_genres": "movie_id", "ratings": "movie_id", "rt_details": "movie_id"}
OF_MOVIES = ("movies", "movie_genres", "ratings", "rt_details")
LOOKUPS = {f"{c}s": T.StructType([S.MOVIES[c], S.MOVIES["id"]]) for c in ("tmdb_id", "imdb_id")}
SCHEMAS = {**S.TARGET_TABLES, **LOOKUPS}
LOG = "ingestion_logs"


class LostRace(RuntimeError):
    """Another load committed first; nothing was changed, load again."""


class Snapshots:
    """The snapshots below `path`, a folder that all executors share.

    `buckets` counts for a new folder; an existing one keeps its own. A bucket is written
    by one task: the more rows, the more buckets.
    """

    def __init__(self, spark, path, buckets=BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        last = self.version()
        self.buckets = self.manifest(last)["buckets"] if last else buckets

    # --- files ---------------------------------------------------------------

    def _at(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._at().getFileSystem(self._conf)

    def _names(self, *parts):
        folder, files = self._at(*parts), self._files()
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []

    def versions(self):
        return sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json") and n[:-5].isdigit())

    def version(self):
        """Number of the current snapshot, 0 before the first."""
        return max(self.versions(), default=0)

    def manifest(self, version=None):
        """{"buckets": n, "tables": {table: {folder: [bucket, ...]}}} of a snapshot, by default the current one."""
        version = self.version() if version is None else version
        if not version:
            return {"buckets": self.buckets, "tables": {}}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{version:010d}.json", wholetext=True).first()[0])

    def _publish(self, version, manifest):
        """Make a manifest the current one, in one step or not at all."""
        draft = self._at("manifests", f"draft-{uuid.uuid4().hex}")
        out = self._files().create(draft, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            # Without options a rename never replaces a file.
            context.rename(draft, self._at("manifests", f"{version:010d}.json"), options)
        except Exception as e:
            self._files().delete(draft, False)
            if version in self.versions():
                raise LostRace(f"snapshot {version} has been committed by another load") from e
            raise

    # --- reading -------------------------------------------------------------

    def read(self, table, buckets=None, version=None):
        """A table, or some of its buckets, of a snapshot."""
        held = self.manifest(version)["tables"].get(table, {})
        if table == LOG:
            paths = [f"{self.path}/data/{folder}/{table}" for folder in held]
        else:
            wanted = None if buckets is None else set(buckets)
            paths = [f"{self.path}/data/{folder}/{table}/bucket={b}" for folder, own in held.items() for b in own if wanted is None or b in wanted]
        return self._parquet(table, paths)

    def _parquet(self, table, paths):
        schema = SCHEMAS[table]
        return self.spark.read.schema(schema).parquet(*paths) if paths else S.empty(self.spark, schema)

    def _stored(self, folder, table, buckets):
        """Buckets of a table that have been written to a folder."""
        return self._parquet(table, [f"{self.path}/data/{folder}/{table}/bucket={b}" for b in buckets])

    def tables(self, version=None):
        return {name: self.read(name, version=version) for name in S.TARGET_TABLES}

    # --- writing -------------------------------------------------------------

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _touched(self, rows, key):
        """The buckets that hold the keys of `rows`; at most as many as there are."""
        return sorted(r[0] for r in rows.select(self._bucket(key)).distinct().collect())

    def _write(self, folder, table, rows, key, touched):
        """Write whole buckets; which of `touched` hold rows now."""
        tasks = max(1, min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        rows.withColumn("bucket", self._bucket(key)).repartition(tasks, "bucket").write.partitionBy(
            "bucket").parquet(f"{self.path}/data/{folder}/{table}")
        return sorted(int(n.split("=")[1]) for n in self._names("data", folder, table) if n.startswith("bucket="))

    def _folder(self, version):
        """A new folder for what a load on top of a snapshot writes."""
        return f"{version + 1:010d}-{uuid.uuid4().hex}"

    def _commit(self, version, folder, changes, added=None, written=()):
        """Write `changes`, {table: (all rows of the touched buckets, key, touched)}, and log rows; then commit.

        `written` names the buckets of tables that are in the folder already. Returns a row
        (table_name, written, held) per table: buckets written and buckets held.
        """
        manifest, done = self.manifest(version), dict(written)
        tables = manifest["tables"]
        steps = {n: lambda n=n, c=c: self._write(folder, n, *c) if c[2] else [] for n, c in changes.items() if n not in done}
        if added is not None:
            steps[LOG] = lambda: added.write.parquet(f"{self.path}/data/{folder}/{LOG}")
        done |= dict(zip(steps, together(*steps.values())))
        report = []
        for table, (_, _, touched) in changes.items():
            held = tables.setdefault(table, {})
            gone = set(touched)
            for other in list(held):
                held[other] = [b for b in held[other] if b not in gone]
                if not held[other]:
                    del held[other]
            full = done[table]
            if full:
                held[folder] = full
            report.append((table, len(full), sum(map(len, held.values()))))
        if added is not None:
            tables.setdefault(LOG, {})[folder] = []
        self._publish(version + 1, manifest)
        return report

    def adopt(self, tables):
        """Make the first snapshot of existing tables; absent ones are empty."""
        if self.version():
            raise ValueError("there is a snapshot already")
        every = list(range(self.buckets))
        have = {n: S.conform(tables[n], s) for n, s in S.TARGET_TABLES.items() if n in tables}
        changes = {n: (df, KEYS[n], every) for n, df in have.items() if n != LOG}
        if "movies" in have:
            changes |= {n: (_holders(have["movies"], n), _by(n), every) for n in LOOKUPS}
        return self._commit(0, self._folder(0), changes, have.get(LOG))

    def load(self, gold, at=None):
        """Load gold entities on top of the current snapshot and commit. Returns what `_commit` returns."""
        at = F.current_timestamp() if at is None else at
        version = self.version()
        good, bad = loading.judged_rows(gold)
        named = together(*[lambda by=_by(n): self._touched(good.where(F.col(by).isNotNull()), by) for n in LOOKUPS])
        asked = {_by(n): self.read(n, buckets, version) for n, buckets in zip(LOOKUPS, named)}
        loaded = loading.with_movies(good, loading.target_ids(good, asked))
        touched, named = together(
            lambda: self._touched(loaded, "movie_id"),
            lambda: self._touched(loaded.select(F.explode("genres").alias("name")).where("name <> ''"), "name"))
        have, folder = {n: self.read(n, touched, version) for n in OF_MOVIES}, self._folder(version)
        genres, full = together(
            lambda: materialize(loading.upsert_genres(loaded, self.read("genres", named, version)), "genres"),
            lambda: self._write(folder, "movies", loading.upsert_movies(loaded, have["movies"], at), "id", touched) if touched else [])
        # The lookups follow from the movies as they were written.
        movies = self._stored(folder, "movies", full)
        after = {
            "movies": movies, "genres": genres,
            "movie_genres": loading.upsert_movie_genres(loaded, genres, have["movie_genres"]),
            "ratings": loading.upsert_ratings(loaded, have["ratings"]),
            "rt_details": loading.upsert_rt_details(loaded, have["rt_details"], at),
        }
        changes = {n: (df, KEYS[n], named if n == "genres" else touched) for n, df in after.items()}
        moved = together(*[lambda n=n: self._moved(n, have["movies"], movies, version) for n in LOOKUPS])
        changes |= dict(zip(LOOKUPS, moved))
        return self._commit(version, folder, changes, loading.log_rows(loaded, bad, at), {"movies": full})

    def _moved(self, name, before, after, version):
        """The buckets of a lookup in which movies took or gave up an identifier."""
        key, before, after = _by(name), _holders(before, name), _holders(after, name)
        gone = before.join(after, [key, "id"], "left_anti")
        fresh = after.join(before, [key, "id"], "left_anti")
        moved = materialize(gone.withColumn("fresh", F.lit(False)).union(fresh.withColumn("fresh", F.lit(True))), "moved")
        touched = self._touched(moved, key)
        kept = self.read(name, touched, version).join(moved.where("not fresh").drop("fresh"), [key, "id"], "left_anti")
        return kept.union(moved.where("fresh").drop("fresh")), key, touched

    def vacuum(self, keep=2):
        """Delete snapshots but the last `keep`, and files that those do not name. Files of a load under way stay."""
        versions = self.versions()
        last, old = versions[-keep:], versions[:-keep]
        named = {folder for v in last for held in self.manifest(v)["tables"].values() for folder in held}
        for v in old:
            self._files().delete(self._at("manifests", f"{v:010d}.json"), False)
        for folder in self._names("data"):
            if folder not in named and last and int(folder.split("-")[0]) <= last[-1]:
                self._files().delete(self._at("data", folder), True)


def _by(lookup):
    return lookup[:-1]


def _holders(movies, lookup):
    """(identifier, id) of the movies that have one."""
    return movies.where(F.col(_by(lookup)).isNotNull()).select(_by(lookup), "id")
