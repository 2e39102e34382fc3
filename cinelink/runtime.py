"""Where intermediate tables go, and joins that survive hot keys."""

import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_local_dir = {}
_dropping, _dropping_lock = [], threading.Lock()

# A key with more rows than this is split, the MOST_HOT most frequent ones at most: any
# other key holds less than one in MOST_HOT of all rows.
HOT_ROWS = 1_000_000
MOST_HOT = 10_000


def work_dir(spark):
    """Shared folder for intermediate tables, as named by the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if "path" not in _local_dir:
        _local_dir["path"] = tempfile.mkdtemp(prefix="cinelink-")
    return _local_dir["path"]


def run_dir(spark):
    """The sub-folder of `work_dir` that this application writes to."""
    return f"{work_dir(spark)}/cinelink-{spark.sparkContext.applicationId}"


def new_path(spark, label):
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark):
    """Delete all intermediate tables of this application. DataFrames that read them end with it."""
    discard(spark, run_dir(spark))


def discard(spark, path):
    """Delete one intermediate table that nothing reads any longer."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_dropped(spark):
    """Let Spark drop the shuffle files of what runs inside as soon as it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    # Several may run inside at once: the first one switches it on, the last one back.
    with _dropping_lock:
        if not _dropping:
            _dropping.append((spark, spark.conf.get(key, None)))
            spark.conf.set(key, "true")
        else:
            _dropping.append(None)
    try:
        yield
    finally:
        with _dropping_lock:
            if len(_dropping) > 1:
                _dropping.pop()
            else:
                (first, before), = _dropping
                first.conf.unset(key) if before is None else first.conf.set(key, before)
                _dropping.clear()


def materialize(df, label, partition_by=(), path=None):
    """Write `df` once and return the stored table; `path`: where, a new one by default (see `new_path`).

    Cuts the lineage on storage every executor can reach, and gives later plans
    true sizes, so a small side is broadcast only when it really is small. Its shuffle
    files are not needed any longer and go at once.
    """
    spark, path = df.sparkSession, path or new_path(df.sparkSession, label)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*steps):
    """What independent steps return, run at the same time; the first error is raised when all have ended.

    A job over few rows, and the planning of any, leave most cores idle: what does not wait for
    one another should not queue.
    """
    with ThreadPoolExecutor(len(steps) or 1) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        running = [pool.submit(inherit(step)) for step in steps]
    return [r.result() for r in running]


def spread(df, *keys):
    """The rows dealt over all tasks by `keys`.

    A file of a few MB is read by one task, however many rows it holds and however much
    work they are; do this before that work, while rows are narrow.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def hot_keys(df, keys, hot_rows=None, at_most=None):
    """Keys holding more than `hot_rows` rows and the number of splits each needs.

    Returns None when there is none, so that ordinary data pay only for one map-side
    combined count, and not even for that when `df` is known to have `at_most` few
    rows.
    """
    limit = hot_rows or HOT_ROWS
    if at_most is not None and at_most <= limit:
        return None
    return hot_among(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), limit)


def hot_among(counted, hot_rows=None, at_most=None):
    """`hot_keys` of rows whose keys have been counted: `counted` holds the key and its number of rows `n`."""
    limit = hot_rows or HOT_ROWS
    if at_most is not None and at_most <= limit:
        return None
    keys = [c for c in counted.columns if c != "n"]
    hot = counted.where(F.col("n") > limit).orderBy(F.desc("n")).limit(MOST_HOT).select(
        *keys, F.ceil(F.col("n") / limit).cast("int").alias("splits"))
    return None if hot.isEmpty() else materialize(hot, "hot")


def skew_join(left, right, keys, how, hot=None, spread_by=None):
    """Equi-join whose hot keys (see `hot_keys`) are spread over several tasks.

    Rows of `left` under a hot key are dealt out by a hash of `spread_by`; the
    matching rows of `right` are repeated once per split. `left` is the side that
    carries the skew and `right` has few rows per key, so only inner, left, semi and
    anti joins make sense.
    """
    if hot is None:
        return left.join(right, keys, how)
    splits, hot = F.coalesce(F.col("splits"), F.lit(1)), F.broadcast(hot)  # MOST_HOT rows at most
    left = left.join(hot, keys, "left").withColumn(
        "split", F.pmod(F.xxhash64(*spread_by), splits).cast("int")
    ).drop("splits")
    right = right.join(hot, keys, "left").withColumn(
        "split", F.explode(F.sequence(F.lit(0), splits - 1))
    ).drop("splits")
    return left.join(right, [*keys, "split"], how).drop("split")


def lookup_join(left, right, keys, how, hot_rows=None):
    """`skew_join` of rows with what is stored once per key; finds the hot keys of `left` itself."""
    others = [c for c in left.columns if c not in keys] or keys
    return skew_join(left, right, keys, how, hot_keys(left, keys, hot_rows), spread_by=others)


def hot_grid(left, right, keys, cell_rows):
    """Keys with more than `cell_rows` rows on a side, and the cuts each side needs."""
    one, none = F.lit(1), F.lit(0)
    sizes = (
        left.select(*keys, one.alias("l"), none.alias("r"))
        .union(right.select(*keys, none.alias("l"), one.alias("r")))
        .groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .where((F.col("l") > 0) & (F.col("r") > 0) & (F.greatest("l", "r") > cell_rows))
    )
    grid = sizes.select(*keys, *[
        F.ceil(F.col(side) / cell_rows).cast("int").alias(f"{side}_cuts") for side in ("l", "r")
    ])
    return None if grid.isEmpty() else materialize(grid, "grid")


def grid_join(left, right, keys, condition, grid, spread_left, spread_right):
    """Inner equi-join with a condition, for keys that are hot on both sides.

    A key listed in `grid` (see `hot_grid`) is cut into cells: each row gets a
    random-looking line on its own side and is repeated along the other, so that
    every pair meets in exactly one cell and no cell is larger than about the rows
    allowed per side. Column names other than the keys must differ.
    """
    if grid is not None:
        def place(df, own, other, spread_by):
            cuts = F.coalesce(F.col(f"{own}_cuts"), F.lit(1))
            across = F.coalesce(F.col(f"{other}_cuts"), F.lit(1))
            return df.join(grid, keys, "left").withColumns({
                f"{own}_cell": F.pmod(F.xxhash64(*spread_by), cuts).cast("int"),
                f"{other}_cell": F.explode(F.sequence(F.lit(0), across - 1)),
            }).drop("l_cuts", "r_cuts")

        left, right = place(left, "l", "r", spread_left), place(right, "r", "l", spread_right)
        keys = [*keys, "l_cell", "r_cell"]
    # Sizes are estimated before rows are repeated, so neither side may be broadcast.
    return left.alias("a").join(
        right.hint("merge").alias("b"),
        [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [condition],
    )
