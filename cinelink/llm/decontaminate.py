"""Benchmark decontamination: a broadcast hash set of n-grams of the benchmark.

Items become windows of 13 words (an item of fewer words is one window of its length).
Their hashes, words and items form a table that is broadcast while it has at most
`BROADCAST_BYTES`. Every document is then read once: its words are cut into windows of each
length that occurs in the benchmark, hashes are looked up, and the join condition compares
the words themselves, so a hit is verified where it is found. Only hits and one header per
document are shuffled. A larger benchmark is joined by shuffle: id, place and hash of every
window move, never the words of a document; texts with hashes found are read again and
those windows compared by their words.

Defined results: null or empty texts have no words, hit nothing and are clean; items
without words are ignored; rows with the same id and text get a result each; an empty
benchmark leaves everything clean; an empty table gives no rows; other columns are not
looked at.
"""

from pyspark.sql import functions as F

from cinelink.llm.texts import ascii_lower, digest, group_key, split_words, text_or_empty
from cinelink.runtime import materialize

WINDOW = 13
# Bytes of words and item ids, with 16 for each and 64 for a window, that any executor can hold.
BROADCAST_BYTES = 50_000_000
MIN_SHARE = 20  # contaminated from one word in so many
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words_of(text):
    return split_words(ascii_lower(text_or_empty(text)), GAP)


def _hash(words, at, length):
    # Element by element: a slice would copy the words once per window.
    return F.xxhash64(*[F.get(words, at + j) for j in range(length)])


def _windows(words, length):
    """Array of (length, at, hash) of every window of `length` words."""
    return F.when(F.size(words) >= length, F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.struct(F.lit(length).alias("len"), i.alias("at"), _hash(words, i, length).alias("h")),
    )).otherwise(F.expr("cast(array() as array<struct<len:int,at:int,h:bigint>>)"))


def benchmark_windows(benchmark, item="item_id", text="text"):
    """(len, h, gram, items): every distinct window with the items that hold it, stored."""
    w = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    w = w.withColumn("len", F.least(F.size("words"), F.lit(WINDOW)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("len") + 1))
    w = w.select("item", "len", "words", at.alias("at")).select("item", "len", F.slice("words", F.col("at"), F.col("len")).alias("gram"))
    return materialize(w.groupBy("len", "gram").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "len", _hash(F.col("gram"), F.lit(0), WINDOW).alias("h"), "gram", "items"), "benchmark")


def _by_broadcast(rows, grams, windows, by):
    """One pass: every window looks itself up in the broadcast table and is compared where it is found."""
    header = grams.sparkSession.range(1).select(
        F.lit(0).alias("len"), F.lit(0).cast("long").alias("h"),
        *[F.array().cast("array<string>").alias(c) for c in ("gram", "items")])
    table = F.broadcast(grams.unionByName(header).withColumnsRenamed({"len": "b_len", "h": "b_h"}))
    first = F.array(F.struct(F.lit(0).alias("len"), F.size("words").alias("at"), F.lit(0).cast("long").alias("h")))
    # The outer form, which is never empty here, keeps Spark from testing for rows by building the windows twice.
    hits = rows.withColumn("windows", F.concat(first, *windows)).select(*by, "words", F.inline_outer("windows")).join(
        table, (F.col("len") == F.col("b_len")) & (F.col("h") == F.col("b_h"))
        & ((F.col("len") == 0) | (F.slice("words", F.col("at") + 1, F.greatest("len", F.lit(1))) == F.col("gram"))),
    )
    return hits.groupBy(*by).agg(
        F.max(F.when(F.col("len") == 0, F.col("at"))).cast("long").alias("n_words"),
        F.count(F.when(F.col("len") == 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("len") > 0, F.struct("at", "len"))).alias("spans"),
        F.flatten(F.collect_set("items")).alias("items"),
    )


def _by_shuffle(rows, grams, windows, by):
    """Hashes meet first, without words; then the words of the windows whose hash was found are compared."""
    none = F.expr("cast(array() as array<struct<len:int,at:int,h:bigint>>)")
    asked = rows.select("id_", "key_", F.inline(F.concat(none, *windows)))
    known = grams.select("len", "h").distinct()
    maybe = asked.join(known.hint("merge"), ["len", "h"], "left_semi").groupBy("id_", "key_").agg(
        F.collect_set(F.struct("len", "at")).alias("places")).withColumnsRenamed({"id_": "m_id", "key_": "m_key"})
    # A null id is an id.
    same = rows["id_"].eqNullSafe(F.col("m_id")) & (rows["key_"] == F.col("m_key"))
    read = rows.join(maybe.hint("merge"), same).select("id_", "key_", "words", F.explode("places").alias("p")).select(
        "id_", "key_", F.col("p.len").alias("len"), F.col("p.at").alias("at"),
        F.slice("words", F.col("p.at") + 1, F.col("p.len")).alias("gram"))
    hits = read.join(grams.drop("h").hint("merge"), ["len", "gram"]).groupBy("id_", "key_").agg(
        F.collect_set(F.struct("at", "len")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"),
    ).withColumnsRenamed({"id_": "m_id", "key_": "m_key"})
    headers = rows.groupBy(*by).agg(F.max(F.size("words")).cast("long").alias("n_words"), F.count("*").alias("copies"))
    same = headers["id_"].eqNullSafe(F.col("m_id")) & (headers["key_"] == F.col("m_key"))
    return headers.join(hits, same, "left").drop("m_id", "m_key").withColumns({
        "spans": F.coalesce("spans", F.expr("cast(array() as array<struct<at:int,len:int>>)")),
        "items": F.coalesce("items", F.expr("cast(array() as array<string>)"))})


def _find(docs, benchmark, doc_id, text, item, item_text, broadcast_bytes, by):
    grams = benchmark_windows(benchmark, item, item_text)
    octets = F.aggregate(F.concat("gram", "items"), F.lit(64).cast("long"), lambda n, x: n + F.octet_length(x) + 16)
    sizes = grams.groupBy("len").agg(F.sum(octets).alias("octets")).collect()  # at most WINDOW rows
    rows = docs.select(
        F.col(doc_id).alias("id_"), F.xxhash64(group_key(F.col(text))).alias("key_"), F.spark_partition_id().alias("part_"),
        words_of(F.col(text)).alias("words"))
    windows = [_windows(F.col("words"), r["len"]) for r in sorted(sizes, key=lambda r: r["len"])]
    plan = _by_broadcast if sum(r["octets"] for r in sizes) <= broadcast_bytes else _by_shuffle
    found = plan(rows, grams, windows, by).withColumns(
        {"spans": F.sort_array("spans"), "items": F.sort_array(F.array_distinct("items"))})
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(a["end"], x["at"]))).cast("long").alias("n"),
        F.greatest(a["end"], x["at"] + x["len"]).alias("end"),
    ))["n"]
    return found.withColumn("n_hit", covered).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words"))
    ).withColumnRenamed("id_", doc_id)


def scan(docs, benchmark, doc_id="doc_id", text="text", item="item_id", item_text="text", broadcast_bytes=BROADCAST_BYTES):
    """A row per document: id, `key_`, n_words, n_hit, spans, items, contaminated.

    `spans` are (at, len) of the windows found, in words from 0; `items` are the ids, sorted
    as strings; `key_` tells apart documents with one id and different texts. Equal rows are
    counted per input partition and repeated at the end, so no count exceeds a partition's rows.
    """
    found = _find(docs, benchmark, doc_id, text, item, item_text, broadcast_bytes, ["id_", "key_", "part_"])
    return found.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy_", "copies", "part_")


def scan_distinct(docs, benchmark, doc_id="doc_id", text="text", item="item_id", item_text="text", broadcast_bytes=BROADCAST_BYTES):
    """Like `scan`, with one row for all rows of the same id and text."""
    return _find(docs, benchmark, doc_id, text, item, item_text, broadcast_bytes, ["id_", "key_"]).drop("copies")


def remove_documents(docs, benchmark, doc_id="doc_id", text="text", **options):
    """The rows of `docs` that are not contaminated, with their own columns."""
    bad = materialize(
        scan_distinct(docs, benchmark, doc_id, text, **options).where("contaminated")
        .select(F.struct(F.col(doc_id).alias("id"), F.col("key_")).alias("key")), "contaminated")
    own = docs.select(F.struct("*").alias("row"))
    key = F.struct(F.col(f"row.{doc_id}").alias("id"), F.xxhash64(group_key(F.col(f"row.{text}"))).alias("key_"))
    # Null ids compare as equal inside a struct only null-safely.
    own = own.withColumn("key", key).alias("a")
    return own.join(bad.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")), "left_anti").select("row.*")


def remove_spans(docs, benchmark, doc_id="doc_id", text="text", **options):
    """The rows of `docs` with the words of every hit, and what separates them, cut out."""
    hits = scan_distinct(docs, benchmark, doc_id, text, **options).where("n_hit > 0").select(
        F.struct(F.col(doc_id).alias("id"), F.col("key_")).alias("key"), "spans")
    own = docs.select(F.struct("*").alias("row"))
    key = F.struct(F.col(f"row.{doc_id}").alias("id"), F.xxhash64(group_key(F.col(f"row.{text}"))).alias("key_"))
    both = own.withColumn("key", key).alias("a").join(hits.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")), "left")
    old = F.col(f"row.{text}")
    hit_words = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("pieces") - 1), F.col("hit_words"))
    cut = F.concat(F.regexp_extract(old, LEAD, 0), F.array_join(F.transform(left, lambda i: F.get("pieces", i)), ""))
    both = both.withColumn("pieces", F.regexp_extract_all(old, F.lit(PIECE), F.lit(0))).withColumn("hit_words", hit_words)
    return both.withColumn("left", F.when(F.col("spans").isNull(), old).otherwise(cut)).select(
        *[F.col("left" if c == text else f"row.`{c}`").alias(c) for c in docs.columns])
