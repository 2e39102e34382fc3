"""Line dedup: two Bloom filters find the suspected repeats, only those are shuffled and counted.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys that are
long enough and stand in enough documents lose all their lines but those of one document,
the one with the largest id among the holders.

First scan: every document names the hashes of its distinct keys, eight bytes each. They
are dealt out by hash, and every task enters its share in a Bloom filter of hashes seen once;
a hash that the filter holds already has been seen twice. Shares, and so the filters, have
a fixed size, their number follows the text. The hashes seen twice make the second Bloom
filter, one for all documents. It has 16 bits a hash up to a fixed size, `most_bits`; beyond
that it gets denser, which suspects more lines but misses none, so what is broadcast is
bounded. Second scan: lines whose hash the second filter holds are suspects. Only they are
shuffled, to be counted by their whole key; lines that are never repeated stay where they are.

Neither filter forgets what it was given, so every repeated key is suspected; what is only
suspected is counted exactly and left alone.

Defined results: null and empty texts are one empty line; every row is a document, rows of
one id included, and a key's lines stay in all rows of its largest id; null is the smallest
id; equal rows get equal results; when all lines go, the empty text is left; an empty table
gives no rows; columns other than `keep` are not looked at.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from cinelink.llm.texts import arrow_rows, digest, hot_splits, text_or_empty
from cinelink.runtime import materialize, skew_join

MIN_LENGTH = 40
MIN_DOCS = 5
PROBES = 4
SHARE = 1 << 21  # hashes in one filter of those seen once
MOST_BITS = 1 << 28  # of the filter of those seen twice: 32 MB
BLOCK_BITS = 1 << 15  # of one row of the stored filter, what bitmap_construct_agg takes
ROWS = 1000  # texts in one batch
BLANK = " \t\n\v\f\r"
SPAN = "array<struct<a:int,b:int>>"


def long_keys(text, min_length=MIN_LENGTH):
    """{key: [(from, to) of its lines, in bytes]} of the keys of at least `min_length` code points."""
    found, at = {}, 0
    for line in (text or "").split("\n"):
        size = len(line) if line.isascii() else len(line.encode("utf-8", "surrogatepass"))
        if len(line) >= min_length:
            key = line.strip(BLANK)
            if len(key) >= min_length:
                # Lower-casing bytes changes A-Z only.
                found.setdefault(key.encode("utf-8", "surrogatepass").lower(), []).append((at, at + size))
        at += size + 1
    return found


def positions(hashes, bits):
    """Where `PROBES` bits of every hash stand in a filter of `bits` (a power of two) bits."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _power_of_two(n):
    return 1 << max(n - 1, 1).bit_length()


def _hashes(keys):
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def seen_twice(docs, text, min_length=MIN_LENGTH, share=SHARE):
    """Hashes of keys that two rows hold, and few others; a hash may come up more than once."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_or_empty(F.col(text))))).first()[0] or 0
    most = size // (min_length + 1) + 1  # keys of at least `min_length` bytes and a line feed
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-most // share))
    bits = _power_of_two(8 * -(-most // tasks))

    def name(batches):
        for batch in batches:
            rows = [_hashes(long_keys(t.as_py(), min_length)) for t in batch.column(0)]
            if not rows:
                continue
            hashes, times = np.unique(np.concatenate(rows), return_counts=True)
            # Two are enough to tell that a hash was seen twice.
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[hashes, hashes[times > 1]].view(np.int64))], ["hash"])

    def enter(batches):
        once = np.zeros(bits, bool)
        for batch in batches:
            hashes, times = np.unique(batch["hash"].to_numpy().view(np.uint64), return_counts=True)
            at = positions(hashes, bits)
            again = once[at].all(axis=1) | (times > 1)
            once[at[~again].ravel()] = True
            once[at[times > 1].ravel()] = True
            yield pd.DataFrame({"hash": hashes[again].view(np.int64)})

    named = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(name, "hash long")
    with arrow_rows(spark, ROWS):
        named = materialize(named, "line-hashes")
    return named.repartition(tasks, "hash").mapInPandas(enter, "hash long")


def twice_filter(hashes, most_bits=MOST_BITS):
    """(bytes, bits) of the Bloom filter of a stored table of hashes; at most `most_bits` bits."""
    bits = min(max(_power_of_two(16 * hashes.count()), BLOCK_BITS), most_bits)
    low, high = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1).cast("long"))
    at = F.explode(F.array(*[(low + high * i).bitwiseAND(F.lit(bits - 1).cast("long")) for i in range(PROBES)])).alias("at")
    blocks = hashes.select(at).groupBy(F.shiftright("at", BLOCK_BITS.bit_length() - 1).alias("block")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long"))).alias("bitmap"))
    out = bytearray(bits // 8)
    for r in blocks.collect():  # `most_bits` at most
        out[r["block"] * BLOCK_BITS // 8:(r["block"] + 1) * BLOCK_BITS // 8] = r["bitmap"]
    return bytes(out), bits


def suspects(docs, doc_id, text, table, bits, min_length=MIN_LENGTH):
    """(id, digest, key, spans) of every row and key that the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = f"id {docs.schema[doc_id].dataType.simpleString()}, digest binary, key binary, spans {SPAN}"

    def probe(batches):
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            own, keys = [], []
            for i, t in enumerate(batch.column(2)):
                for key, where in long_keys(t.as_py(), min_length).items():
                    own.append((i, where))
                    keys.append(key)
            at = positions(_hashes(keys), bits)
            hit = np.flatnonzero(((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1))
            rows = pa.array([own[h][0] for h in hit], pa.int64())
            spans = pa.array(
                [[{"a": a, "b": b} for a, b in own[h][1]] for h in hit], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array([keys[h] for h in hit], pa.binary()), spans],
                ["id", "digest", "key", "spans"])

    return docs.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"), F.col(text).cast("string").alias("text")).mapInArrow(probe, schema)


def repeated_lines(docs, doc_id="doc_id", text="text", min_length=MIN_LENGTH, min_docs=MIN_DOCS, most_bits=MOST_BITS, share=SHARE):
    """(id, digest, spans) of every different row that loses lines; `spans` are its lost lines in order, in bytes."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    spark = docs.sparkSession
    table, bits = twice_filter(materialize(seen_twice(docs, text, min_length, share), "seen-twice"), most_bits)
    with arrow_rows(spark, ROWS):
        found = materialize(suspects(docs, doc_id, text, table, bits, min_length), "suspects")
    counted = found.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    counted = materialize(counted.select(F.unhex(F.md5("key")).alias("line"), "n", "keeper"), "repeated")
    # A line of boilerplate may stand in a third of all documents.
    hot = hot_splits(counted, ["line"], "n", found.count())
    lines = found.select("id", "digest", F.unhex(F.md5("key")).alias("line"), "spans")
    lost = skew_join(lines, counted.select("line", "keeper"), ["line"], "inner", hot, spread_by=["id", "digest"])
    lost = lost.where(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("id", "digest").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def without(raw, spans):
    """The text of UTF-8 bytes without the lines at `spans`; what is left is joined by line feeds."""
    n, size = F.size(spans), F.octet_length(raw)

    def run(i):
        return F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["b"] + 1).alias("a"),
            F.when(i == n, size).otherwise(F.get(spans, i)["a"] - 1).alias("b"))

    runs = F.filter(F.transform(F.sequence(F.lit(0), n), run), lambda r: r["a"] <= r["b"])
    return F.array_join(F.transform(runs, lambda r: F.decode(F.substring(raw, r["a"] + 1, r["b"] - r["a"]), "UTF-8")), "\n")


def drop_lines(docs, doc_id="doc_id", text="text", keep=("doc_id",), **options):
    """`keep` columns, n_lines, n_dropped and the text left (`kept`) of every row."""
    lost = materialize(repeated_lines(docs, doc_id, text, **options), "lost-lines").select(
        F.col("id").alias("id_"), F.col("digest").alias("digest_"), F.col("spans").alias("spans_"))
    own = docs.select(
        F.struct(*keep).alias("row_"), F.col(doc_id).alias("own_"), digest(F.col(text)).alias("mine_"), text_or_empty(F.col(text)).alias("text_"))
    rows = own.join(lost, (F.col("mine_") == F.col("digest_")) & F.col("own_").eqNullSafe(F.col("id_")), "left")
    left = F.when(F.col("spans_").isNull(), F.col("text_")).otherwise(without(F.encode("text_", "UTF-8"), F.col("spans_")))
    return rows.select(
        "row_.*", (F.length("text_") - F.length(F.replace("text_", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("spans_"), F.lit(0)).cast("long").alias("n_dropped"), left.alias("kept"))


def remove_lines(docs, doc_id="doc_id", text="text", **options):
    """The rows of `docs` with their own columns, `text` without its repeated lines."""
    kept = drop_lines(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.struct("*").alias("all")),
                      "id", "text", keep=("all",), **options)
    return kept.select(*[F.col("kept").alias(c) if c == text else F.col("all")[c].alias(c) for c in docs.columns])
