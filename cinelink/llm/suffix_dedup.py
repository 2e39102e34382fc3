"""Suffix-array dedup: bytes covered by a long string that starts anywhere else.

Every window of `length` bytes selects an anchor, the k-gram with the smallest hash inside
it, so equal windows select equal anchors. Windows with one anchor form a context, and
contexts meet by the hash of their anchor: an anchor that occurs once can't hold a repeat,
and equal contexts are known to repeat as a whole. Different contexts of one anchor go to
shards, where the suffixes of one copy of each are ordered by external induced sorting
with common prefixes (`induction.py`); windows that share `length` bytes with a neighbour
are one class, and a class with two places repeats.

The number of shards follows the bytes, and an anchor with more than `split` contexts is
dealt over several shards of its own, whose classes then meet by a 128-bit hash of the window. What a
task holds is bounded by the shard size, the split size, and its longest document.

Defined results: null and empty texts have no bytes and no spans; equal texts repeat one
another; every row of a repeated id is a text of its own; an empty table gives no rows;
other columns are not looked at. Matches never cross texts and are judged on the input.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from cinelink.llm.induction import QUEUE_BYTES, suffixes_with_prefixes
from cinelink.llm.texts import digest, hot_splits
from cinelink.runtime import materialize, skew_join

LENGTH = 400
GRAM = 64
SHARD_BYTES = 1 << 20
SPLIT = 1000
BASE = 0x9E3779B97F4A7C15 | 1
_powers = {}


def _power(base, n):
    """1, base, base^2, ... (mod 2^64), kept and grown."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1 << 17), base, np.uint64)
        out[0] = 1
        _powers[base] = np.cumprod(out, dtype=np.uint64)
    return _powers[base][:n]


def _mixed(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def gram_hashes(data, gram):
    """A hash of every substring of `gram` bytes."""
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(VALUES[data] * _power(BASE, len(data)), dtype=np.uint64, out=sums[1:])
        return _mixed((sums[gram:] - sums[:-gram]) * _power(pow(BASE, -1, 1 << 64), len(data) - gram + 1))


def _sliding_min(values, width):
    """Minimum of every `width` neighbours, from running minima of blocks both ways."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw, length=LENGTH, gram=GRAM):
    """(anchor hash, context hash, first window, windows) of every context of a text."""
    if len(raw) < length:
        return []
    hashes = gram_hashes(np.frombuffer(raw, np.uint8), gram)
    # The leftmost of equal hashes wins, in every copy of the window.
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (_sliding_min(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    count = np.diff(np.r_[first, len(chosen)])
    return [
        (int(h), xxhash.xxh3_64_intdigest(raw[a:a + c + length - 1]) - (1 << 63), int(a), int(c))
        for h, a, c in zip(hashes[chosen[first]].view(np.int64), first, count)
    ]


def _raw(text):
    return text.encode("utf-8", "surrogatepass") if text else b""


def profile(texts, length, gram):
    """(digest, anchor, context, start, windows) of every context of every text."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch["digest"], batch["text"]):
                rows.extend((key, *a) for a in anchors(_raw(text), length, gram))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=["digest", "anchor", "context", "start", "windows"])
                    rows = []
            yield pd.DataFrame(rows, columns=["digest", "anchor", "context", "start", "windows"])

    return texts.mapInPandas(run, "digest binary, anchor long, context long, start int, windows int")


def repeats_in_shard(contexts, counts, places, length=LENGTH, memory=QUEUE_BYTES):
    """For each context, which of its windows occur twice or more; and the class of every window.

    `contexts` are byte strings, `counts` how many windows of each count, `places` how many
    copies of it there are.
    """
    sizes = np.array([len(c) for c in contexts])
    starts = np.cumsum(np.r_[0, sizes[:-1] + 1])
    text = np.zeros(int(sizes.sum()) + len(contexts) + 1, np.int64)
    weight = np.zeros(len(text), np.int64)
    for raw, a, n, w in zip(contexts, starts, counts, places):
        text[a:a + len(raw)] = np.frombuffer(raw, np.uint8)
        text[a:a + len(raw)] += 2
        text[a + len(raw)] = 1
        weight[a:a + n] = w
    order, shared = suffixes_with_prefixes(text, memory, (1 << length.bit_length()) - 1)
    classes = np.cumsum(shared < length)
    total = np.bincount(classes, weight[order])
    class_of = np.empty(len(text), np.int64)
    class_of[order] = classes
    hits = (weight > 0) & (total[class_of] > 1)
    return [hits[a:a + n] for a, n in zip(starts, counts)], [class_of[a:a + n] for a, n in zip(starts, counts)]


def _spans(hits, length):
    """[from, to) of the bytes that the windows cover, from a list of yes and no per window."""
    edges = np.flatnonzero(np.diff(np.r_[0, hits.astype(np.int8), 0]))
    out = []
    for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b - 1 + length)
        else:
            out.append((a, b - 1 + length))
    return out


def spans(docs, text="text", length=LENGTH, gram=GRAM, shard_bytes=SHARD_BYTES, split=SPLIT, memory=QUEUE_BYTES):
    """(digest, spans) of every different text with something to remove; spans are maximal, in bytes."""
    texts = docs.select(digest(F.col(text)).alias("digest"), F.col(text).cast("string").alias("text"))
    found = materialize(profile(texts, length, gram), "anchors")
    several = materialize(found.groupBy("anchor").agg(
        F.count("*").alias("n"), (F.min("context") < F.max("context")).alias("mixed")).where("n > 1"), "several")
    # Periodic text, or a passage that a third of all texts holds, has one anchor in very many rows.
    hot = hot_splits(several, ["anchor"], "n", found.count())
    found = skew_join(found, several.select("anchor", "mixed"), ["anchor"], "inner", hot, spread_by=["digest", "start"])
    found = materialize(found, "repeated")
    contexts = found.groupBy("anchor", "context", "mixed").agg(
        F.count("*").alias("places"), F.min(F.struct("digest", "start", "windows")).alias("owner"))
    contexts = materialize(contexts, "contexts")
    whole = contexts.where("not mixed").select(
        "anchor", "context", F.array(F.struct(F.lit(0).alias("a"), (F.col("owner.windows") + length - 1).alias("b"))).alias("runs"))

    mixed = contexts.where("mixed")
    size = mixed.agg(F.sum(F.col("owner.windows") + length)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    parts = materialize(mixed.groupBy("anchor").agg(F.count("*").alias("n"), F.ceil(F.count("*") / split).cast("int").alias("parts")), "parts")
    hot = hot_splits(parts, ["anchor"], "n", found.count())
    salted = skew_join(mixed, parts.drop("n"), ["anchor"], "inner", hot, spread_by=["context"]).withColumn("salt", F.pmod(F.xxhash64("context"), F.col("parts")))
    wanted = salted.select(
        F.col("owner.digest").alias("digest"), F.struct(
            F.when(F.col("parts") > 1, F.xxhash64("anchor", "salt")).otherwise(
                F.pmod(F.xxhash64("anchor"), F.lit(shards))).alias("shard"), "anchor", "context", "places",
            F.col("owner.start").alias("start"), F.col("owner.windows").alias("windows"), F.col("parts").alias("parts"),
        ).alias("w")).groupBy("digest").agg(F.collect_list("w").alias("wanted"))

    def cut(batches):
        for batch in batches:
            rows = []
            for text_, ask in zip(batch["text"], batch["wanted"]):
                raw = _raw(text_)
                for w in ask:
                    rows.append((w["shard"], w["anchor"], w["context"], w["places"], w["windows"], w["parts"],
                                 raw[w["start"]:w["start"] + w["windows"] + length - 1]))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    columns = ["shard", "anchor", "context", "places", "windows", "parts", "raw"]
    # Copies of a text shrink to one before they are shuffled.
    pieces = texts.groupBy("digest").agg(F.first("text").alias("text")).join(wanted, "digest").select("text", "wanted").mapInPandas(
        cut, "shard long, anchor long, context long, places long, windows int, parts int, raw binary")

    def judge(shard):
        hits, classes = repeats_in_shard(
            shard["raw"].tolist(), shard["windows"].tolist(), shard["places"].tolist(), length, memory)
        rows, seen, packets = [], set(), {}
        for anchor, context, parts_, raw, hit, kind in zip(
                shard["anchor"], shard["context"], shard["parts"], shard["raw"], hits, classes):
            rows.extend((anchor, context, a, b, 0, None) for a, b in _spans(hit, length))
            if parts_ > 1:
                # Other parts may hold the rest of a class: one window per class that repeats here, and all others.
                for i, (h, k) in enumerate(zip(hit.tolist(), kind.tolist())):
                    if not h or k not in seen:
                        seen.add(k)
                        key = xxhash.xxh3_128_digest(raw[i:i + length])
                        place = np.array([0 if h else context, -1 if h else i], np.int64).tobytes()
                        packets.setdefault((anchor, key[0] % parts_), []).append(key + place)
        rows.extend((anchor, 0, 0, 0, bucket, b"".join(p)) for (anchor, bucket), p in packets.items())
        return pd.DataFrame(rows, columns=["anchor", "context", "a", "b", "bucket", "windows"])

    def meet(packets):
        """Windows of different parts of one anchor that are equal; a packet holds 32 bytes a window."""
        table = np.frombuffer(b"".join(packets["windows"]), np.uint8).reshape(-1, 32)
        keys = np.ascontiguousarray(table[:, :16]).view("V16").ravel()
        places = np.ascontiguousarray(table[:, 16:]).view(np.int64)
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        places = places[(count[which] > 1) & (places[:, 1] >= 0)]
        rows = []
        for context in np.unique(places[:, 0]):
            at = places[places[:, 0] == context, 1]
            hit = np.zeros(int(at.max()) + 1, bool)
            hit[at] = True
            rows.extend((packets["anchor"].iloc[0], int(context), a, b) for a, b in _spans(hit, length))
        return pd.DataFrame(rows, columns=["anchor", "context", "a", "b"])

    judged = materialize(pieces.groupBy("shard").applyInPandas(
        judge, "anchor long, context long, a int, b int, bucket int, windows binary"), "judged")
    late = judged.where("windows is not null").select("anchor", "bucket", "windows").groupBy("anchor", "bucket").applyInPandas(
        meet, "anchor long, context long, a int, b int")
    partial = judged.where("windows is null").select("anchor", "context", "a", "b").union(late).groupBy("anchor", "context").agg(
        F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))

    places = found.select("digest", "anchor", "context", "start").distinct()
    hot = hot_splits(contexts, ["anchor", "context"], "places", found.count())
    covered = skew_join(places, whole.union(partial), ["anchor", "context"], "inner", hot, spread_by=["digest", "start"]).select(
        "digest", F.transform("runs", lambda r: F.struct(
            (r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"))).alias("runs"))
    all_runs = covered.groupBy("digest").agg(F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"))
    start = F.expr("cast(array() as array<struct<a:int,b:int>>)")

    def join_up(done, r):
        last = F.element_at(done, -1)
        longer = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when(F.size(done) == 0, F.array(r)).when(r["a"] <= last["b"], longer).otherwise(F.concat(done, F.array(r)))

    return all_runs.select("digest", F.aggregate("runs", start, join_up).alias("spans"))


def remove_repeats(docs, text="text", keep=("doc_id",), **options):
    """`keep` columns, n_bytes, spans and the bytes left (`kept`) of every row.

    A cut may fall inside a character, so what is left is bytes.
    """
    found = materialize(spans(docs, text, **options), "spans").withColumnRenamed("digest", "digest_")
    rows = docs.select(*keep, digest(F.col(text)).alias("digest_"), F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8").alias("raw_"))
    # Whole rows move once at every size; a table of spans grows with the rows, so it is not broadcast.
    rows = rows.join(found.hint("merge"), "digest_", "left").withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<a:int,b:int>>)")))
    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<binary>)").alias("parts"))
    walk = F.aggregate("spans", none, lambda s, r: F.struct(
        r["b"].alias("at"),
        F.concat(s["parts"], F.array(F.substring(F.col("raw_"), s["at"] + 1, r["a"] - s["at"]))).alias("parts")))
    rows = rows.withColumn("walk_", walk)
    rest = F.substring(F.col("raw_"), F.col("walk_.at") + 1, F.octet_length("raw_"))
    joined = F.aggregate("walk_.parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x))
    return rows.select(*keep, F.octet_length("raw_").cast("long").alias("n_bytes"), "spans", F.concat(joined, rest).alias("kept"))
