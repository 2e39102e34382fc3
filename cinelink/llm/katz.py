"""LM scoring: Katz backoff with Good-Turing discounts.

A text is its words, lower-cased A-Z, and one end. Texts are cut into chunks of about
`CHUNK` tokens. A chunk asks for the counts of its distinct n-grams in packets of sorted
hashes, one packet per bucket of the hash space; a bucket adds up what all chunks hold and
answers every packet. So a token costs a few bytes on the wire instead of a row, counting
and look-up are one exchange, and counts cover the whole corpus. Orders are counted one
after another, each into a table of its own. An answer also holds the place of every n-gram in
its bucket, the short name by which it is asked for as a context.

Discounts follow from the counts of counts (Katz, up to 5). The backoff weight of a context h
needs, over every n-gram type h w once, its discounted count and its probability P(w|h') of the
next lower order. As h w was seen, so was h' w: P(w|h') is a discounted count over the divisor of
h', which is the same for all w. So both are sums of discounted counts, and one exchange serves the
contexts of all orders; of each type, the first chunk that trains it contributes. Discounts touch counts
up to 5 only, so whole numbers travel: how many types have each of these counts, and the sum of
the counts below. They add up exactly in any order. Then
P(w|h) = d(r) r / c(h) where the n-gram was seen, and weight(h) P(w|h') else, down to
unigrams, whose left-over is the probability of the one unknown token. Probabilities of all
known tokens and the unknown one add up to 1 in every context: a context whose discounts
leave nothing is divided by c(h) + 1 instead.

Defined results: null or empty texts are an end alone; repeated rows are texts of their
own; a null id is scored like any other; without training texts every token has
probability 1; an empty table gives no rows; other columns are not looked at.
"""

from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from cinelink.runtime import discard, materialize, new_path

ORDER = 3
CHUNK = 1 << 20
BUCKET = 1 << 21
UP_TO = 5  # counts above are not discounted
START, END = np.uint64(xxhash.xxh64_intdigest(b"\t")), b"\n"  # no word holds white space
COLUMNS = ["chunk", "kind", "bucket", "a", "b", "c", "d"]
PACKET = "chunk long, kind int, bucket int, a binary, b binary, c binary, d binary"
PARTS = 4  # chunks take answers, and buckets answer for contexts, in this many passes: a part is in flight at a time
CONTEXT, AT_START = 100, 200  # added to the order: kinds of the packets about contexts, and about the start of a text


def mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(values, kind):
    """Bytes of an array, the first bytes of all numbers first, then the second, compressed."""
    values = np.ascontiguousarray(values, kind)
    planes = np.empty((values.itemsize, len(values)), np.uint8)
    for i, plane in enumerate(planes):  # one at a time: far cheaper than a transposed copy
        plane[:] = values.view(np.uint8)[i::values.itemsize]
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw, kind):
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    values = np.empty(len(raw), np.uint8)
    for i, plane in enumerate(raw.reshape(size, -1)):
        values[i::size] = plane
    return values.view(kind)


def pack_sorted(keys):
    return pack(np.diff(keys, prepend=np.uint64(0)), np.uint64)


def unpack_sorted(raw):
    return np.cumsum(unpack(raw, np.uint64), dtype=np.uint64)


def pack_small(values):
    """Whole numbers from 0 on, in as few bytes each as the largest needs."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return kind.char.encode() + pack(values, kind)


def unpack_small(raw):
    return unpack(raw[1:], np.dtype(raw[:1].decode())).astype(np.int64)


def tokenize(text):
    # bytes.lower and bytes.split know A-Z and the white space 20, 09-0D only.
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _numbers():
    """A dict that gives new words the next number; the end is 0."""
    numbers = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[END]
    return numbers


def _chunks(docs, doc_id, text, held_out, size):
    """Rows of about `size` tokens: ids, held_out, lengths, vocabulary hashes, tokens as places in it."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, held, lengths, tokens, vocabulary, total = [], [], [], [], _numbers(), 0

        def row():
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
            order = np.argsort(hashes)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            return pd.DataFrame({
                "chunk": [number], "ids": [ids], "held": [held], "n": [total], "lengths": [pack(lengths, np.int64)],
                "vocabulary": [pack_sorted(hashes[order])], "tokens": [pack(place[np.concatenate(tokens)], np.int32)]})

        for batch in batches:
            for key, text_, out in zip(batch["id"], batch["text"], batch["held"]):
                words = tokenize(text_)
                words.append(END)
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                ids.append(key)
                held.append(out)
                lengths.append(len(words))
                total += len(words)
                if total >= size:
                    yield row()
                    number += 1
                    ids, held, lengths, tokens, vocabulary, total = [], [], [], [], _numbers(), 0
        if ids:
            yield row()

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), held_out.alias("held"))
    # Ids travel as text, so that null ids do not turn whole numbers into fractions.
    return rows.withColumn("id", F.col("id").cast("string")).mapInPandas(
        run, "chunk long, ids array<string>, held array<boolean>, n long, lengths binary, vocabulary binary, tokens binary"), kind


class Grams:
    """The n-grams of a chunk: `keys[k]` sorted and distinct, `at[k]` the place of every token's k-gram in them.

    `orders`: those that are needed, all up to `order` by default.
    """

    def __init__(self, vocabulary, tokens, lengths, order, orders=None):
        words = unpack_sorted(vocabulary)
        tokens = unpack(tokens, np.int32)
        self.lengths = unpack(lengths, np.int64)
        self.starts = np.cumsum(np.r_[0, self.lengths[:-1]])
        doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.inside = np.arange(len(tokens)) - self.starts[doc]
        word = words[tokens]
        self.doc, self.keys, self.at = doc, {1: words}, {1: tokens.astype(np.int64)}
        full = word
        with np.errstate(over="ignore"):
            for k in range(2, order + 1):
                # The context of order k is the gram of order k - 1 that ends one token before.
                context = np.where(self.inside > 0, np.r_[START, full[:-1]], START + np.uint64(k))
                full = mix(context * np.uint64(0x9E3779B97F4A7C15) + word)
                if orders is None or k in orders:
                    self.keys[k], self.at[k] = np.unique(full, return_inverse=True)

    def counts(self, k, weights):
        return np.bincount(self.at[k], weights, minlength=len(self.keys[k])).astype(np.int64)

    def contexts(self, k):
        """The place of every token's context of order k in `keys[k - 1]`; the start of a text comes after those."""
        return np.where(self.inside > 0, np.r_[0, self.at[k - 1][:-1]], len(self.keys[k - 1]))


def _buckets_of(keys, buckets):
    """Where each of `buckets` equal parts of the hash space begins in sorted keys."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]
    return np.r_[0, np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]


def _ask(chunks, k, buckets):
    """Packets (sorted hashes, training counts) of the k-grams of every chunk and bucket."""
    def run(batches):
        for batch in batches:
            for row in batch.itertuples():
                grams = Grams(row.vocabulary, row.tokens, row.lengths, k, [k])
                counts = grams.counts(k, ~np.asarray(row.held, bool)[grams.doc])
                cuts, out = _buckets_of(grams.keys[k], buckets), []
                for b in range(buckets):
                    part = slice(cuts[b], cuts[b + 1])
                    if cuts[b] < cuts[b + 1]:
                        out.append((row.chunk, k, b, pack_sorted(grams.keys[k][part]), pack(counts[part], np.int64), None, None))
                yield pd.DataFrame(out, columns=COLUMNS)

    return chunks.select("chunk", "held", "lengths", "vocabulary", "tokens").mapInPandas(run, PACKET)


def _answer_counts(rows):
    """Of every key asked for: total count, whether this packet is the first that trains it, and its place from 1 on."""
    rows = rows.sort_values("chunk")
    kind, bucket = int(rows["kind"].iloc[0]), int(rows["bucket"].iloc[0])
    keys = [unpack_sorted(r) for r in rows["a"]]
    ends = np.cumsum([len(k) for k in keys])
    distinct, group = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpack(r, np.int64) for r in rows["b"]])
    total = np.bincount(group, counts, minlength=len(distinct)).astype(np.int64)
    trains = np.flatnonzero(counts)
    owned = np.zeros(len(group), np.uint8)
    owned[trains[np.unique(group[trains], return_index=True)[1]]] = 1
    out = []
    for chunk, end, own in zip(rows["chunk"], ends, keys):
        part = slice(end - len(own), end)
        places = pack(np.diff(group[part] + 1, prepend=0), np.int32)
        out.append((int(chunk), kind, bucket, pack(total[group[part]], np.int64), pack(owned[part], np.uint8), places, None))
    # Counts of counts 1 to UP_TO + 1, tokens and types of this bucket.
    some = np.r_[[(total == r).sum() for r in range(1, UP_TO + 2)], total.sum(), (total > 0).sum()].astype(np.int64)
    out.append((-1, kind, bucket, some.tobytes(), None, None, None))
    return pd.DataFrame(out, columns=COLUMNS)


def discounts(counts_of_counts):
    """d(0) to d(UP_TO + 1); the last stands for all larger counts. Where Katz's are not in (0, 1], none."""
    n = [float(x) for x in counts_of_counts]
    out = np.ones(UP_TO + 2)
    if n[0] > 0 and n[UP_TO] > 0:
        common = (UP_TO + 1) * n[UP_TO] / n[0]
        for r in range(1, UP_TO + 1):
            if n[r - 1] > 0 and common < 1:
                d = ((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common)
                out[r] = d if 0 < d <= 1 else 1.0
    return out


def _sums(rows):
    """Arrays of the same kind in packets of no chunk, added up place by place: a few numbers per order reach the driver."""
    number = F.pandas_udf(lambda raw: raw.map(lambda x: np.frombuffer(x, np.int64).tolist()), "array<long>")
    each = rows.where("chunk < 0").select("kind", F.posexplode(number("a"))).groupBy("kind", "pos").agg(F.sum("col").alias("n"))
    out = {}
    for r in each.orderBy("kind", "pos").collect():
        out.setdefault(r["kind"], []).append(r["n"])
    return {kind: np.array(n, np.int64) for kind, n in out.items()}


class Model:
    """Statistics of all orders: what a task needs besides the answers to its chunk."""

    def __init__(self, order, statistics):
        statistics = {k: statistics.get(k, np.zeros(UP_TO + 3)) for k in range(1, order + 1)}
        self.at_start = {k: np.zeros(2 * UP_TO + 1, np.int64) for k in range(2, order + 1)}
        self.d = {k: discounts(s[:UP_TO + 1]) for k, s in statistics.items()}
        self.tokens, self.types = int(statistics[1][UP_TO + 1]), int(statistics[1][UP_TO + 2])
        n = statistics[1]
        small = sum(r * n[r - 1] for r in range(1, UP_TO + 1))
        kept = sum(self.d[1][r] * r * n[r - 1] for r in range(1, UP_TO + 1)) + self.tokens - small
        self.total = self.tokens if kept < self.tokens else self.tokens + 1
        self.unknown = 1.0 - kept / self.total

    def discounted(self, k, r):
        return self.d[k][np.minimum(r, UP_TO + 1)] * r

    def taken(self, k):
        """What discounts take from a type with count 1, 2, to UP_TO."""
        r = np.arange(1, UP_TO + 1)
        return r - self.discounted(k, r)

    def unigram(self, r):
        return np.where(r > 0, self.discounted(1, r) / self.total, self.unknown)

    def base(self, r):
        return np.log10((r + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def _gather(rows, kind, column, numbers):
    part = rows[rows["kind"] == kind].sort_values("bucket")
    return np.concatenate([unpack(x, numbers) for x in part[column]]) if len(part) else np.empty(0, numbers)


def _follow_sums(contexts, counts, below, n):
    """Per context, over its types: how many have counts 1 to UP_TO, how many have these one order below, and all counts there."""
    sums = np.zeros((2 * UP_TO + 1, n), np.int64)
    for r in range(1, UP_TO + 1):
        sums[r - 1] = np.bincount(contexts[counts == r], minlength=n)
        sums[UP_TO + r - 1] = np.bincount(contexts[below == r], minlength=n)
    np.add.at(sums[-1], contexts, below)
    return sums


def _contexts(order, buckets):
    """Sums over the types that a chunk owns, of its contexts of all orders."""
    def run(rows):
        text = rows[rows["kind"] == 0].iloc[0]
        grams, out = Grams(text["b"], text["c"], text["d"], order), []
        count = {k: _gather(rows, k, "a", np.int64) for k in range(1, order + 1)}
        for k in range(2, order + 1):
            anywhere = np.empty(len(grams.keys[k]), np.int64)  # a token at which each type stands
            anywhere[grams.at[k]] = np.arange(len(grams.at[k]))
            owned = _gather(rows, k, "b", np.uint8) > 0
            anywhere = anywhere[owned]
            sums = _follow_sums(
                grams.contexts(k)[anywhere], count[k][owned], count[k - 1][grams.at[k - 1][anywhere]], len(grams.keys[k - 1]) + 1)
            cuts = _buckets_of(grams.keys[k - 1], buckets)
            places = rows[rows["kind"] == k - 1].set_index("bucket")["c"]
            for b in range(buckets):
                part = slice(cuts[b], cuts[b + 1])
                if cuts[b] < cuts[b + 1]:
                    out.append((text["chunk"], CONTEXT + k, b, places[b], pack_small(sums[:, part].ravel()), None, None))
            # All texts start in one context: its sums are added up in any bucket and then by Spark.
            some = int(mix(np.array([text["chunk"]], np.int64).view(np.uint64))[0] % np.uint64(buckets))
            out.append((text["chunk"], AT_START + k, some, sums[:, -1].tobytes(), None, None, None))
        return pd.DataFrame(out, columns=COLUMNS)

    return run


def _answer_contexts(rows):
    """Both sums of every context asked for, over all chunks."""
    rows = rows.sort_values("chunk")
    kind, bucket = int(rows["kind"].iloc[0]), int(rows["bucket"].iloc[0])
    if kind > AT_START:
        sums = np.sum([np.frombuffer(r, np.int64) for r in rows["a"]], axis=0)
        return pd.DataFrame([(-1, kind, bucket, sums.tobytes(), None, None, None)], columns=COLUMNS)
    places = [np.cumsum(unpack(r, np.int32)) for r in rows["a"]]
    sums = np.zeros((2 * UP_TO + 1, max(p[-1] for p in places) + 1), np.int64)
    for at, raw in zip(places, rows["b"]):
        sums[:, at] += unpack_small(raw).reshape(len(sums), -1)  # no place comes twice in a packet
    return pd.DataFrame([
        (int(chunk), kind, bucket, pack_small(sums[:, at].ravel()), None, None, None) for chunk, at in zip(rows["chunk"], places)],
        columns=COLUMNS)


def _gather_sums(rows, kind, at_start):
    part = rows[rows["kind"] == kind].sort_values("bucket")
    return np.hstack([unpack_small(raw).reshape(2 * UP_TO + 1, -1) for raw in part["a"]] + [at_start[:, None]])


def _probabilities(grams, rows, model, count, order):
    """P of every token, recursively from the unigram."""
    p, divisor = model.unigram(count[1])[grams.at[1]], float(max(model.total, 1))
    texts = count[1][np.searchsorted(grams.keys[1], np.uint64(xxhash.xxh64_intdigest(END)))]  # as many start as end
    for k in range(2, order + 1):
        contexts, r = grams.contexts(k), count[k][grams.at[k]]
        # A context was followed as often as it was seen.
        seen = np.append(count[k - 1], texts)[contexts]
        sums = _gather_sums(rows, CONTEXT + k, model.at_start[k])
        taken = (model.taken(k) @ sums[:UP_TO])[contexts]
        below = (sums[-1] - model.taken(k - 1) @ sums[UP_TO:-1])[contexts]
        size = np.where(taken > 1e-9 * seen, seen, np.where(seen > 0, seen + 1, 0))
        weight = (taken + size - seen) / np.maximum(size, 1) / np.maximum(1 - below / divisor, 1e-300)
        p = np.where(size == 0, p, np.where(r > 0, model.discounted(k, r) / np.maximum(size, 1), weight * p))
        divisor = np.maximum(size, 1)
    return p


def score(docs, held_out, doc_id="doc_id", text="text", order=ORDER, chunk=CHUNK, bucket=BUCKET):
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    `held_out` is a boolean Column; rows where it is true (or null) do not train.
    """
    rows, id_type = _chunks(docs, doc_id, text, F.coalesce(held_out, F.lit(True)), chunk)
    part = F.pmod(F.xxhash64("chunk"), F.lit(PARTS)).cast("int")

    def stored(packets, label):
        return materialize(packets.withColumn("part", part), label, partition_by=["part"])

    chunks = stored(rows, "chunks")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket))
    counts = [
        stored(_ask(chunks, k, buckets).groupBy("kind", "bucket").applyInPandas(_answer_counts, PACKET), f"counts-{k}")
        for k in range(1, order + 1)]
    counts = reduce(DataFrame.unionByName, counts)
    model = Model(order, _sums(counts))
    spoken = chunks.select(
        "chunk", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("a"),
        F.col("vocabulary").alias("b"), F.col("tokens").alias("c"), F.col("lengths").alias("d"), "ids", "held", "part")
    answers = counts.where("chunk >= 0")

    def ask_contexts(n):
        both = spoken.drop("ids", "held").unionByName(answers).where(F.col("part") == n)
        out = both.drop("part").groupBy("chunk").applyInPandas(_contexts(order, buckets), PACKET)
        return materialize(out.withColumn("share", F.pmod("bucket", F.lit(PARTS))), "asked", ["share"], paths[n])

    def answer_contexts(n):
        some = asked.where(F.col("share") == n).drop("share")
        return stored(some.groupBy("kind", "bucket").applyInPandas(_answer_contexts, PACKET), "contexts")

    paths = [new_path(docs.sparkSession, "asked") for _ in range(PARTS)]
    asked = reduce(DataFrame.unionByName, map(ask_contexts, range(PARTS)))
    contexts = reduce(DataFrame.unionByName, map(answer_contexts, range(PARTS)))
    for path in paths:
        discard(docs.sparkSession, path)
    for kind, sums in _sums(contexts).items():
        model.at_start[kind - AT_START] = sums
    # Places have served, a chunk takes back counts and sums only.
    answers = answers.unionByName(contexts.where("chunk >= 0")).select("chunk", "kind", "bucket", "a", "part")

    def final(rows):
        text_ = rows[rows["kind"] == 0].iloc[0]
        grams = Grams(text_["b"], text_["c"], text_["d"], order)
        count = {k: _gather(rows, k, "a", np.int64) for k in range(1, order + 1)}
        known = count[1][grams.at[1]]
        p = _probabilities(grams, rows, model, count, order) if model.tokens else np.ones(len(grams.doc))
        base = model.base(known) if model.tokens else np.zeros(len(grams.doc))
        return pd.DataFrame({
            "ids": text_["ids"], "held_out": text_["held"], "n_tokens": grams.lengths,
            "n_known": np.add.reduceat((known > 0).astype(np.int64), grams.starts),
            "base_score": np.add.reduceat(base, grams.starts), "score": np.add.reduceat(np.log10(p), grams.starts)})

    def give_scores(n):
        both = spoken.unionByName(answers, allowMissingColumns=True).where(F.col("part") == n)
        return materialize(both.drop("part").groupBy("chunk").applyInPandas(
            final, "ids string, held_out boolean, n_tokens long, n_known long, base_score double, score double"), "scores")

    out = reduce(DataFrame.unionByName, map(give_scores, range(PARTS)))
    return out.select(
        F.col("ids").cast(id_type).alias(doc_id), "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
