"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A document's set is its distinct word shingles. Its sketch has t coordinates, filled in
rounds: in round i < t every shingle falls into a hashed bin, in round t + i all fall into
bin i; a coordinate keeps the smallest (round, hash) it gets. The last t rounds guarantee
that every coordinate is filled, rounds stop as soon as all are, and each coordinate agrees
between two sets with a probability equal to their similarity, concentrated as if drawn
independently.

Rows of coordinates are hashed into bands; with 48 bands of 4 a link at similarity 0.75 is
missed with probability 1.2e-8. Equal sets are one class from the start. Shingles that no
other candidate has bound what a set can have in common with any: a pair that can't reach
the similarity by that bound is never made. Inside a bucket pairs are not listed: every
class is compared with one leader per round, the class with the smallest share of shingles
of its own first; links are merged into components, and a bucket whose classes are all in
one component is done. After `ROUNDS` rounds with different leaders, what still lies in
different components of a bucket is compared in full, in blocks of sets, so nothing is
capped and no list of pairs is made. Similarities are verified on full sets.

Defined results: text is lower-cased A-Z; fewer words than a shingle form one shingle; null,
empty or wordless texts have an empty set and link with nothing, not even one another; every
row of a repeated id is judged by its own text; a null id is an id like any other, smaller
than all; an empty table gives no rows; other columns are not looked at. `keep_first` keeps
one row of a component, the one with the smallest id and of those the smallest digest of its
text; of rows equal in id and text it keeps one, the first by their JSON; all rows without
words stay.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from cinelink.llm.components import merge_components
from cinelink.llm.texts import arrow_rows, digest
from cinelink.runtime import materialize

WORDS = 5
PERCENT = 75
BANDS, ROWS = 48, 4
ROUNDS = 2
BLOCK = 256
TEXTS = 250  # whole texts, or pairs of sets, that a Python worker takes at a time
WORDS_KEPT = 50_000  # hashes of words that it remembers
MULTIPLIER, WORD_FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x):
    """A well mixed 64-bit hash of every element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text, words=WORDS, seen=None):
    """Sorted hashes of the distinct shingles of a text."""
    # bytes.lower and bytes.split know A-Z and the white space 20, 09-0D only.
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    seen = {} if seen is None else seen
    for w in set(tokens).difference(seen):
        seen[w] = xxhash.xxh64_intdigest(w)
    hashes = np.fromiter(map(seen.__getitem__, tokens), np.uint64, len(tokens))
    k = min(words, len(tokens))
    out = np.full(len(tokens) - k + 1, len(tokens) if k < words else words, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * WORD_FACTOR + hashes[i:len(tokens) - k + 1 + i])
    return np.unique(out)


def sketch(shingles, coordinates):
    """Fast similarity sketch of a set that isn't empty; several rounds are filled at once."""
    t = coordinates
    value = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    begin, block = 0, -(-2 * t // len(shingles))
    with np.errstate(over="ignore"):
        while begin < 2 * t:
            rounds = np.arange(begin, min(begin + block, 2 * t), dtype=np.uint64)[:, None]
            h = mix(shingles[None, :] + MULTIPLIER * (rounds + np.uint64(1)))
            bins = np.where(rounds < t, (h >> np.uint64(32)) % np.uint64(t), rounds - np.uint64(t)).astype(np.int64)
            # The round goes before the hash, so what a later round adds to a filled coordinate is void.
            np.minimum.at(value, bins.ravel(), ((rounds << np.uint64(54)) | (mix(h) >> np.uint64(10))).ravel())
            if value.max() != np.iinfo(np.uint64).max:
                break
            begin, block = begin + len(rounds), 2 * block
    return value


def bands_of(values, bands, rows):
    """One hash per band of `rows` coordinates."""
    out = np.arange(1, bands + 1, dtype=np.uint64) * MULTIPLIER
    with np.errstate(over="ignore"):
        for column in values.reshape(bands, rows).T:
            out = mix(out * WORD_FACTOR + column)
    return out.view(np.int64)


def profile(docs, doc_id, text, words=WORDS, bands=BANDS, rows=ROWS):
    """(id, digest, set_hash, n_shingles, bands) of every row; `digest` stands for the text."""
    def run(batches):
        seen = {}
        for batch in batches:
            names, sizes, found = [], [], []
            for t in batch.column(2):
                if len(seen) > WORDS_KEPT:
                    seen.clear()
                s = shingle_set(t.as_py(), words, seen)
                names.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                found.append(bands_of(sketch(s, bands * rows), bands, rows) if len(s) else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), lists],
                ["id", "digest", "set_hash", "n_shingles", "bands"])

    ids = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {ids}, digest binary, set_hash binary, n_shingles long, bands array<long>")


def _verify(pairs, sets, percent):
    """The pairs (a, b) whose sets are similar enough. Each set is read whole."""
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")), "b")

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * common >= percent * (len(p) + len(q) - common))
        return pd.Series(out, dtype=bool)

    return both.where(similar("x", "y")).select("a", "b")


def _shared_sizes(sets):
    """(class, shared): how many shingles of each set are in any other set of the table."""
    def spread(batches):
        for batch in batches:
            for name, raw in zip(batch["class"], batch["shingles"]):
                yield pd.DataFrame({"class": name, "shingle": np.frombuffer(raw, np.int64)})

    own = sets.mapInPandas(spread, "class long, shingle long").groupBy("shingle").agg(
        F.count("*").alias("c"), F.min("class").alias("class")).where("c = 1").groupBy("class").agg(F.count("*").alias("own"))
    return sets.select("class", (F.octet_length("shingles") / 8).cast("long").alias("n")).join(own, "class", "left").select(
        "class", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"))


def _may_link(percent):
    """Whether sizes allow a link: two sets have no more in common than what each shares with any set."""
    most = F.least("s_a", "s_b")
    return 100 * most >= percent * (F.col("n_a") + F.col("n_b") - most)


def _rest(state, heads, sets, percent, block=BLOCK):
    """Links between components that still share a bucket, compared in full, in blocks.

    Classes joined by such buckets form a crowd. All outside its largest component ask all
    others. Askers and asked are cut into blocks of about `block` sets, and every pair of
    blocks is a cell; a set is sent once per block of the other side, a pair is no row. A
    cell is a group of its own, so groups stay as small as two blocks however large the
    crowd; only crowds of one cell share groups, of about a block's sets.
    """
    open_ = materialize(state.join(heads.select("bucket", F.col("head.class").alias("head")), "bucket").select(
        "class", "n", "s", "part", "head").distinct(), "open")
    if open_.isEmpty():
        return open_.select(F.col("class").alias("a"), F.col("head").alias("b"))
    crowds = materialize(merge_components(open_, "class", "head", "class", "crowd"), "crowds")
    members = materialize(open_.select("class", "n", "s", "part").distinct().join(crowds, "class"), "members")
    sizes = members.groupBy("crowd", "part").agg(F.count("*").alias("c"))
    shape = sizes.groupBy("crowd").agg(F.sum("c").alias("all"), F.max(F.struct("c", "part")).alias("top")).select(
        "crowd", F.col("top.part").alias("top"), F.ceil(F.col("all") / block).alias("across"),
        F.greatest(F.ceil((F.col("all") - F.col("top.c")) / block), F.lit(1)).alias("down"))
    rows = members.join(shape, "crowd").join(sets, "class")
    bins = max(1, members.count() // block)

    def side(frame, asks):
        own, other = ("down", "across") if asks else ("across", "down")
        frame = frame.where(F.col("part") != F.col("top")) if asks else frame
        mine = F.pmod(F.xxhash64("class"), F.col(own))
        group = F.when(F.col("down") * F.col("across") > 1, F.col("crowd")).otherwise(F.pmod(F.xxhash64("crowd"), F.lit(bins)))
        frame = frame.select("crowd", "class", "part", "n", "s", "shingles", group.alias("bin"), mine.cast("long").alias(own), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other))
        return frame.toDF(*frame.columns)  # columns of its own: both sides come from one table

    def compare(asking, asked):
        cells = {k: g for k, g in asked.groupby(["crowd", "down", "across"])}
        out = []
        for key, left in asking.groupby(["crowd", "down", "across"]):
            right = cells.get(key)
            if right is None:
                continue
            arrays = [np.frombuffer(x, np.uint64) for x in right["shingles"]]
            every, owner = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
            n, s, name, part = (right[c].to_numpy() for c in ("n", "s", "class", "part"))
            for row in left.itertuples():
                most = np.minimum(s, row.s)
                if not ((part != row.part) & (100 * most >= percent * (n + row.n - most))).any():
                    continue
                x = np.frombuffer(row.shingles, np.uint64)
                at = np.minimum(np.searchsorted(x, every), len(x) - 1)
                common = np.bincount(owner[x[at] == every], minlength=len(arrays))
                good = (part != row.part) & (100 * common >= percent * (n + row.n - common))
                out.extend((min(row[cls], int(k)), max(row[cls], int(k))) for k in name[good])
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    cls = 2  # place of `class` in a row, after the index and the crowd
    key = ["bin", "down", "across"]
    found = side(rows, True).groupBy(key).cogroup(side(rows, False).groupBy(key)).applyInPandas(compare, "a long, b long")
    return materialize(found.distinct(), "links")


def _components(docs, doc_id="doc_id", text="text", words=WORDS, percent=PERCENT, bands=BANDS, rows=ROWS, rounds=ROUNDS):
    """(id, digest, n_shingles, part) of every row; rows of one component have one `part`, rows without words none."""
    found = materialize(profile(docs, doc_id, text, words, bands, rows), "profile")
    # Classes of equal sets, under the smallest id; numbers of classes are hashes of their sets.
    filled = found.where("n_shingles > 0").withColumn("class", F.xxhash64("set_hash"))
    buckets = filled.select("class", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    several = buckets.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("bucket")
    buckets = materialize(buckets.join(several, "bucket").distinct(), "buckets")
    wanted = materialize(buckets.select("class").distinct(), "wanted")

    # One text of every class that shares a bucket, turned into its set once more.
    owners = filled.groupBy("class").agg(F.min(F.struct("id")).alias("key")).join(wanted, "class")
    source = docs.select(F.struct(F.col(doc_id).alias("id")).alias("own"), F.col(text).cast("string").alias("text"))
    texts = source.join(owners, F.col("own").eqNullSafe(F.col("key"))).select("class", "text")

    def to_sets(batches):
        for batch in batches:
            made = [shingle_set(t.as_py(), words).tobytes() for t in batch.column(1)]
            # An id may stand on several rows: only the text of the class counts.
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in made], pa.binary()), pa.array(made, pa.binary())],
                ["class", "set_hash", "shingles"])

    sets = texts.mapInArrow(to_sets, "class long, set_hash binary, shingles binary")
    sets = materialize(sets.where(F.col("class") == F.xxhash64("set_hash")).dropDuplicates(["class"]).select("class", "shingles"), "sets")
    # A link needs percent of the larger set in common, so a set that shares less with all others has none.
    shared = _shared_sizes(sets).withColumnRenamed("shared", "s")
    buckets = materialize(buckets.join(shared, "class").where(100 * F.col("s") >= percent * F.col("n")), "buckets")

    links, parts = None, None

    def add(fresh):
        nonlocal links, parts
        if not fresh.isEmpty():
            links = fresh if links is None else materialize(links.union(fresh), "links")
            parts = materialize(merge_components(links, "a", "b", "class", "part"), "parts")

    def state():
        if parts is None:
            return buckets.withColumn("part", F.col("class"))
        return buckets.join(parts, "class", "left").withColumn("part", F.coalesce("part", F.col("class")))

    def heads(turn):
        """The leader of every bucket that still holds several components."""
        rank = 1 - F.col("s") / F.col("n") if turn == 0 else F.xxhash64("class", F.lit(turn)).cast("double")
        order = F.struct(rank.alias("rank"), *[F.col(c).alias(c) for c in ("class", "n", "s", "part")])
        return state().groupBy("bucket").agg(
            F.min(order).alias("head"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")

    for turn in range(rounds):
        pairs = state().join(heads(turn).select("bucket", "head"), "bucket").where(F.col("part") != F.col("head.part")).select(
            F.col("class").alias("a"), F.col("head.class").alias("b"), F.col("n").alias("n_a"), F.col("head.n").alias("n_b"),
            F.col("s").alias("s_a"), F.col("head.s").alias("s_b"))
        pairs = pairs.where(_may_link(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        add(materialize(_verify(pairs, sets, percent), "links"))
    add(_rest(state(), heads(0), sets, percent))

    own = found.select("id", "digest", "n_shingles", F.when(F.col("n_shingles") > 0, F.xxhash64("set_hash")).alias("class"))
    if parts is None:
        return own.withColumnRenamed("class", "part")
    return own.join(parts, "class", "left").withColumn("part", F.coalesce("part", "class")).drop("class")


def link(docs, doc_id="doc_id", text="text", **options):
    """(id, n_shingles, component_id, kept) of every document."""
    with arrow_rows(docs.sparkSession, TEXTS):
        labelled = _components(docs, doc_id, text, **options)
    filled = labelled.where("part is not null")
    least = filled.groupBy("part").agg(F.min(F.struct("id")).alias("least"))
    full = filled.join(least, "part").select("id", "n_shingles", F.col("least.id").alias("component_id"))
    empty = labelled.where("part is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return full.union(empty).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def keep_first(docs, doc_id="doc_id", text="text", **options):
    """One row of every component of `docs`, and all rows without words, with their own columns."""
    with arrow_rows(docs.sparkSession, TEXTS):
        labelled = _components(docs, doc_id, text, **options).where("part is not null")
    name = F.struct("id", "digest")
    rows = labelled.groupBy("part", "id", "digest").agg(F.count("*").alias("n"))
    least = labelled.groupBy("part").agg(F.min(name).alias("least"))
    # Rows that go, and rows of which one stays; all others are not mentioned.
    told = rows.join(least, "part").select(name.alias("key"), (name != F.col("least")).alias("gone"), "n").where("gone or n > 1")
    told = materialize(told.select("key", "gone"), "copies")
    own = docs.select(F.struct("*").alias("row")).withColumn(
        "own", F.struct(F.col(f"row.{doc_id}").alias("id"), digest(F.col(f"row.{text}")).alias("digest")))
    # Whole rows move once at every size; a table of copies grows with the rows, so it is not broadcast.
    mentioned = own.join(told.hint("merge"), F.col("own").eqNullSafe(F.col("key")), "left")
    alone = mentioned.where("gone is null").select("row")
    first = mentioned.where("not gone").groupBy("own").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return alone.union(first).select("row.*")
