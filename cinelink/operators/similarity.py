"""Similar titles within a year band, without comparing all pairs.

The similarity of two token-sorted titles a and b is 100 * (1 - d / (|a| + |b|)),
where d counts the characters to delete and insert to turn one into the other.
A score of at least T therefore allows at most k = (1 - T/100) * (|a| + |b|) edits,
and d has the parity of |a| + |b|.

Blocking: cut the shorter title into k + 1 pieces. Charge every edit to one piece
(an insertion between two pieces to the right one, at the end to the last). With at
most k edits on k + 1 pieces there is a piece i that has none, with exactly i edits
before it and at most k - i after it: take the last i for which the edits before
piece i number at least i. That piece occurs unchanged in the longer title, shifted
by at most i from its place, and by at most k - i from its place counted from the end.

Lengths of the longer title fall into classes that grow by a fixed ratio, of which a
shorter title can meet about five. It is cut once per class, by the most edits that any
length of the class allows, which keeps the argument. Places in the longer title fall
into buckets about as wide as the shift. So (class, piece text, bucket) is an equi-join
key that misses no pair, for every T; the shorter title names each bucket its piece may
have moved to, the longer one each of its substrings of a length pieces can have. Both
number a small multiple of the title's length. Where k + 1 pieces would leave some
empty, the class alone is the key.
"""

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelink import schema as S
from cinelink.runtime import grid_join, hot_grid, materialize

# Executors need not have this package: the scoring function travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Titles under one block key, per side, that one task compares.
HOT_BLOCK = 50_000

# Titles expanded to block keys by one task.
TITLES_PER_TASK = 50_000

# No text is longer than this.
MAX_LENGTH = 2**31 - 1

# Year keys: a known year meets its neighbours, an unknown year meets everything.
UNKNOWN = -1
ANY = -2


def _max_edits(a, b, threshold):
    """SQL: the largest number of edits allowed between lengths a and b."""
    k = f"cast(floor({(100 - threshold) / 100!r}D * ({a} + {b}) + 1e-9D) as int)"
    return f"({k} - pmod({k} - ({a} + {b}), 2))"


def _longest(n, threshold):
    """SQL: the length of the longest title that one of length n can be similar to."""
    return f"cast(floor({n} * {200 / threshold - 1!r}D + 1e-9D) as int)"


def _classes(threshold):
    """SQL array of all length classes: structs (lo, hi, w), w the width of their buckets."""
    ratio = max((200 / threshold - 1) ** 0.25, 1.05)
    classes, lo = [], 1
    while lo < MAX_LENGTH:
        hi = max(lo, math.ceil(lo * ratio) - 1)
        classes.append(f"struct({lo} as lo, {min(hi, MAX_LENGTH)} as hi, {max(1, int((100 - threshold) / 100 * lo))} as w)")
        lo = hi + 1
    return f"array({', '.join(classes)})"


def _cuts(n, hi, threshold):
    """SQL: the most edits between length n and any length of a class up to `hi`."""
    # Of two neighbouring lengths one has the parity that allows the full number.
    last = f"least({hi}, {_longest(n, threshold)})"
    return f"greatest({_max_edits(n, last, threshold)}, {_max_edits(n, f'({last} - 1)', threshold)})"


def _index_blocks(threshold):
    """SQL array of block keys of a title `s` of length `n` as the shorter side."""
    longest = _longest("n", threshold)
    classes = f"""transform(
        filter({_classes(threshold)}, c -> c.hi >= n and c.lo <= {longest}),
        c -> struct(c.lo as id, c.w as w, greatest(c.lo, n) as lo, least(c.hi, {longest}) as hi,
                    {_cuts('n', 'c.hi', threshold)} as k))"""
    at = lambda i: f"cast(({i}) * n div (c.k + 1) as int)"
    pieces = f"transform(sequence(0, c.k), i -> struct(i, {at('i')} as at, {at('i + 1')} - {at('i')} as size))"
    places = f"""transform({pieces}, p -> struct(p.at as at, p.size as size,
        greatest(0, p.at + greatest(-p.i, c.lo - n - (c.k - p.i))) as first,
        least(c.hi - p.size, p.at + least(p.i, c.hi - n + (c.k - p.i))) as last))"""
    blocks = f"""flatten(transform(filter({places}, p -> p.first <= p.last), p -> transform(
        sequence(cast(p.first div c.w as int), cast(p.last div c.w as int)),
        g -> xxhash64(c.id, g, substring(s, p.at + 1, p.size)))))"""
    return f"array_distinct(flatten(transform({classes}, c -> if(c.k >= n, array(xxhash64(c.id, -1, '')), {blocks}))))"


def _probe_blocks(threshold):
    """SQL array of block keys of a title `s` of length `n` as the longer side."""
    shortest = f"greatest(1, cast(ceil(n * {threshold / (200 - threshold)!r}D - 1e-9D) as int))"
    sizes = f"""array_distinct(flatten(transform(
        transform(sequence({shortest}, n), b -> struct(b, {_cuts('b', 'c.hi', threshold)} as k)),
        x -> if(x.k >= x.b, array(0), array(
            cast(x.b div (x.k + 1) as int), cast((x.b + x.k) div (x.k + 1) as int))))))"""
    return f"""flatten(transform(
        filter({_classes(threshold)}, c -> c.lo <= n and n <= c.hi),
        c -> array_distinct(flatten(transform({sizes}, z -> if(z = 0, array(xxhash64(c.lo, -1, '')), transform(
            sequence(0, n - z), p -> xxhash64(c.lo, cast(p div c.w as int), substring(s, p + 1, z)))))))))"""


# One bit per (character, how many of it): an edit changes at most one bit.
_SIGNATURE = """aggregate(
    flatten(transform(array_distinct(split(s, '')), c ->
        transform(sequence(1, length(s) - length(replace(s, c, ''))), r -> xxhash64(c, r)))),
    0L, (bits, h) -> bits | shiftleft(1L, cast(h & 63 as int)))"""


def common_subsequence(a, b):
    """Length of the longest common subsequence, a row of bits at a time."""
    if a == b:
        return len(a)
    where = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _score(a, b):
    total = len(a) + len(b)
    if not a or not b:
        return 0.0
    return (1.0 - (total - 2 * common_subsequence(a, b)) / total) * 100.0


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """0-100 similarity of two token-sorted titles; null when either is null."""
    return pd.Series([
        None if x is None or y is None else _score(x, y) for x, y in zip(a, b)
    ], dtype="float64")


class Titles:
    """Distinct (token_key, year) groups prepared for blocking; titles and their keys are stored once.

    Columns of `table`: id, s and y (the group), n (length), o (y or -1), bits (signature).
    Columns of `keys`: block, role (b index, a probe), id, n, o, bits; no text.
    `hot_block` is the number of titles under one key, per side, that one task compares.
    """

    def __init__(self, groups, threshold, hot_block=None):
        if not 0 < threshold <= 100:
            raise ValueError("threshold must be in (0, 100]")
        self.threshold, self.hot_block = threshold, hot_block or HOT_BLOCK
        self.table = materialize(
            groups.where("token_key <> ''").selectExpr(
                "token_key as s", "year as y", "length(token_key) as n", "coalesce(year, -1) as o")
            .withColumn("bits", F.expr(_SIGNATURE))
            .withColumn("id", F.monotonically_increasing_id()),
            "titles",
        )
        self.count, undated = self.table.agg(F.count(F.lit(1)), F.count_if(F.col("y").isNull())).first()
        near = "sequence(o - 1, o + 1)"
        self.index_bands = f"if(o = -1, array({UNKNOWN}), concat({near}, array({ANY})))" if undated else near
        self.probe_bands = f"if(o = -1, array({ANY}, {UNKNOWN}), array(o, {UNKNOWN}))" if undated else "array(o)"
        self.index_blocks, self.probe_blocks = _index_blocks(threshold), _probe_blocks(threshold)
        key = F.expr(f"""explode(concat(
            transform({self.index_blocks}, x -> struct(x as block, 'b' as role)),
            transform({self.probe_blocks}, x -> struct(x as block, 'a' as role))))""")
        self.keys = materialize(
            self.spread(self.table).select(key.alias("key"), "id", "n", "o", "bits")
            .select("key.block", "key.role", "id", "n", "o", "bits"),
            "title-keys",
        )

    def spread(self, table):
        """Every title becomes a hundred block keys or more, so partitions start small."""
        tasks = max(table.sparkSession.sparkContext.defaultParallelism, self.count // TITLES_PER_TASK + 1)
        return table.repartition(tasks, "id")

    def keyed(self, role, among=None):
        """One row per title, block key and year band, columns suffixed by the role."""
        keys = self.keys.where(F.col("role") == role)
        if among is not None:
            keys = keys.join(among.select("id"), "id", "left_semi")
        band = F.explode(F.expr(self.index_bands if role == "b" else self.probe_bands))
        return keys.select("block", band.alias("band"), *[F.col(c).alias(f"{c}_{role}") for c in ("id", "n", "o", "bits")])

    def subset(self, groups):
        """The titles among `groups` (token_key, year)."""
        chosen = groups.selectExpr("token_key as s", "coalesce(year, -1) as o").distinct()
        return materialize(self.table.join(chosen, ["s", "o"], "left_semi").select(self.table.columns), "titles")

    def crowded(self):
        """Blocks with more titles than one task should compare, None when there are none."""
        return hot_grid(self.keyed("b"), self.keyed("a"), ["block", "band"], self.hot_block)

    def candidates(self, index=None, probe=None, grid=None):
        """Ids (id_a, id_b) of an index and a probe title that pass every bound that needs no text.

        Each pair may come up under several keys. Titles of equal length meet in both
        roles, of which one is taken.
        """
        k = _max_edits("n_a", "n_b", self.threshold)
        either = index is None and probe is None
        order = "id_a > id_b" if either else "id_a <> id_b"
        worth_reading = F.expr(f"""
            (n_a > n_b or n_a = n_b and {order}) and n_a - n_b <= {k} and bit_count(bits_a ^ bits_b) <= {k}""")
        return grid_join(
            self.keyed("b", index), self.keyed("a", probe), ["block", "band"], worth_reading, grid, ["id_b"], ["id_a"],
        ).select("id_a", "id_b")

    def pairs(self, grid=None, among=None):
        """All pairs scoring at least the threshold: (s_a, y_a, s_b, y_b, score).

        With `among`, a subset of the titles, only pairs with a member in it. The texts
        are read for the distinct pairs that pass the bounds on lengths and signatures.
        """
        if among is None:
            found = self.candidates(grid=grid)
        else:
            found = self.candidates(probe=among, grid=grid).union(self.candidates(index=among, grid=grid))
            # Equal lengths may have met in either role.
            found = found.select(F.greatest("id_a", "id_b").alias("id_a"), F.least("id_a", "id_b").alias("id_b"))
        title = F.struct("n", "s", "o", "y")
        texts = self.table.select("id", title.alias("t"))
        both = (
            found.distinct()
            .join(texts.select(F.col("id").alias("id_a"), F.col("t").alias("t_a")), "id_a")
            .join(texts.select(F.col("id").alias("id_b"), F.col("t").alias("t_b")), "id_b")
            .select(F.greatest("t_a", "t_b").alias("a"), F.least("t_a", "t_b").alias("b"))
            .selectExpr("a.s as s_a", "a.y as y_a", "b.s as s_b", "b.y as y_b", "a.n as n_a", "b.n as n_b")
        )
        close = both.where(f"levenshtein(s_a, s_b, {_max_edits('n_a', 'n_b', self.threshold)}) >= 0")
        scored = close.select("s_a", "y_a", "s_b", "y_b", similarity("s_a", "s_b").alias("score"))
        return scored.where(F.col("score") >= self.threshold)

    def first_in_blocks(self, leads):
        """Groups whose `lead` precedes that of every group they might be similar to.

        `leads` is (token_key, year, lead). Two similar groups share a block key, so a
        group that comes first under all its keys has no earlier similar group. Needs
        one row per key, never a pair. Returns (token_key, year).
        """
        ranked = self.table.join(
            leads.selectExpr("token_key as s", "coalesce(year, -1) as o", "lead"), ["s", "o"])
        keys = " , ".join(
            f"flatten(transform({blocks}, b -> transform({bands}, y -> xxhash64(b, y))))"
            for blocks, bands in ((self.index_blocks, self.index_bands), (self.probe_blocks, self.probe_bands))
        )
        keyed = self.spread(ranked).select("s", "y", "lead", F.expr(f"array_distinct(concat({keys}))").alias("keys"))
        group = F.struct("lead", "s", "y", F.size("keys").alias("keys"))
        first = keyed.select(F.explode("keys").alias("key"), group.alias("g")).groupBy("key").agg(F.min("g").alias("g"))
        won = first.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n = g.keys")
        return won.select(F.col("g.s").alias("token_key"), F.col("g.y").alias("year"))


def similar_titles(groups, threshold=S.FUZZY_THRESHOLD, hot_block=None):
    """All pairs of distinct (token_key, year) groups scoring at least `threshold`.

    Years may differ by one; an unknown year matches any. Each pair appears once, as
    (s_a, y_a, s_b, y_b, score). `groups` must hold every group once.
    """
    titles = Titles(groups, threshold, hot_block)
    return titles.pairs(grid=titles.crowded())
