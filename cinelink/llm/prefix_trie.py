"""Conversation prefix trie: union-find over the common prefixes of sorted neighbours.

A conversation is a sequence of records, one per turn: the digest of role and text and the
bytes of the text. Equal conversations become one sequence with a count. Sequences are
sorted across the cluster, so every node of the trie, a prefix, is an interval of them, and
the common prefix of two neighbours is an edge of that depth. Every task takes the edges of
its interval in descending depth: the edges of one depth unite components by union-find, a
merge of several is a branching node, and a component that nothing joins goes up through
nodes with one child. So every node knows its members, children, leaves and savings when it
is reached.

Prefixes of the first and of the last sequence of an interval may go on in the next one.
They stay open: the task's forest is contracted to these two sequences, with what hangs on
each of their prefixes as sums, and contracted forests of neighbouring intervals are merged
in the same way, `FAN` at a time, until one is left. Each level is a stored table; nodes
whose parent was open take its smallest member from a join.

Defined results: turns are in order of `turn`, null first, ties by the digest of role and
text; null role or text is the empty text; rows without conversation id belong to none; a
repeated row is another turn; an empty table has no nodes, not even a root; other columns
are not looked at. One conversation's records (24 bytes a turn) must fit into one row.
"""

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from cinelink.runtime import hot_keys, materialize, skew_join

RECORD = 24  # bytes a turn: 16 of the digest, 8 of the length of its text
FAN = 64
TASK_BYTES = 16 << 20
PIECE = 1 << 14  # ids in one piece of a list

NODE = "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
STATS = ("members", "least", "children", "leaves", "saved")
FOREST = f"part long, {NODE}, key binary, stats binary"
NONE = np.iinfo(np.int64).max
ROOT = b"\0" * 16


# --- sequences -----------------------------------------------------------------

def record(role, text):
    """48 hexadecimal digits that stand for a turn."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(told), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def sequences(rows, conv_id="conv_id", turn="turn", role="role", text="text"):
    """(conv_id, turns) of every conversation, `turns` an array of records in order."""
    rows = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), record(F.col(role), F.col(text)).alias("r")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["r"]).alias("turns"))


def spliced(convs, base, head):
    """Every conversation with its first `head` turns replaced by those of conversation `base` (Columns of conv_id)."""
    convs = materialize(convs, "conversations")
    asked = convs.select("conv_id", "turns", base.alias("base"), head.cast("int").alias("head"))
    first = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("first"))
    none = F.expr("cast(array() as array<string>)")
    return asked.join(first, "base", "left").select("conv_id", F.concat(
        F.coalesce(F.slice("first", 1, F.col("head")), none),
        F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.size("turns"))).otherwise(none)).alias("turns"))


def prefix_names(key):
    """Names of all prefixes of a sequence, the empty one first."""
    names = [ROOT]
    for a in range(0, len(key), RECORD):
        names.append(xxhash.xxh3_128_digest(names[-1] + key[a:a + RECORD]))
    return names


# --- one interval ----------------------------------------------------------------

def contract(keys, stats, final):
    """(closed, spines) of the sorted different sequences `keys` of one interval.

    `stats[i]` is {depth: (members, least, children, leaves, saved)}: what hangs on the prefixes
    of a sequence apart from the other sequences. `closed` are rows of NODE, `spines` pairs of a
    sequence and its stats; with `final` everything is closed.
    """
    n = len(keys)
    depth_of = [len(k) // RECORD for k in keys]
    shared, hung, names, parents = [0] * n, {}, {}, {}
    owner, path = [0], [ROOT]  # for each depth of the sequence at hand: who comes first with that prefix, and its name
    edges, starts = {}, {}
    for i, key in enumerate(keys):
        low = 0
        if i:
            before = keys[i - 1]
            most = min(len(before), len(key))
            a, b = np.frombuffer(before, np.uint8, most), np.frombuffer(key, np.uint8, most)
            differs = np.flatnonzero(a != b)
            low = int(differs[0] if len(differs) else most) // RECORD
            edges.setdefault(low, []).append(i)
        del owner[low + 1:], path[low + 1:]
        shared[i] = low
        for d in range(low + 1, depth_of[i] + 1):
            owner.append(i)
            path.append(xxhash.xxh3_128_digest(path[-1] + key[(d - 1) * RECORD:d * RECORD]))
            names[i, d] = path[-1]
            starts.setdefault(d, []).append(i)
        if depth_of[i] > low:
            parents[i] = path[low]
        for d, s in stats[i].items():
            old = hung.get((owner[d], d))
            hung[owner[d], d] = s if old is None else (
                old[0] + s[0], min(old[1], s[1]), old[2] + s[2], old[3] + s[3], old[4] + s[4])
    names[0, 0] = ROOT

    # Prefixes of the first and the last sequence go on outside.
    open_ = set()
    if not final:
        open_ = {(0, d) for d in range(depth_of[0] + 1)} | {(o, d) for d, o in enumerate(owner)}

    up = list(range(n))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    done, parent_of = {}, {}

    def finish(node):
        """A node all of whose children have been added."""
        members, least, children, leaves, saved = hung[node]
        if children == 0:
            leaves = 1
        if node[1]:
            a = node[1] * RECORD
            saved += (members - 1) * int.from_bytes(keys[node[0]][a - 8:a], "big")
        done[node] = (members, least, children, leaves, saved)

    for d in range(max(depth_of), 0, -1):
        for i in edges.get(d - 1, ()):
            a, b = top(i - 1), top(i)
            up[max(a, b)] = min(a, b)
        for i in starts.get(d, ()):
            node, parent = (i, d), (top(i), d - 1)
            if node in open_:
                hung.setdefault(node, (0, NONE, 0, 0, 0))
                hung.setdefault(parent, (0, NONE, 0, 0, 0))
                continue
            finish(node)
            parent_of[node] = parent
            members, least, _, leaves, saved = done[node]
            old = hung.get(parent, (0, NONE, 0, 0, 0))
            hung[parent] = (old[0] + members, min(old[1], least), old[2] + 1, old[3] + leaves, old[4] + saved)
    if final:
        finish((0, 0))

    closed = []
    for node, (members, least, children, leaves, saved) in done.items():
        parent = parent_of.get(node)
        above = None if parent is None else names[node[0], node[1] - 1] if node[1] - 1 > shared[node[0]] else parents[node[0]]
        closed.append((names[node], above, node[1], least, done[parent][1] if parent in done else None, members, children, leaves, saved))
    spines = []
    if not final:
        spines.append((keys[0], {d: hung[0, d] for d in range(depth_of[0] + 1) if (0, d) in hung}))
        if n > 1:
            # What both sequences share hangs on the first.
            spines.append((keys[-1], {d: hung[o, d] for d, o in enumerate(owner) if (o, d) in hung and not (o == 0 and d <= depth_of[0])}))
    return closed, spines


def pack(stats):
    return np.array([(d, *s) for d, s in sorted(stats.items())], np.int64).tobytes()


def unpack(raw):
    return {int(r[0]): tuple(int(x) for x in r[1:]) for r in np.frombuffer(raw, np.int64).reshape(-1, 1 + len(STATS))}


def _forest(part, closed, spines):
    """Rows of FOREST, in slices."""
    columns = [c.split()[0] for c in FOREST.split(", ")]
    for a in range(0, len(closed), 20_000):
        yield pd.DataFrame([(part, *c, None, None) for c in closed[a:a + 20_000]], columns=columns).astype({"parent_conv_id": "Int64"})
    if spines:
        rows = [(part, *[None] * 9, key, pack(stats)) for key, stats in spines]
        numbers = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        yield pd.DataFrame(rows, columns=columns).astype(dict.fromkeys(numbers, "Int64"))


# --- all intervals -----------------------------------------------------------------

def trie(convs, task_bytes=TASK_BYTES, fan=FAN):
    """NODE rows of all prefixes of `convs` (conv_id, turns)."""
    spark = convs.sparkSession
    different = convs.groupBy(F.unhex(F.array_join("turns", "")).alias("key")).agg(
        F.count("*").alias("members"), F.min("conv_id").alias("least"))
    different = materialize(different, "sequences")
    size = different.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    parts = max(1, min(-(-size // task_bytes) * 4, 4 * spark.sparkContext.defaultParallelism), -(-size // task_bytes))

    def first(batches):
        keys, stats = [], []
        for batch in batches:
            for key, members, least in zip(batch["key"], batch["members"], batch["least"]):
                keys.append(bytes(key))
                stats.append({len(key) // RECORD: (members, least, 0, 0, 0)})
        if keys:
            yield from _forest(TaskContext.get().partitionId(), *contract(keys, stats, parts == 1))

    level = materialize(different.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInPandas(first, FOREST), "forest")
    levels = [level]
    while parts > 1:
        parts = -(-parts // fan)
        level = materialize(_merge(level, parts == 1, fan), "forest")
        levels.append(level)
    nodes = levels[0].where("node is not null").select(*[c.split()[0] for c in NODE.split(", ")])
    if len(levels) == 1:
        return nodes
    upper = levels[1].where("node is not null")
    for level in levels[2:]:
        upper = upper.union(level.where("node is not null"))
    upper = materialize(upper.select(nodes.columns), "upper")
    # Parents that were open have been closed on a higher level. The root has many children there.
    names = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    everything = nodes.union(upper)
    asking = materialize(everything.where("parent is not null and parent_conv_id is null"), "asking")
    hot = hot_keys(asking, ["parent"], hot_rows=max(10_000, asking.count() // 1000))
    answered = skew_join(asking, names, ["parent"], "inner", hot, spread_by=["node"])
    return everything.where("parent is null or parent_conv_id is not null").union(
        answered.select(*[F.col("found" if c == "parent_conv_id" else c).alias(c) for c in nodes.columns]))


def _merge(level, final, fan):
    """One contracted forest out of each `fan` neighbouring ones."""
    def merge(rows):
        rows = rows.sort_values(["part", "key"])
        keys, stats = [], []
        for key, raw in zip(rows["key"], rows["stats"]):
            own = unpack(raw)
            if keys and keys[-1] == key:
                for d, s in own.items():
                    o = stats[-1].get(d, (0, NONE, 0, 0, 0))
                    stats[-1][d] = (o[0] + s[0], min(o[1], s[1]), o[2] + s[2], o[3] + s[3], o[4] + s[4])
            else:
                keys.append(key)
                stats.append(own)
        return pd.concat(list(_forest(int(rows["part"].iloc[0]) // fan, *contract(keys, stats, final))), ignore_index=True)

    return level.where("key is not null").select("part", "key", "stats").groupBy(
        F.floor(F.col("part") / fan)).applyInPandas(merge, FOREST)


# --- members that end in a node -----------------------------------------------------

def ends(convs, piece=PIECE):
    """(node, ends_sha256) of every prefix that is a whole conversation: a hash of its ids, ascending.

    Ids are sorted across the cluster and joined to pieces of at most `piece`, so the one
    task that hashes a node with very many members reads a few long rows.
    """
    @F.pandas_udf("binary")
    def node_of(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: prefix_names(bytes(k))[-1])

    def join(batches):
        node, held = None, []
        rows = []
        for batch in batches:
            for own, i in zip(batch["node"], batch["conv_id"]):
                if own != node or len(held) == piece:
                    if held:
                        rows.append((node, held[0], ",".join(map(str, held))))
                    node, held = own, []
                held.append(i)
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=["node", "first", "ids"])
                    rows = []
        if held:
            rows.append((node, held[0], ",".join(map(str, held))))
        yield pd.DataFrame(rows, columns=["node", "first", "ids"])

    def digest(batches):
        node, sha, rows = None, None, []
        for batch in batches:
            for own, ids in zip(batch["node"], batch["ids"]):
                if own == node:
                    sha.update(b",")
                else:
                    if sha is not None:
                        rows.append((node, sha.hexdigest()))
                    node, sha = own, hashlib.sha256()
                sha.update(ids.encode())
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=["node", "ends_sha256"])
                    rows = []
        if sha is not None:
            rows.append((node, sha.hexdigest()))
        yield pd.DataFrame(rows, columns=["node", "ends_sha256"])

    named = convs.select(node_of(F.unhex(F.array_join("turns", ""))).alias("node"), "conv_id")
    sorted_ = named.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = materialize(sorted_.mapInPandas(join, "node binary, first long, ids string"), "pieces")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInPandas(digest, "node binary, ends_sha256 string")


def nodes(convs, **options):
    """One row per prefix of `convs` (conv_id, turns): NODE and the hash of the ids that end there."""
    convs = materialize(convs, "convs")
    found = trie(convs, **options)
    return found.join(ends(convs), "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
