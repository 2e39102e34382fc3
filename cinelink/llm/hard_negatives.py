"""Hard-negative mining: a cover tree over norm-augmented candidates.

Vectors hold whole numbers and are compared by inner product. A candidate x is augmented by
one coordinate, the root of M^2 - |x|^2 with M the largest norm of its block, and a query q
by a zero. Then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so a large inner product is a small
distance, and the triangle inequality bounds the inner products of everything within a
covering radius of a centre from both sides.

Candidates are dealt into blocks by hash; every block has a cover tree of its own, built
once and stored. A node's children are its farthest points, each at least as far from the
others as anything is left from its nearest one, and their covering radii are measured.
Anchors come in packets, and a cell is a block and a packet. A cell goes down level by level
and leaves out, for each anchor, nodes that lie outside all of its windows; the leaves that
are left are opened in order of their best bound, skipped for anchors that have enough
better rows, and what is in them is compared exactly.

First every anchor finds its positives, the best rows of its own label; they make its
windows, in which the best rows of other labels are found in the same way, and cells' results
are merged by anchor and window.

Defined results: rows with a null id, label or vector, or a null component take no part; a
short vector is continued by zeros; anchors equal in id, label and vector count once,
repeated rows are candidates of their own, but no row of the anchor's own id, label and
vector is its positive more often than it is repeated besides itself; ties go to the smaller
id; an empty table gives no rows; other columns are not looked at. A hundred times
any inner product must fit into a long.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinelink.runtime import materialize

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK_ROWS = 32768
PACKET = 4096
LEAF = 64
FANOUT = 16
AT_ONCE = 1 << 20  # inner products computed in one step
EXACT = 2.0 ** 53
ALL = np.iinfo(np.int64).max


# --- the tree ----------------------------------------------------------------------

def build(vectors, leaf=LEAF, fanout=FANOUT):
    """(order, nodes): rows in leaf order; per node centre, from, to, parent, level, whether it is a leaf, and the radius."""
    x = vectors.astype(np.float64)
    squares = np.einsum("ij,ij->i", x, x)
    extra = np.sqrt(np.maximum(squares.max() - squares, 0))

    def distance(rows, centre):
        # Differences instead of products: equal points are at distance 0.
        d = x[rows] - x[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d) + (extra[rows] - extra[centre]) ** 2)

    order, nodes, work = [], [], [(np.arange(len(x)), int(np.argmax(squares)), -1, 0)]
    at = 0
    while work:
        rows, centre, parent, level = work.pop()
        near = distance(rows, centre)
        me, radius = len(nodes), float(near.max())
        small = len(rows) <= leaf or radius == 0
        # Depth first, so a node's rows are neighbours in the order.
        nodes.append([centre, at, at + len(rows), parent, level, small, radius])
        if small:
            order.append(rows)
            at += len(rows)
            continue
        mine, centres = np.zeros(len(rows), np.int64), [centre]
        while len(centres) < fanout and near.max() > 0:
            far = int(rows[int(np.argmax(near))])
            d = distance(rows, far)
            mine[d < near] = len(centres)
            near = np.minimum(near, d)
            centres.append(far)
        for k, c in enumerate(centres):
            work.append((rows[mine == k], c, me, level + 1))
    return np.concatenate(order), nodes


def search(block, anchors, windows, same, k):
    """(anchor, window, score, row) of the best `k` rows of a block inside each window.

    `windows` holds (low, high) of every anchor, both inclusive and scaled by 100, as arrays
    (anchors, windows); empty ones have low > high. `same`: rows of the anchor's label, else the others.
    """
    ids, labels, x, nodes = block["ids"], block["labels"], block["x"], block["nodes"]
    q, q_labels, q_keys = anchors["x"], anchors["labels"], anchors["keys"]
    width = max(x.shape[1], q.shape[1])
    x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
    largest = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < EXACT else np.int64
    x, q = x.astype(kind), q.astype(kind)
    n_anchors, n_windows = windows[0].shape
    low, high = (w.astype(np.float64) / 100 for w in windows)
    wanted = windows[0] <= windows[1]
    floor = np.where(wanted, low, np.inf).min(axis=1, initial=np.inf)
    ceiling = np.where(wanted, high, -np.inf).max(axis=1, initial=-np.inf)

    # Bounds on all inner products below every node, level by level.
    squares = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    most = squares.max()
    q_squares = np.einsum("ij,ij->i", q.astype(np.float64), q.astype(np.float64))
    total = q_squares[:, None] + most
    slack = 1e-9 * total + 1e-6
    alive, upper = np.zeros((n_anchors, len(nodes)), bool), np.empty((n_anchors, len(nodes)))
    centre = nodes["centre"]
    for level in range(int(nodes["level"].max()) + 1):
        here = np.flatnonzero(nodes["level"] == level)
        for a in range(0, len(here), max(1, AT_ONCE // max(n_anchors, 1))):
            part = here[a:a + max(1, AT_ONCE // max(n_anchors, 1))]
            product = (q @ x[centre[part]].T).astype(np.float64)
            apart = np.sqrt(np.maximum(total - 2 * product, 0))
            radius = nodes["radius"][part]
            nearest, farthest = np.maximum(apart - radius, 0), apart + radius
            best = (total - nearest ** 2) / 2 + slack
            worst = (total - farthest ** 2) / 2 - slack
            upper[:, part] = best
            inside = (best >= floor[:, None]) & (worst <= ceiling[:, None])
            alive[:, part] = inside & (True if level == 0 else alive[:, nodes["parent"][part]])

    leaves = np.flatnonzero(nodes["leaf"])
    leaves = leaves[alive[:, leaves].any(axis=0)]
    reach = np.where(alive[:, leaves], np.minimum(upper[:, leaves], ceiling[:, None]), -np.inf)
    leaves = leaves[np.argsort(-reach.max(axis=0), kind="stable")]
    # Below this score a row can't be among the best of a window any more.
    enough = np.where(wanted, low, np.inf)
    held, waiting = [], 0

    def settle():
        """The best k per anchor and window of what is held."""
        nonlocal held, waiting
        if not held:
            return np.empty((0, 4), np.int64)
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows[:, 3], ids[rows[:, 3]], -rows[:, 2], rows[:, 1], rows[:, 0]))]
        group = rows[:, 0] * n_windows + rows[:, 1]
        first = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
        rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
        rows = rows[rank < k]
        last = rows[(rank[rank < k] == k - 1)]
        enough[last[:, 0], last[:, 1]] = np.maximum(enough[last[:, 0], last[:, 1]], last[:, 2])
        held, waiting = [rows], 0
        return rows

    for leaf in leaves:
        a, b = nodes["from"][leaf], nodes["to"][leaf]
        active = np.flatnonzero(alive[:, leaf] & (upper[:, leaf] >= enough.min(axis=1)))
        step = max(1, AT_ONCE // max(b - a, 1))
        for cut in range(0, len(active), step):
            who = active[cut:cut + step]
            scores = np.rint(q[who] @ x[a:b].T).astype(np.int64) if kind is np.float64 else q[who] @ x[a:b].T
            fits = (labels[a:b][None, :] == q_labels[who][:, None]) == same
            if same:
                fits &= block["keys"][a:b][None, :] != q_keys[who][:, None]
            for w in range(n_windows):
                ok = fits & wanted[who, w][:, None] & (scores >= enough[who, w][:, None])
                # Exact, in whole numbers; open windows have no limits.
                lo, hi = windows[0][who, w][:, None], windows[1][who, w][:, None]
                ok &= (lo == -ALL) | (100 * scores >= lo)
                ok &= (hi == ALL) | (100 * scores <= hi)
                i, j = np.nonzero(ok)
                if len(i):
                    held.append(np.stack([who[i], np.full(len(i), w), scores[i, j], a + j], axis=1))
                    waiting += len(i)
        if waiting > 20_000:
            settle()
    return settle()


# --- distribution --------------------------------------------------------------------

def matrix(values):
    width = max((len(v) for v in values), default=0)
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _narrow(x):
    """The smallest whole-number type that holds the matrix."""
    most = np.abs(x).max(initial=0)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def _packed(rows, **more):
    x = _narrow(matrix(rows["vector"].tolist()))
    return {"n": len(rows), "width": x.shape[1], "kind": x.dtype.str, "x": x.tobytes(),
            "ids": rows["id"].to_numpy(np.int64).tobytes(), "labels": rows["label"].to_numpy(np.int64).tobytes(),
            "keys": rows["key"].to_numpy(np.int64).tobytes(), **more}


def _unpacked(row):
    numbers = {c: np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "keys")}
    return numbers | {"x": np.frombuffer(row["x"], np.dtype(row["kind"])).reshape(row["n"], row["width"]).astype(np.int64)}


PACKED = "n long, width long, kind string, x binary, ids binary, labels binary, keys binary"
NODE_TYPE = np.dtype([("centre", "i8"), ("from", "i8"), ("to", "i8"), ("parent", "i8"), ("level", "i8"), ("leaf", "?"), ("radius", "f8")])


def _blocks(rows, block_rows, leaf, fanout):
    """One row per block of candidates: its rows in leaf order and its tree."""
    spark = rows.sparkSession
    n = rows.count()
    blocks = max(1, -(-n // block_rows), min(spark.sparkContext.defaultParallelism, -(-n // (8 * leaf))))

    def index(key, part):
        order, nodes = build(matrix(part["vector"].tolist()), leaf, fanout)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table = np.array([tuple(r) for r in nodes], NODE_TYPE)
        table["centre"] = place[table["centre"]]
        return pd.DataFrame([_packed(part.iloc[order], block=key[0], nodes=table.tobytes())])[[c.split()[0] for c in schema.split(", ")]]

    schema = f"block long, {PACKED}, nodes binary"
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "key", "nr"), F.lit(blocks)))
    return materialize(dealt.groupBy("block").applyInPandas(index, schema), "trees"), blocks


def _cells(trees, blocks, asking, packet, same, k):
    """(anchor, slot, score, id) of the best k rows of every block for every anchor and window of `asking`.

    `asking`: anchor (a number), id, key, label, vector and lows, highs, the windows' limits.
    """
    n = asking.count()
    packets = max(1, -(-n // packet))

    def pack(key, rows):
        width = max(len(w) for w in rows["lows"])
        low, high = (np.full((len(rows), width), v, np.int64) for v in (1, 0))
        for i, (a, b) in enumerate(zip(rows["lows"], rows["highs"])):
            low[i, :len(a)], high[i, :len(b)] = a, b
        return pd.DataFrame([_packed(
            rows, packet=key[0], anchors=rows["anchor"].to_numpy(np.int64).tobytes(), lows=low.tobytes(), highs=high.tobytes(),
        )])[[c.split()[0] for c in schema.split(", ")]]

    schema = f"packet long, {PACKED}, anchors binary, lows binary, highs binary"
    packed = materialize(asking.withColumn("packet", F.pmod(F.xxhash64("anchor"), F.lit(packets))).groupBy("packet").applyInPandas(
        pack, schema), "packets")
    # A cell for every block and packet: anchors are asked of all rows.
    left = trees.withColumn("packet", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(packets - 1).cast("long"))))
    right = packed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def cell(tree, ask):
        columns = ["anchor", "slot", "score", "id"]
        if not len(tree) or not len(ask):
            return pd.DataFrame(columns=columns, dtype="int64")
        tree, ask = tree.iloc[0], ask.iloc[0]
        block = _unpacked(tree) | {"nodes": np.frombuffer(tree["nodes"], NODE_TYPE)}
        anchors = _unpacked(ask)
        windows = [np.frombuffer(ask[c], np.int64).reshape(ask["n"], -1) for c in ("lows", "highs")]
        found = search(block, anchors, windows, same, k)
        names = np.frombuffer(ask["anchors"], np.int64)
        return pd.DataFrame({"anchor": names[found[:, 0]], "slot": found[:, 1], "score": found[:, 2], "id": block["ids"][found[:, 3]]})

    found = left.groupBy("block", "packet").cogroup(right.groupBy("block", "packet")).applyInPandas(
        cell, "anchor long, slot long, score long, id long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows, is_anchor, vec_id="vec_id", label="label", vector="vector", positives=POSITIVES, negatives=NEGATIVES,
         low=LOW, high=HIGH, block_rows=BLOCK_ROWS, packet=PACKET, leaf=LEAF, fanout=FANOUT):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vector` holds arrays of long, `is_anchor` is a Column. A negative's score lies between
    `low` and `high` percent of the positive's.
    """
    whole = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda v: v.isNull())
    rows = rows.where(whole).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    # Equal rows have equal keys; a row's number only deals repeated rows to different blocks.
    rows = rows.withColumn("key", F.xxhash64("id", "label", "vector")).withColumn("nr", F.monotonically_increasing_id())
    rows = materialize(rows, "vectors")
    trees, blocks = _blocks(rows.drop("asks"), block_rows, leaf, fanout)
    anchors = rows.where("asks").groupBy("id", "label", "vector", "key").agg(F.min("nr").alias("anchor"), F.count("*").alias("copies"))
    anchors = materialize(anchors, "anchors")
    everything = anchors.withColumns({"lows": F.array(F.lit(-ALL)), "highs": F.array(F.lit(ALL))})
    best = _cells(trees, blocks, everything.drop("copies"), packet, True, positives)
    # A repeated row is a positive of its copy: as often as it is there besides the anchor.
    twins = anchors.where("copies > 1").select("anchor", F.lit(0).cast("long").alias("slot"), F.aggregate(
        "vector", F.lit(0).cast("long"), lambda a, x: a + x * x).alias("score"), "id",
        F.explode(F.sequence(F.lit(2), F.least("copies", F.lit(positives + 1).cast("long")).cast("int"))).alias("rank"))
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "rank")
    best = best.union(twins).withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    best = materialize(best.select("anchor", (F.col("place") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), "positives")
    told = best.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda s: s["positive_score"]).alias("s"))
    asking = anchors.drop("copies").join(told, "anchor").select(
        *[c for c in anchors.columns if c != "copies"], F.transform("s", lambda s: s * low).alias("lows"), F.transform("s", lambda s: s * high).alias("highs"))
    found = _cells(trees, blocks, materialize(asking, "asking"), packet, False, negatives)
    names = anchors.select("anchor", F.col("id").alias("anchor_id"))
    return found.join(best, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
