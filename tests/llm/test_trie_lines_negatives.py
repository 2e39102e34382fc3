"""Prefix trie, line dedup and hard negatives against brute force, with nulls, ties, repeats, long texts and empty tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinelink.llm import hard_negatives, line_dedup, prefix_trie, queries

# --- prefix trie -----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, key string, node string, part string, turns string"


def talk(seed, n=140):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        length = int(rng.integers(1, 9)) if c % 20 else 60
        for t in range(length):
            # Few different turns, so prefixes are shared; a third of all conversations open alike.
            said = "hello" if t == 0 and c % 3 == 0 else "é%d" % rng.integers(0, 2 if t < 6 else 1)
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", said, "clash", "clash", "clash", "clash"))
    more = [(c, t, r, x, None, None, None, None) for c, t, r, x in [
        (200, None, None, None), (200, 0, "user", None), (201, 0, "b", "same turn"), (201, 0, "a", "same turn"), (201, 0, "a", "same turn"),
        (202, 0, "", ""), (None, 0, "user", "nobody's"), (-7, 0, "user", "hello")]]
    return rows + more


def brute_trie(convs):
    """{prefix: values} from {conv_id: list of (role, text)}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}

    def walk(p):
        leaves, saved = (0 if children[p] else 1), (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        for q in children[p]:
            a, b = walk(q)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
        out[min(members[p]), len(p)] = (
            min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        return leaves, saved

    if convs:
        walk(())
    return out


def read(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            convs[c].append(((t is not None, t or 0, tie), (r, x)))
    return {c: [x for _, x in sorted(turns)] for c, turns in convs.items()}


def as_dict(nodes):
    got = [r.asDict() for r in nodes.drop("node", "parent").collect()]
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("options", [{}, {"task_bytes": 400, "fan": 2}, {"task_bytes": 3000, "fan": 3}])
def test_trie_is_brute_force(spark, options):
    rows = talk(1)
    convs = prefix_trie.sequences(spark.createDataFrame(rows, TURNS))
    assert as_dict(prefix_trie.nodes(convs, **options)) == brute_trie(read(rows))


def test_trie_of_spliced_conversations(spark):
    rows = talk(2)
    own, spliced = read(rows), {}
    for c in own:
        h = abs(c) % 4
        spliced[c] = own.get(c + 1, [])[:h] + own[c][h:]
    convs = prefix_trie.sequences(spark.createDataFrame(rows, TURNS))
    got = prefix_trie.nodes(prefix_trie.spliced(convs, F.col("conv_id") + 1, F.abs("conv_id") % 4), task_bytes=500, fan=2)
    assert [] in spliced.values() and as_dict(got) == brute_trie(spliced)


def test_trie_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.nodes(prefix_trie.sequences(empty)).count() == 0
    one = [(5, 0, "user", "x" * 100_000, None, None, None, None)]
    assert as_dict(prefix_trie.nodes(prefix_trie.sequences(spark.createDataFrame(one, TURNS)))) == brute_trie(read(one))


def test_contracted_forests_do_not_depend_on_the_cuts():
    rng = np.random.default_rng(3)
    turns = [bytes([i]) * 16 + (7 + i).to_bytes(8, "big") for i in range(3)]
    keys = sorted({b"".join(turns[i] for i in rng.integers(0, 3, rng.integers(0, 7))) for _ in range(150)})
    stats = [{len(k) // 24: (i + 1, i, 0, 0, 0)} for i, k in enumerate(keys)]
    whole = {c[0]: c for c in prefix_trie.contract(keys, stats, True)[0]}
    for cuts in ([0, 1, len(keys)], [0, 30, 31, 60, len(keys)]):
        closed, spines = [], []
        for a, b in zip(cuts, cuts[1:]):
            c, s = prefix_trie.contract(keys[a:b], stats[a:b], False)
            closed += c
            spines += [(k, prefix_trie.unpack(prefix_trie.pack(x))) for k, x in s]
        last, none = prefix_trie.contract([k for k, _ in spines], [s for _, s in spines], True)
        assert not none
        merged = {c[0]: c for c in closed + last}
        assert len(merged) == len(closed) + len(last) and merged.keys() == whole.keys()
        for name, c in merged.items():
            assert c[:4] == whole[name][:4] and c[5:] == whole[name][5:]
            assert c[4] in (None, whole[name][4])


# --- line dedup --------------------------------------------------------------------

DOCS = "doc_id long, text string, spans string, digest string, key string, line string"


def texts(n=60):
    rng = np.random.default_rng(4)
    often = ["This line of boilerplate stands in many documents, number %d." % i for i in range(6)]
    accents = "Été à la plage : une ligne répétée avec des accents é"
    rows = []
    for i in range(n):
        lines = ["own line %d of document %d, which nothing repeats anywhere" % (j, i) for j in range(int(rng.integers(0, 4)))]
        lines += list(rng.choice(often, int(rng.integers(0, 4))))
        if i % 3 == 0:
            lines += ["  \t" + accents.upper() + "  ", "", "short", accents]
        if i % 7 == 0:
            lines += ["x" * 39, "y" * 40, "\v" + "y" * 40 + "\f", "z" * 40 + " "]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join([often[0]] * 3)), (104, "word " * 50_000 + "\n" + often[1] + "\n"),
             rows[3], (3, often[2] + "\n" + often[2]), (None, often[0]), (None, often[3] + "\r")]
    return [(i, t, "clash", "clash", "clash", "clash") for i, t in rows]


def brute_lines(rows, least=40, docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\v\f\r").translate(lower)

    holders = defaultdict(list)
    for i, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least:
                holders[k].append(i)
    keeper = {k: max(h, key=lambda i: -1 if i is None else i) for k, h in holders.items() if len(h) >= docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"most_bits": 1 << 15, "share": 16}])
def test_line_dedup_is_brute_force(spark, options):
    rows = texts()
    got = Counter(tuple(r) for r in line_dedup.drop_lines(spark.createDataFrame(rows, DOCS), **options).collect())
    assert got == brute_lines(rows) and sum(n for _, _, n, _ in got) > 50


def test_line_dedup_with_a_full_filter_and_no_repeats(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame(rows, DOCS)
    # All bits set: every line is suspected, the result stays.
    monkeypatch.setattr(line_dedup, "twice_filter", lambda hashes, most_bits: (b"\xff" * 64, 512))
    assert Counter(tuple(r) for r in line_dedup.drop_lines(docs).collect()) == brute_lines(rows)
    monkeypatch.undo()
    assert Counter(tuple(r) for r in line_dedup.drop_lines(docs, min_docs=1000).collect()) == brute_lines(rows, docs=1000)


def test_suspects_are_repeated_lines_and_few_others(spark):
    rows = [(i, "\n".join("line %d of document %d that is found only in it" % (j, i) for j in range(40)) + "\n" + "twice %020d and nothing else" % (i // 2))
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = line_dedup.seen_twice(docs, "text").distinct()
    assert 100 <= hashes.count() <= 200
    table, bits = line_dedup.twice_filter(hashes)
    found = line_dedup.suspects(docs, "doc_id", "text", table, bits)
    assert 200 <= found.count() <= 400


def test_removed_lines_keep_the_columns(spark):
    docs = spark.createDataFrame(texts(), DOCS)
    out = line_dedup.remove_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count() and out.where("spans = 'clash'").count() == docs.count()
    empty = line_dedup.drop_lines(docs.limit(0))
    assert empty.count() == 0


# --- hard negatives -------------------------------------------------------------------

VECTORS = "vec_id long, label int, vector array<long>, anchor string, key string, score string"


def vectors(n=400, seed=6):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-40, 40, (8, 12))
    rows = []
    for i in range(n):
        v = centres[rng.integers(0, 8)] + rng.integers(-12, 13, 12)
        rows.append((i, int(rng.integers(0, 4)), [int(x) for x in v]))
    hot = [int(x) for x in centres[0]]
    rows += [(n + i, i % 3, hot) for i in range(150)]  # one very common vector
    rows += [(0, *rows[0][1:]), (0, 1, rows[5][2]), (7, *rows[7][1:]), (900, 2, [3, 4]), (901, 2, []), (902, 9, [1] * 12), (1000, 9, [2] * 12)]
    rows += [(None, 1, [1] * 12), (903, None, [1] * 12), (904, 1, None), (905, 1, [1, None])]
    return [(*r, "clash", "clash", "clash") for r in rows]


def brute_negatives(rows, asks, positives, negatives):
    rows = [r[:3] for r in rows if None not in r[:3] and None not in r[2]]

    def product(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for at in {(i, k, tuple(v)): n for n, (i, k, v) in enumerate(rows) if asks(i)}.values():
        i, k, v = rows[at]
        own = sorted((-product(v, w), j) for n, (j, m, w) in enumerate(rows) if m == k and n != at)[:positives]
        for s, j in own:
            found = sorted((-product(v, w), b) for b, m, w in rows if m != k and 30 * -s <= 100 * product(v, w) <= 90 * -s)
            out += [(i, j, r + 1, b, -s, -t) for r, (t, b) in enumerate(found[:negatives])]
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "packet": 7, "leaf": 4, "fanout": 3}, {"positives": 2, "negatives": 30, "leaf": 8}])
def test_hard_negatives_are_brute_force(spark, options):
    rows = vectors()
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, **options)
    expected = brute_negatives(rows, lambda i: i % 10 == 0, options.get("positives", 5), options.get("negatives", 10))
    assert Counter(tuple(r) for r in got.collect()) == expected and len(expected) > 500


def test_hard_negatives_of_nothing(spark):
    rows = spark.createDataFrame(vectors(), VECTORS)
    assert hard_negatives.mine(rows.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(rows, F.lit(False)).count() == 0


def test_tree_covers_its_points_and_skips_most_leaves():
    rng = np.random.default_rng(8)
    x = np.repeat(rng.integers(-200, 200, (40, 16)), 50, axis=0) + rng.integers(-3, 4, (2000, 16))
    order, nodes = hard_negatives.build(x, leaf=32)
    assert sorted(order.tolist()) == list(range(2000))
    squares = (x.astype(float) ** 2).sum(axis=1)
    extra = np.sqrt(squares.max() - squares)
    for centre, a, b, parent, level, leaf, radius in nodes:
        rows = order[a:b]
        apart = np.sqrt(((x[rows] - x[centre]).astype(float) ** 2).sum(axis=1) + (extra[rows] - extra[centre]) ** 2)
        assert apart.max() <= radius + 1e-9 and centre in rows
        assert parent == -1 or (nodes[parent][1] <= a and b <= nodes[parent][2] and nodes[parent][4] == level - 1)


def test_large_components_stay_exact():
    x = np.array([[2**30, 1], [2**30, 2], [1, 1], [2**30 + 1, 0]])
    order, nodes = hard_negatives.build(x, leaf=1, fanout=2)
    place = np.empty(4, np.int64)
    place[order] = np.arange(4)
    table = np.array([tuple(n) for n in nodes], hard_negatives.NODE_TYPE)
    table["centre"] = place[table["centre"]]
    block = {"ids": order, "labels": np.zeros(4, np.int64), "x": x[order], "keys": order, "nodes": table}
    q = {"x": np.array([[2**25, 1]]), "labels": np.array([0]), "keys": np.array([-1])}
    open_ = [np.full((1, 1), v, np.int64) for v in (-hard_negatives.ALL, hard_negatives.ALL)]
    got = hard_negatives.search(block, q, open_, True, 4)
    assert [(int(s), int(order[r])) for _, _, s, r in got] == [(2**55 + 2**25, 3), (2**55 + 2, 1), (2**55 + 1, 0), (2**25 + 1, 2)]


def test_query_takes_no_bad_vectors(spark, tmp_path):
    rows = [(i, i % 2, [0.5, float(i)]) for i in range(0, 300, 25)] + [(1, None, [1.0]), (2, 1, None), (3, 1, [None, 1.0]), (4, 0, [float("nan"), 1.0]), (5, 0, [float("inf"), 1.0])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_cover_tree(spark, str(tmp_path)).collect()
    assert got and {r["anchor_id"] for r in got} <= {0, 100, 200} and not {r["negative_id"] for r in got} & {1, 2, 3, 4, 5}
