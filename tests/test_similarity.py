"""Blocking must not miss a pair, whatever the threshold."""

import random

import pytest

from cinelink.operators.similarity import Titles, similar_titles
from statement import lcs


def edited(rnd, s):
    s = list(s)
    for _ in range(rnd.randint(1, 4)):
        at = rnd.randrange(len(s) + 1)
        if rnd.random() < 0.5 and at < len(s):
            s.pop(at)
        else:
            s.insert(at, rnd.choice("abc é"))
    return "".join(s)


@pytest.mark.parametrize("threshold", [85.0, 60.0, 92.5, 100.0])
def test_blocking_equals_brute_force(spark, threshold):
    rnd = random.Random(threshold)
    words = set()
    for _ in range(100):
        w = "".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 26)))
        words |= {w, edited(rnd, w), edited(rnd, w)}
    words = sorted(words - {""})
    groups = {(w, rnd.choice([None, 1990, 1991, 1992, 1993])) for w in words}
    groups = sorted(groups | {(w, y) for w in words[:30] for y in (2000, 2001)}, key=str)
    df = spark.createDataFrame(groups, "token_key string, year int")
    got = {((r.s_a, r.y_a), (r.s_b, r.y_b)): r.score for r in similar_titles(df, threshold).collect()}
    expected = {}
    for a, ya in groups:
        for b, yb in groups:
            rank = lambda w, y: (len(w), w.encode(), -1 if y is None else y)
            if rank(a, ya) <= rank(b, yb) or (ya is not None and yb is not None and abs(ya - yb) > 1):
                continue
            score = (1 - (len(a) + len(b) - 2 * lcs(a, b)) / (len(a) + len(b))) * 100
            if score >= threshold:
                expected[((a, ya), (b, yb))] = score
    assert got == expected


def test_neither_side_of_the_block_join_is_broadcast(spark):
    titles = Titles(spark.createDataFrame([("abc", 2000), ("abd", 2000)], "token_key string, year int"), 85.0)
    plan = titles.candidates()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("threshold", [85.0, 70.0, 95.0])
def test_keys_grow_with_the_length_of_a_title(spark, threshold):
    rnd = random.Random(7)
    groups = [("".join(rnd.choice("abcdefghij ") for _ in range(n - 1)) + "x", 2000) for n in (25, 100, 500, 2000)]
    titles = Titles(spark.createDataFrame(groups, "token_key string, year int"), threshold)
    for r in titles.keys.groupBy("n", "role").count().collect():
        assert r["count"] <= 8 * r.n, r
    assert "s" not in titles.keys.columns


@pytest.mark.parametrize("hot_block", [2, None])
def test_split_blocks_give_the_same_pairs(spark, hot_block):
    rnd = random.Random(11)
    base = ["the long night of the harvest moon", "return to the long night", "moon over the harvest"]
    groups = {(edited(rnd, rnd.choice(base)), rnd.choice([None, 1990, 1991, 1995])) for _ in range(60)}
    df = spark.createDataFrame(sorted(groups, key=str), "token_key string, year int")
    got = {tuple(r)[:4] for r in similar_titles(df, 85.0, hot_block).collect()}
    expected = set()
    for a, ya in groups:
        for b, yb in groups:
            rank = lambda w, y: (len(w), w.encode(), -1 if y is None else y)
            if rank(a, ya) > rank(b, yb) and (ya is None or yb is None or abs(ya - yb) <= 1):
                if 2 * lcs(a, b) >= 0.85 * (len(a) + len(b)):
                    expected.add((a, ya, b, yb))
    assert got == expected
