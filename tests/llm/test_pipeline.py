"""The whole pipeline over a small table, every stage against brute force on what the stage before it kept."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cinelink.llm import mixing, quality_rules

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def tables():
    rng = np.random.default_rng(11)
    vocabulary = ["word%d" % i for i in range(900)] + ["Été", "日本", "ß"]

    def text(n):
        return " ".join(rng.choice(vocabulary, n))

    bench = [text(40), text(9), None]
    rows = [(i, text(int(rng.integers(60, 200))), "en", ["a", "b", None][i % 3], None) for i in range(40)]
    base = rows[3][1].split()
    near = [*base[:20], "changed", *base[21:]]
    rows += [(50, " ".join(near), "en", "a", None), (51, rows[3][1], "fr", "b", None), (52, rows[7][1].upper(), "en", "b", None)]
    # Ids that stand on several rows, repeated rows, null ids and texts.
    twin = text(80)
    rows += [(60, twin, "en", "a", None), (61, twin, "en", "a", None), (61, text(90), "en", "a", None), (62, text(70), "en", "b", 5), (62, rows[0][1], "en", "b", 5)]
    rows += [rows[5], (None, text(60), None, None, None), (70, None, "en", "a", None), (71, "", "en", "a", None), (72, text(30), "en", "a", None)]
    rows += [(73, "again and " * 60, "en", "a", None), (80, f"{text(60)} {bench[0].upper()} {text(30)}", "en", "b", None), (81, f"{text(200)} {bench[1]} {text(150)}", "en", "b", None)]
    # Template pages of one host: all alike but for a few words.
    lines = [text(25) for _ in range(3)]
    rows += [(100 + i, "\n".join([lines[0], text(3), lines[1], lines[2]]), "en", "host", None) for i in range(25)]
    rows += [(200, "x " * 20 + "\n" + text(4000), "en", "long", None)]
    return rows, [(i, t) for i, t in enumerate(bench)]


def good(rows):
    """Quality rules by their definition."""
    def lines(text):
        found = [x for x in (text or "").split("\n") if WORD.search(x)]
        return [re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ") for x in found]

    holders = defaultdict(set)
    for _, t, _, host, _ in rows:
        for line in set(lines(t)):
            holders[host, line].add(t or "")
    out = []
    for r in rows:
        words = WORD.findall(r[1] or "")
        grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        repeated = {p for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for p in range(i, i + 3)}
        all_ = lines(r[1])
        lost = sum(len(x) for x in all_ if len(holders[r[3], x]) > quality_rules.MAX_DOCUMENTS)
        total = sum(map(len, all_))
        poor = 100 * (total - lost) < quality_rules.MIN_LEFT * total
        if len(words) >= 50 and 100 * len(repeated) <= 50 * len(words) and not poor:
            out.append(r)
    return out


def one_of_each(rows):
    """The row of every component with the smallest id, of those the smallest digest."""
    def shingles(text):
        w = WORD.findall(lower(text))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, up = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        return i if up[i] == i else top(up[i])

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[top(i)].append(r)
    return [min(g, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())) for g in groups.values()]


def clean(rows, bench):
    windows = set()
    for _, t in bench:
        w = LETTERS.findall(lower(t))
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    out = []
    for r in rows:
        w = LETTERS.findall(lower(r[1]))
        hit = {p for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for p in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def mixed(rows):
    """Copies of every row: the Poisson distribution with the source's rate, inverted at the row's number."""
    chars = Counter()
    for r in rows:
        chars[r[3]] += len(r[1] or "")
    out = Counter()
    for r in rows:
        rate = sum(chars.values()) / len(chars) / chars[r[3]]
        u = int(hashlib.md5(f"{mixing.SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, p = 0, math.exp(-rate)
        total = p
        while u >= total:
            n += 1
            p *= rate / n
            total += p
        out[r] += n
    return +out


@pytest.mark.parametrize("empty", [False, True])
def test_run_is_brute_force(spark, tmp_path, empty):
    rows, bench = tables()
    rows = [] if empty else rows
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expected, sizes = list(rows), [len(rows)]
    steps = [good, one_of_each, lambda r: clean(r, bench)]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        out = stage(spark, docs, str(tmp_path))
        expected = step(expected)
        assert out.columns == docs.columns, name
        assert Counter(tuple(r) for r in out.collect()) == Counter(expected), name
        sizes.append(len(expected))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert empty or all(a > b for a, b in zip(sizes, sizes[1:]))
    final = [r.asDict() for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    copies = mixed(expected)
    assert Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in final) == copies
    slots = defaultdict(list)
    for r in final:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots.get(i, [])) for i in range(corpus_pipeline.SHARDS)]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
