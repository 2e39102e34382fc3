"""Edge cases and brute-force comparisons of the training-data operators."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from cinelink.llm import (
    chat_format, decontaminate, extract_html, induction, katz, mixing, near_dup, quality_rules, shard_ring, suffix_dedup, url_filter,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, key string, row string, words string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sample():
    rng = np.random.default_rng(5)
    vocabulary = ["w%d" % i for i in range(60)] + ["É", "ß", "日本"]

    def text(n):
        return " ".join(rng.choice(vocabulary, n)) if n else ""

    long = text(4000)
    base = text(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "one two", "one two", "ONE two", base, base, " ".join(near), long, long[:9000], "a" * 900, text(70), "x\nx\n" + text(60), text(55)]
    rows = [(i, t, "en", "s" if i % 3 else None, None, "clash", "clash", "clash", None) for i, t in enumerate(texts)]
    return [*rows, (None, text(20), None, None, None, None, None, None, None), rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(0)
    for i in range(60):
        t = rng.integers(1, int(rng.integers(2, 8)), int(rng.integers(1, 90)))
        t = np.r_[np.tile(t[:max(1, len(t) // 9)], 9) if i % 4 == 0 else t, 0].astype(np.int64)
        order = sorted(range(len(t)), key=lambda p: t[p:].tolist())
        assert induction.sort_suffixes(t, memory=100).tolist() == order
        got, shared = induction.suffixes_with_prefixes(t, memory=100)
        assert got.tolist() == order
        for a, b, n in zip(order, order[1:], shared[1:]):
            assert (t[a:a + n] == t[b:b + n]).all() and t[a + n] != t[b + n]


@pytest.mark.parametrize("split", [1, 1000])
def test_suffix_dedup_is_brute_force(docs, split):
    length = 40
    rows = suffix_dedup.remove_repeats(docs, keep=("doc_id", "text"), length=length, gram=8, split=split, shard_bytes=4000).collect()
    raws = [(r["text"] or "").encode() for r in rows]
    seen = Counter(x[i:i + length] for x in raws for i in range(len(x) - length + 1))
    for r, x in zip(rows, raws):
        marks = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                marks[i:i + length] = b"\1" * length
        assert bytes(r["kept"]) == bytes(c for c, m in zip(x, marks) if not m)
        assert [(s["a"], s["b"]) for s in r["spans"]] == [m.span() for m in re.finditer(b"\1+", bytes(marks))]


@pytest.mark.parametrize("length", [300, 511, 512, 600, 1100])
def test_repeats_longer_than_the_default_cap(length):
    rng = np.random.default_rng(length)
    same, *others = (bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (1300, 40, 50, 60, 70))
    contexts = [others[0] + same + others[1], others[2] + same + others[3]]
    counts = [len(c) - length + 1 for c in contexts]
    hits, _ = suffix_dedup.repeats_in_shard(contexts, counts, [1, 1], length)
    seen = Counter(c[i:i + length] for c, n in zip(contexts, counts) for i in range(n))
    for c, n, h in zip(contexts, counts, hits):
        assert h.tolist() == [seen[c[i:i + length]] > 1 for i in range(n)]
    assert sum(h.sum() for h in hits) >= 2 * (1300 - length + 1)


def test_near_dup_is_brute_force(docs):
    got = near_dup.link(docs).collect()
    by_id = defaultdict(set)
    for r in sample():
        w = WORDS.findall(lower(r[1]))
        by_id[r[0]] |= {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(by_id, key=lambda i: -1 if i is None else i)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = by_id[a], by_id[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((top(a), top(b)), key=ids.index)
                up[q] = p
    assert len(got) == len(sample())
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(by_id[r["id"]]), top(r["id"]), top(r["id"]) == r["id"])
    assert near_dup.keep_first(docs).columns == docs.columns


def test_columns_of_the_same_name_as_added_ones(spark):
    rows = [(i, f"text {i}", "s", 7, 8, 9, 10, 11) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_copies int, Copy_No int, shuffle_key int, shard int, slot int")
    mixed = mixing.replicate(docs)
    assert mixed.columns == [*docs.columns, "n_copies_2", "copy_no_2", "shuffle_key_2"]
    assert mixed.select(*docs.columns).distinct().exceptAll(docs).count() == 0
    placed = shard_ring.assign(docs, F.col("doc_id"), [], 4)
    assert placed.columns == [*docs.columns, "shard_2", "slot_2"]
    assert sorted(r["count"] for r in placed.groupBy("shard_2").count().collect()) == [7, 7, 8, 8]
    assert placed.where("shard = 10 and slot = 11").count() == 30


def test_one_more_shard_moves_few_rows():
    """From 40 to 41 shards a bounded ring moves little more than the share of the new shard."""
    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, 60_000))

    def owners(shards, slack):
        at = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, (41, 64))[:shards]
        order = np.argsort(at.ravel())
        positions, owner = at.ravel()[order], np.repeat(np.arange(shards), 64)[order]
        arc = np.searchsorted(positions, keys) % len(positions)
        counts = np.bincount(arc, minlength=len(positions))
        out, first = np.empty(len(keys), np.int64), np.r_[0, np.cumsum(counts)]
        by_arc = np.argsort(arc, kind="stable")
        for a, lo, hi, shard, _ in shard_ring.place(counts, owner, shard_ring.capacities(len(keys), shards, slack)):
            out[by_arc[first[a] + lo:first[a] + hi]] = shard
        return out

    for slack, most in ((0.0, 0.10), (0.25, 0.05)):
        before, after = owners(40, slack), owners(41, slack)
        assert (before != after).mean() < most
        assert np.bincount(before).max() <= -(-len(keys) * (1 + slack) // 40)


def test_keep_first_goes_by_row(spark):
    """Ids that stand on several rows: a text that is a copy of nothing stays, of equal rows one does."""
    x, y, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyu")
    rows = [(1, x, "a"), (5, x, "b"), (5, y, "c"), (7, u, "d"), (7, u, "d"), (8, None, "e"), (8, None, "e"), (None, y + " more", "f"), (2, u.upper(), "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = Counter(tuple(r) for r in near_dup.keep_first(docs).collect())
    assert got == Counter([rows[0], rows[5], rows[6], rows[7], rows[8]])
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string, key string")
    assert Counter(tuple(r) for r in near_dup.keep_first(docs).collect()) == Counter([rows[0], rows[2], rows[3]])
    assert near_dup.keep_first(docs.limit(0)).count() == 0


def test_near_dup_groups_do_not_grow_with_a_crowd(spark, monkeypatch):
    """A template family whose pages mostly don't link: right components, and no group beyond a few blocks of sets."""
    rng = np.random.default_rng(7)
    texts = []
    for _ in range(200):
        words = [f"w{i}" for i in range(120)]
        for at in range(6, 120, 12):
            words[at] = f"slot{rng.integers(0, 4)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i:i + 5]) for i in range(116)} for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    assert 20 < len(set(label)) < 180

    block, apply = 8, PandasCogroupedOps.applyInPandas

    def watched(self, func, schema):
        def small(asking, asked):
            assert len(asking) + len(asked) <= 10 * block, "group too large"
            return func(asking, asked)

        return apply(self, small, schema)

    rest = near_dup._rest
    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", watched)
    monkeypatch.setattr(near_dup, "_rest", lambda *args: rest(*args, block=block))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component_id"] for r in near_dup.link(docs).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 7, 300):
        a = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
        assert (near_dup.sketch(a, 192) != np.iinfo(np.uint64).max).all()
    both = rng.integers(1, 1 << 62, 600, dtype=np.uint64)
    x, y = near_dup.sketch(np.unique(both[:480]), 1024), near_dup.sketch(np.unique(both[120:]), 1024)
    assert abs((x == y).mean() - 0.6) < 0.08


def brute_katz(train, order):
    """(probability of a word after a tuple of words by recursion, training tokens by count)."""
    grams = {k: Counter() for k in range(1, order + 1)}
    followers = defaultdict(Counter)
    for text in train:
        s = ["<s>"] * (order - 1) + [*tokenized(text), "\n"]
        for i in range(order - 1, len(s)):
            for k in grams:
                grams[k][tuple(s[i - k + 1:i + 1])] += 1
                followers[tuple(s[i - k + 1:i])][s[i]] += 1
    cut = {k: katz.discounts([sum(c == r for c in grams[k].values()) for r in range(1, 7)]) for k in grams}
    tokens = followers[()]

    def p(w, h):
        w = w if w in tokens else "<unk>"
        seen = followers.get(h, {})
        size, mass = sum(seen.values()), sum(cut[len(h) + 1][min(c, 6)] * c for c in seen.values())
        if not seen:
            return p(w, h[1:])
        size = size if mass < size - 1e-9 * size else size + 1
        if w in seen:
            return cut[len(h) + 1][min(seen[w], 6)] * seen[w] / size
        if not h:
            return 1 - mass / size
        return (1 - mass / size) / (1 - sum(p(x, h[1:]) for x in seen)) * p(w, h[1:])

    return p, tokens


def tokenized(text):
    return WORDS.findall(lower(text))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz_is_brute_force(spark, order):
    """Scores and base columns of all texts, and probabilities of every context that add up to one."""
    rng = np.random.default_rng(order)
    train = ["a b a c", "a b b", "c a b", "d", "A a a b", "c c\td a"] * 2 + ["e f", "g", "h a", "", None]
    train += [" ".join(rng.choice(list("abcdefgh"), rng.integers(1, 12), p=[.3, .2, .15, .1, .1, .05, .05, .05])) for _ in range(40)]
    tests = ["", None, "unseen", "a unseen b a", "a b a c", "b\u00a0a a", *(" ".join(rng.choice(list("abcdefgxy"), 9)) for _ in range(20))]
    rows = list(enumerate([*train, *tests]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz.score(docs, F.col("doc_id") >= len(train), order=order, chunk=30, bucket=16).collect()}
    p, tokens = brute_katz(train, order)
    n, v = sum(tokens.values()), len(tokens)
    assert len(got) == len(rows)
    for i, text in rows:
        line = [*tokenized(text), "\n"]
        s = ["<s>"] * (order - 1) + line
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i >= len(train), len(line), sum(w in tokens for w in line), n)
        assert abs(r["base_score"] - sum(math.log10((tokens[w] + 0.1) / (n + 0.1 * (v + 1))) for w in line)) < 1e-9
        assert abs(r["score"] - sum(math.log10(p(s[j], tuple(s[j - order + 1:j]))) for j in range(order - 1, len(s)))) < 1e-9
    for h in [("<s>", "a", "b"), ("a", "b", "a"), ("x", "y", "a"), ("b", "c", "x")]:
        h = h[len(h) - order + 1:]
        assert abs(sum(p(w, h) for w in [*tokens, "<unk>"]) - 1) < 1e-9


def test_packets_cost_less_than_a_transposed_copy():
    """Every n-gram is packed and unpacked several times: byte planes have to be cheap."""
    rng = np.random.default_rng(3)
    counts, keys = rng.integers(0, 100, 500_000), np.sort(rng.integers(0, 1 << 63, 500_000).astype(np.uint64))
    assert (katz.unpack_sorted(katz.pack_sorted(keys)) == keys).all()
    assert (katz.unpack(katz.pack(counts, np.int64), np.int64) == counts).all()
    assert len(katz.unpack(katz.pack([], np.int32), np.int32)) == 0

    def fastest(step):
        times = []
        for _ in range(5):
            start = time.process_time()
            step()
            times.append(time.process_time() - start)
        return min(times)

    copied = fastest(lambda: counts.view(np.uint8).reshape(-1, 8).T.tobytes())
    assert fastest(lambda: katz.pack(counts, np.int64)) < copied


def test_decontamination_and_quality_edges(spark, docs, empty):
    bench = spark.createDataFrame([(1, sample()[6][1]), (2, "one two"), (3, None), (4, "")], "item_id long, text string")
    found = decontaminate.scan(docs, bench).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} >= {3, 4, 5, 6, 7, 8}
    assert len(found) == len(sample())
    shuffled = decontaminate.scan(docs, bench, broadcast_bytes=0)
    columns = sorted(shuffled.columns)
    assert Counter(str([r[c] for c in columns]) for r in shuffled.collect()) == Counter(str([r[c] for c in columns]) for r in found)
    words = {i: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for i, t in enumerate([sample()[6][1], "one two"])}
    grams = {tuple(w[i:i + min(13, len(w))]) for w in words.values() for i in range(len(w) - min(13, len(w)) + 1)}
    expected = []
    for r in sample():
        w, hit = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r[1])), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
        expected.append((r[0], len(w), len(hit), len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in found) == Counter(expected)
    clean = decontaminate.remove_documents(docs, bench)
    assert clean.columns == docs.columns and 14 in {r["doc_id"] for r in clean.collect()}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut[3] == "" and cut[0] is None and "changed" in cut[8]
    assert decontaminate.scan(empty, bench).count() == 0 and decontaminate.remove_documents(docs, bench.limit(0)).count() == docs.count()
    judged = quality_rules.judge(docs)
    assert judged.count() == docs.count() and judged.where("doc_id <= 5 and kept").count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns and quality_rules.keep_good(empty).count() == 0
    line = "This very line stands at the end of each of many pages of one host"
    pages = spark.createDataFrame(
        [(i, f"start{i}\n{line}\n{line} too", "h") for i in range(30)] + [(99, " ".join(f"u{i}" for i in range(80)) + "\n" + line, "h")],
        "doc_id long, text string, source string")
    poor = quality_rules.judge(pages).where("depleted").count()
    assert poor == 30
    left = {r["doc_id"]: r["text"] for r in quality_rules.strip_boilerplate(pages).collect()}
    assert left[3] == "start3" and line not in left[99]


def test_template_pages_of_one_host_are_depleted(spark):
    """Pages that share their first and middle line and differ in one short line only, next to one of another host."""
    rng = np.random.default_rng(3)
    banner, template = (" ".join(f"{name}{i}" for i in rng.integers(0, 1000, 60)) for name in "bt")
    pages = [(i, f"{banner}\n{template}\nown line {i}", "h" if i else "other") for i in range(22)]
    own = " ".join(f"u{i}" for i in range(200))
    pages += [(99, f"{banner}\n{own}", "h"), (100, f"{banner}\n{banner}\n{own}", "h")]
    docs = spark.createDataFrame(pages, "doc_id long, text string, source string")

    def brute(limit):
        holders = defaultdict(set)
        for _, t, h in pages:
            for x in t.split("\n"):
                holders[h, x].add(t)
        left = {i: sum(len(x) for x in t.split("\n") if len(holders[h, x]) <= limit) for i, t, h in pages}
        return {i for i, t, _ in pages if 100 * left[i] < 30 * len(t.replace("\n", ""))}

    for limit in (20, 21, 22, 23):
        judged = quality_rules.judge(docs, max_documents=limit).collect()
        assert {r["doc_id"] for r in judged if r["depleted"]} == brute(limit), limit
    assert brute(20) == set(range(1, 22)) and brute(21) == brute(23) == set()
    assert {r["doc_id"] for r in quality_rules.keep_good(docs).collect()} == {0, 99, 100}


def test_ring(docs, empty):
    rows = shard_ring.assign(docs, F.col("doc_id"), [F.col("text")], 4).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(rows) == docs.count()
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert shard_ring.assign(empty, F.col("doc_id"), [], 4).count() == 0


def test_mixing(docs, empty):
    mixed = mixing.replicate(docs, {"s": 0.5, None: 0.5})
    rows = mixed.collect()
    for r in rows:
        assert 0 <= r["copy_no"] < r["n_copies"]
    assert mixed.columns[:len(docs.columns)] == docs.columns and mixing.replicate(empty).count() == 0


def test_pages_and_urls(spark):
    page = (
        '<html><head><title>t</title></head><body><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies here</div>'
        "<article><h1>Head &amp; line</h1><p>First  one.<br>Second&nbsp;<b>bold</b> &#233;<p>x</article>"
        "<div id=comments><p>A reader says a lot of things here</p></div><footer>&copy; us</footer>")
    assert extract_html.main_text(page) == "Head & line\nFirst one.\nSecond bold é\nx"
    assert extract_html.main_text("") == ""
    urls = [(1, None), (2, "no scheme"), (3, "http://A.example.org/es/x"), (4, "https://x.fr.com/fr/1?a=b"), (5, "http://other.net/1"), (6, "http://x.com/de/")]
    pages = spark.createDataFrame([(i, u, page) for i, u in urls], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, [("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/")]).collect()}
    assert (got[1]["host"], got[1]["path"], got[2]["host"]) == ("", "", "")
    assert (got[3]["rule"], got[3]["verdict"], got[4]["rule"], got[6]["rule"]) == ("example.org/es/", "block", "com/fr/", None)
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    assert url_filter.judge(pages.limit(0), []).count() == 0
    assert extract_html.extract_pages(pages).where("text like 'Head%'").count() == len(urls)


def test_blocks_of_an_article_are_kept_whatever_links_they_hold():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(6))
    page = (f"<body><p>Outside</p><article><h1><a href='/'>Title</a></h1><ul>{links}</ul><p>{'text ' * 60}</p><nav>Menu</nav>"
            f"<ul>{links}</ul><p>End</p></article><p>Outside too</p>")
    listed = [f"Link {i}" for i in range(6)]
    assert extract_html.main_text(page).split("\n") == ["Title", *listed, ("text " * 60).strip(), *listed, "End"]
    only = "<body><main><h1><a href='/'>Title</a></h1></main><div><p>Said outside</p></div>"
    assert extract_html.main_text(only).split("\n") == ["Title", "Said outside"]


def test_lists_tables_and_short_parts_without_an_article():
    long, short = ("text " * 60).strip(), ("short " * 13).strip()
    body = (f"<p>{long}</p><ul><li>One</li><li>Two</li></ul><p>{short}</p><table><tr><th>A</th><td>1</td></tr></table>"
            "<section><h2>Part</h2><p>Few words</p></section><div><p>Deep</p></div>")
    parts = [long, "One", "Two", short, "A", "1", "Part", "Few words", "Deep"]
    frame = "<body><nav>Menu</nav><div class=sidebar><p>Side</p></div>{}<footer>Foot</footer></body>"
    assert extract_html.main_text(frame.format(f"<div id=content>{body}</div>")).split("\n") == parts
    advert = "<div class=ad><p>Buy this</p></div>"
    split = f"<div id=content>{advert}<p>First</p>{advert}{body}{advert}<section><p>Last</p></section></div>{advert}<div>Elsewhere</div>"
    assert extract_html.main_text(frame.format(split)).split("\n") == ["First", *parts, "Last"]
    cells = f"<div id=content><table><tr><td>{long}</td><td class=ad>Buy</td><td>Cell</td></tr></table></div>"
    assert extract_html.main_text(frame.format(cells)).split("\n") == [long, "Cell"]


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>t</title><meta x><body><article><p>Text</p></article>", "Text"),
    ("<html><head><title>t<body><article><p>Text</p></article>", "Text"),
    ("<body><form><div class=menu>Menu</div><article><h1>Head</h1><p>Text</p></article></form>", "Head\nText"),
    ("<body><article><p>Text</p><form><p>Your mail</p></form><p>End</p></article>", "Text\nEnd"),
    ("<body><article><p>Text</p><button>Share<p>More</p><button>Like</button><p>End</p></article>", "Text\nMore\nEnd"),
    ("<body><article><p>Text</p><article class=comment><p>Reader</p></article></article><article class=comment><p>Reader " + "x " * 99 + "</p></article>", "Text"),
    ("<body><article><p>" + "text " * 40 + "</p></article><nav>More</nav><article><p>A teaser</p></article>", ("text " * 40).strip()),
    ("<body><article><p>One</p></article><article><p>Two</p></article><nav>More</nav>", "One\nTwo"),
    ("<body><article><div class=entry-header><h1>Head</h1></div><p class='author-comment'>Said</p><div class=post-comments>Reader</div></article>", "Head\nSaid"),
    ("<body><article class='post sidebar-left'><p title=\"a > b\">Text</p><p data-x=it's>Quote</p></article>", "Text\nQuote"),
    ("<body><article><p>a < b and c<d</p><svg/><p>x</p><!-- <p>no</p> --></article>", "a < b and c\nx"),
    ("<article><p>1 < 2", "1 < 2"),
    ("<article><script>if (a<b) '</p>'</SCRIPT ><p>x</p><style>p{}", "x"),
    ("text <b", "text <b"),
    ("<", "<"),
])
def test_pages_as_they_are_written(page, text):
    assert extract_html.main_text(page) == text


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a " * 350_000 + ">", '<a ="' * 200_000 + ">", "<div>" * 12_000 + "</b>" * 80_000, "<title>" * 140_000, "<svg>" * 200_000])
def test_hostile_pages_take_linear_time(page):
    began = time.monotonic()
    extract_html.main_text(page)
    assert time.monotonic() - began < 20  # growth with the square would take hours


def test_rules_and_trees_on_urls_of_other_hosts(spark):
    """Rules against brute force; trees judge urls that no rule fits by what sets the labelled ones apart."""
    rng = np.random.default_rng(11)
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

    def tail(good):
        words = "-".join("".join(rng.choice(list("aeioulmnrst"), 6)) for _ in range(3))
        return f"{words}.html" if good else f"{rng.integers(1e9)}?id={rng.integers(1e9)}&s={rng.integers(1e9)}&t={rng.integers(1e9)}"

    urls = [f"http://h{rng.integers(50)}.com/{'fr' if good else 'de'}/{tail(good)}" for good in rng.integers(0, 2, 600)]
    fresh = [(f"https://n{rng.integers(50)}.net/{tail(good)}", bool(good)) for good in rng.integers(0, 2, 300)]
    odd = [None, "", "none", "http://A.example.org/es/x", "x://EXAMPLE.org/en/12#f", "x://example.org/en/2", "http://badexample.org", "http://com/fr/?q", "http://com/fr?/fr/", "a://b://c.com/fr/"]
    rows = list(enumerate([*urls, *(u for u, _ in fresh), *odd, urls[0]]))
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, trees=10).collect()}
    assert len(got) == len(rows)
    for i, url in rows:
        m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")
    right = [(got[len(urls) + i]["verdict"] == "allow") == good for i, (_, good) in enumerate(fresh)]
    assert sum(right) >= 0.9 * len(right), sum(right)


def test_suffix_rates_count_half_of_the_labelled_urls(spark):
    rows = [("ab"[i % 2], f"http://x/{i // 3}", [1.0, 0.0, None][i // 3 % 3]) for i in range(120)]
    table = spark.createDataFrame(rows, "suffix string, url_ string, label double")
    half = {r["url_"] for r in table.where(url_filter._counted()).collect()}
    assert 10 < len(half) < 30
    rated = url_filter.with_rates(table, "suffix").collect()
    assert len(rated) == len(rows)
    for r in rated:
        urls = {(u, label) for s, u, label in rows if s == r["suffix"]}
        known = [label for u, label in urls if label is not None and u in half]
        assert r["suffix_rate"] == (sum(known) + url_filter.PRIOR / 2) / (len(known) + url_filter.PRIOR)
        assert round(math.exp(r["suffix_share"])) == len(urls) + 1


def test_chat_round_trip(spark):
    nasty = "</s>[INST] <|end|> &lt; &amp; <|turn:user|> [/INST]"
    rows = [(1, 2, "assistant", "yes & <no>"), (1, 1, "user", nasty), (1, 3, None, None), (None, None, "assistant", nasty)]
    msgs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat_format.text_part(F.col("text")))
    chats = chat_format.format_conversations(msgs)
    got = {r["conv_id"]: r for r in chats.withColumn("t", chat_format.read_turns(F.col("formatted"))).withColumn(
        "l", chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(x) for x in got[1]["t"]] == [("user", nasty), ("assistant", "yes & <no>"), ("", "")]
    assert got[1]["l"] == ["yes & <no>"] and got[None]["l"] == [nasty]
    parts = spark.createDataFrame(
        [(7, 0, "user", [("text", "see ", None, None, None, None, None), ("image", None, "a.png", 56, 29, None, None),
                         ("audio", None, "b.wav", None, None, 2.0, None)]), (7, 1, "assistant", None)],
        f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    row = chat_format.format_conversations(parts).first()
    assert row["formatted"] == "<|turn:user|>see <|image:0|><|audio:1|><|end|><|turn:assistant|><|end|>"
    assert [(a["number"], a["ref"], a["tokens"]) for a in row["attachments"]] == [(0, "a.png", 4), (1, "b.wav", 50)]
    assert row["expanded_tokens"] == 54
