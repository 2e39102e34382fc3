"""Definitions of de-duplication and resolution over all pairs, used as test oracles only."""

import random

RANK = {"tmdb": 0, "rotten_tomatoes": 1, "kaggle": 2, "imdb": 3, "spark": 4}
COUNTED = ("overview", "release_date", "vote_average", "vote_count", "poster_path", "runtime_minutes")
ANY = (
    "overview", "vote_average", "vote_count", "runtime_minutes", "budget", "revenue",
    "poster_path", "tmdb_id", "imdb_id",
)
ONLY = {
    "tomatometer_score": "rotten_tomatoes", "audience_score": "rotten_tomatoes",
    "critics_consensus": "rotten_tomatoes", "popularity": "spark",
}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b):
            above = row[j + 1]
            row[j + 1] = diagonal + 1 if x == y else max(above, row[j])
            diagonal = above
    return row[-1]


def score(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if not a or not b:
        return 0.0
    total = len(a) + len(b)
    return (1 - (total - 2 * lcs(a, b)) / total) * 100


def holds(r):
    """What identifies a record inside its source: its strongest identifier, else title and year."""
    return next(
        (level, key) for level, key in enumerate([r["tmdb_id"], r["imdb_id"], (r["title_norm"], r["year"])])
        if key is not None)


def dedup(records):
    """Of records that hold the same, the fullest and of these the first, level by level.

    A level's records stand in the order in which their keys appear. A record goes when a
    stronger level has its identifier (level 1) or its title and year (level 2).
    """
    order = list(dict.fromkeys(map(holds, records)))
    best = {
        key: max((r for r in records if holds(r) == key), key=lambda r: sum(r[c] is not None for c in COUNTED))
        for key in order}
    by_level = [[best[k] for k in order if k[0] == level] for level in range(3)]
    imdb_ids = [r["imdb_id"] for r in by_level[0]]
    strong = by_level[0] + [r for r in by_level[1] if r["imdb_id"] not in imdb_ids]
    titles = [(r["title_norm"], r["year"]) for r in strong]
    return strong + [r for r in by_level[2] if holds(r)[1] not in titles]


def match(r, m, threshold):
    """(level, -score) at which `r` belongs to master `m`; None where it doesn't."""
    for level, name in enumerate(["tmdb_id", "imdb_id"]):
        if r[name] is not None and r[name] == m[name]:
            return level, 0
    if r["title_norm"] and m["title_norm"]:
        apart = 0 if None in (r["year"], m["year"]) else abs(r["year"] - m["year"])
        alike = score(r["title_norm"], m["title_norm"])
        if apart <= 1 and alike >= threshold:
            return 2, -alike
    return None


def merge(records, threshold):
    """Gold dicts with `sources`, from the match relation over all pairs of records.

    Masters are the first maximal set of records of which none matches another, by source
    priority; any other record follows the master it matches best, the earlier one on ties.
    """
    queue = sorted(records, key=lambda r: RANK[r["source"]])
    relation = {
        (i, j): found for i, r in enumerate(queue) for j, m in enumerate(queue[:i])
        if (found := match(r, m, threshold)) is not None}
    group = {}
    for i in range(len(queue)):
        choice = min(((relation[i, j], j) for j in group if (i, j) in relation), default=None)
        group.setdefault(choice[1] if choice else i, []).append(i)
    return standing([(queue[j], filled_in([queue[i] for i in members])) for j, members in group.items()])


def filled_in(members):
    """The master with the first known value of each field that its followers may fill."""
    def value(c):
        given = [r[c] for r in members[:1]] + [
            r[c] for r in members[1:] if c in ANY or ONLY.get(c) == r["source"]]
        return next((v for v in given if v is not None), None)

    return {c: value(c) for c in members[0]} | {"sources": list(dict.fromkeys(r["source"] for r in members))}


def standing(entities):
    """The entities that stay: by own tmdb_id, by an imdb_id no such entity shows, by a free title and year."""
    top = [e for own, e in entities if own["tmdb_id"] is not None]
    shown = {e["imdb_id"] for e in top}
    top += [e for own, e in entities if own["tmdb_id"] is None and own["imdb_id"] is not None and e["imdb_id"] not in shown]
    taken = {(e["title_norm"], e["year"]) for e in top}
    last = {(e["title_norm"], e["year"]): e for _, e in entities}
    return top + [e for key, e in last.items() if key not in taken]


def random_records(seed, n):
    """Records full of clashes: few ids, near-equal titles, gaps everywhere."""
    rnd = random.Random(seed)
    base = ["lighthouse", "lighthuse", "the well", "well the", "orchardist", "orcherdist", "ox", "oxs",
            "house of the crows", "houses of the crows", "house of a crows", "hose of the crows"]
    out = []
    for i in range(n):
        title = rnd.choice(base + [None, "!!!"])
        maybe = lambda v, p=0.6: v if rnd.random() < p else None
        out.append({
            "source": rnd.choice(list(RANK)),
            "tmdb_id": maybe(rnd.randrange(n), 0.35),
            "imdb_id": maybe(f"tt{rnd.randrange(n)}", 0.35),
            "title": title,
            "title_norm": "" if title == "!!!" else title,
            "year": maybe(rnd.randrange(1990, 1995), 0.8),
            "overview": maybe(f"overview {i}"),
            "vote_average": maybe(float(i % 10)),
            "vote_count": maybe(i),
            "poster_path": maybe(f"/p{i}"),
            "runtime_minutes": maybe(60 + i),
            "budget": maybe(i * 10),
            "revenue": maybe(i * 100),
            "popularity": maybe(i / 4),
            "tomatometer_score": maybe(float(i % 100)),
            "audience_score": maybe(float(i % 90)),
            "critics_consensus": maybe(f"consensus {i}"),
            "original_title": maybe(f"original {i}"),
            "seq": i,
        })
        out[-1]["release_date"] = None if out[-1]["year"] is None else f"{out[-1]['year']}-01-01"
    return out
