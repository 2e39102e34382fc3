"""DuckDB SQL for the text, date and matching rules, composed by the oracle queries."""

from cinelink.plans.catalogue import FILMS

BLANKS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def strip_markup(x):
    for pattern, flags in (
        ("<!--.*?-->", "gs"),
        (r"<script\b[^>]*>.*?</script\s*>", "gis"),
        (r"<style\b[^>]*>.*?</style\s*>", "gis"),
        (r"<template\b[^>]*>.*?</template\s*>", "gis"),
        ("</?[A-Za-z!?][^>]*>", "gs"),
    ):
        x = f"regexp_replace({x}, '{pattern}', ' ', '{flags}')"
    for name, char in (
        ("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&"),
    ):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def clean_text(x):
    text = f"CASE WHEN contains({x}, '<') AND contains({x}, '>') THEN {strip_markup(x)} ELSE {x} END"
    return f"nullif(trim(regexp_replace({text}, '{BLANKS}', ' ', 'g')), '')"


def clean_key(x):
    """Match key of a title that is clean already."""
    kept = rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_\- ]', '', 'g')"
    return f"lower(trim(regexp_replace({kept}, ' +', ' ', 'g')))"


def token_key(x):
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def genre_list(x):
    names = f"""list_filter(list_transform(TRY_CAST({x} AS JSON[]), lambda g: json_extract_string(g, '$.name')),
                lambda n: n IS NOT NULL)"""
    words = f"""list_filter(list_transform(string_split(replace({x}, '|', ','), ','), lambda w: trim(w)), lambda w: w <> '')"""
    return f"CASE WHEN {x} IS NULL THEN [] WHEN {x} LIKE '[%' THEN coalesce({names}, {words}) ELSE {words} END"


def parse_date(x):
    t = f"trim(regexp_replace({x}, '{BLANKS}', ' ', 'g'))"
    layouts = [
        "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%b %d, %Y", "%d %B %Y",
        "%d %b %Y", "%B %Y", "%b %Y", "%Y%m%d", "%Y-%m",
    ]
    formats = "[" + ", ".join(f"'{f}'" for f in layouts) + "]"
    return f"""CASE WHEN regexp_matches({t}, '^[0-9]{{1,4}}$')
        THEN make_date(CAST(TRY_CAST({t} AS INT) AS INT), 1, 1)
        ELSE CAST(try_strptime({t}, {formats}) AS DATE) END"""


def common_subsequence(a, b):
    """Longest common subsequence: one row of running maxima per character of a."""
    return f"""list_extract(list_reduce(
        list_prepend([0 FOR _ IN range(length({b}) + 1)], [[ord(c)] FOR c IN string_split({a}, '')]),
        lambda row, ch: list_reduce(
            list_prepend([0], [
                [CASE WHEN ord(substr({b}, j, 1)) = ch[1] THEN row[j] + 1 ELSE row[j + 1] END]
                FOR j IN range(1, length({b}) + 1)]),
            lambda done, cell: list_append(done, greatest(done[len(done)], cell[1])))
        ), -1)"""


def similarity(a, b):
    lcs = common_subsequence(a, b)
    return f"""CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a} = '' OR {b} = '' THEN 0.0
        WHEN {a} = {b} THEN 100.0
        ELSE (1.0::DOUBLE - (length({a}) + length({b}) - 2 * {lcs})::DOUBLE
              / (length({a}) + length({b}))) * 100 END"""


# Films after normalising: one row per film.
NORMAL = f"""
films AS ({FILMS}),
cleaned AS (
    SELECT source, k, tmdb_id, imdb_id,
        {clean_text('title')} AS title, {clean_text('original_title')} AS original_title,
        {clean_text('overview')} AS overview, {clean_text('critics_consensus')} AS critics_consensus,
        {parse_date('release_date')} AS release_date,
        CASE WHEN source IN ('tmdb', 'imdb') THEN CASE WHEN vote_average BETWEEN 0 AND 10 THEN vote_average END
             ELSE vote_average END AS vote_average,
        vote_count, popularity, poster_path,
        CASE WHEN tomatometer_score BETWEEN 0 AND 100 THEN tomatometer_score END AS tomatometer_score,
        CASE WHEN audience_score BETWEEN 0 AND 100 THEN audience_score END AS audience_score,
        budget, revenue, runtime_minutes, {genre_list('genre_text')} AS genres
    FROM films),
normal AS (
    SELECT *, {clean_key('title')} AS title_norm, year(release_date) AS year,
        CASE source WHEN 'tmdb' THEN 0 WHEN 'rotten_tomatoes' THEN 1 WHEN 'kaggle' THEN 2
                    WHEN 'imdb' THEN 3 ELSE 4 END AS priority,
        CASE WHEN tmdb_id IS NOT NULL THEN 1 WHEN imdb_id IS NOT NULL THEN 2 ELSE 3 END AS tier,
        (overview IS NOT NULL)::INT + (release_date IS NOT NULL)::INT + (vote_average IS NOT NULL)::INT
        + (vote_count IS NOT NULL)::INT + (poster_path IS NOT NULL)::INT
        + (runtime_minutes IS NOT NULL)::INT AS filled
    FROM cleaned)"""

# Films left after de-duplication inside each source; `pos` is their number in priority order.
KEPT = f"""{NORMAL},
ranked AS (
    SELECT *, row_number() OVER key_best AS rn, min(k) OVER key_all AS first_seen
    FROM normal
    WINDOW key_best AS (PARTITION BY source, tier,
            CASE tier WHEN 1 THEN concat('t', tmdb_id) WHEN 2 THEN concat('i', imdb_id) END,
            CASE tier WHEN 3 THEN title_norm END, CASE tier WHEN 3 THEN year END
            ORDER BY filled DESC, k),
        key_all AS (PARTITION BY source, tier,
            CASE tier WHEN 1 THEN concat('t', tmdb_id) WHEN 2 THEN concat('i', imdb_id) END,
            CASE tier WHEN 3 THEN title_norm END, CASE tier WHEN 3 THEN year END)),
best AS (SELECT * FROM ranked WHERE rn = 1),
ids AS (
    SELECT * FROM best b WHERE tier = 1 OR (tier = 2 AND NOT EXISTS (
        SELECT 1 FROM best c WHERE c.tier = 1 AND c.source = b.source AND c.imdb_id = b.imdb_id))),
kept AS (
    SELECT *, row_number() OVER (ORDER BY priority, tier, first_seen) AS pos,
        {token_key('title_norm')} AS token_key
    FROM (
        SELECT * FROM ids UNION ALL
        SELECT * FROM best b WHERE tier = 3 AND NOT EXISTS (
            SELECT 1 FROM ids c WHERE c.source = b.source
              AND c.title_norm IS NOT DISTINCT FROM b.title_norm AND c.year IS NOT DISTINCT FROM b.year)))"""


# The same films with those that have a tmdb_id first.
KEPT_STRICT = f"""{KEPT.replace('kept AS (', 'kept_by_source AS (')},
kept AS (SELECT * EXCLUDE (pos), row_number() OVER (ORDER BY tmdb_id IS NULL, pos) AS pos FROM kept_by_source)"""


def matches(threshold, strict_ids=False):
    """All matching pairs of kept films: (later, earlier, level, score). With `strict_ids`, none of different tmdb_ids."""
    apart = "AND (l.tmdb_id IS NULL OR e.tmdb_id IS NULL)" if strict_ids else ""
    return f"""{KEPT_STRICT if strict_ids else KEPT},
words AS MATERIALIZED (SELECT DISTINCT token_key AS w FROM kept WHERE token_key <> ''),
near AS MATERIALIZED (
    SELECT a.w AS wa, b.w AS wb FROM words a JOIN words b ON a.w <= b.w
     AND levenshtein(a.w, b.w) <= floor({(100 - threshold) / 100} * (length(a.w) + length(b.w)) + 1e-9)),
alike AS MATERIALIZED (
    SELECT * FROM (SELECT wa, wb, {similarity('wa', 'wb')} AS score FROM near) WHERE score >= {threshold}),
both_ways AS (SELECT wa, wb, score FROM alike UNION SELECT wb, wa, score FROM alike),
pairs AS MATERIALIZED (
    SELECT later, earlier, min(level) AS level, max(score) AS score FROM (
        SELECT l.pos AS later, e.pos AS earlier, 1 AS level, 0.0 AS score
        FROM kept l JOIN kept e ON l.tmdb_id = e.tmdb_id AND e.pos < l.pos
        UNION ALL
        SELECT l.pos, e.pos, 2, 0.0 FROM kept l JOIN kept e ON l.imdb_id = e.imdb_id AND e.pos < l.pos {apart}
        UNION ALL
        SELECT l.pos, e.pos, 3, s.score
        FROM kept l JOIN both_ways s ON s.wa = l.token_key
        JOIN kept e ON e.token_key = s.wb AND e.pos < l.pos
        WHERE (l.year IS NULL OR e.year IS NULL OR abs(l.year - e.year) <= 1) {apart})
    GROUP BY later, earlier)"""


def settled(threshold, strict_ids=False):
    """Status of every kept film, settled in rounds over the pairs; needs WITH RECURSIVE."""
    return f"""{matches(threshold, strict_ids)},
rounds AS (
    SELECT 0 AS round, pos, 'open' AS status FROM kept
    UNION ALL
    SELECT r.round + 1, r.pos, CASE
        WHEN r.status <> 'open' THEN r.status
        WHEN coalesce(x.has_master, FALSE) THEN 'follower'
        WHEN coalesce(x.has_open, FALSE) THEN 'open'
        ELSE 'master' END
    FROM rounds r LEFT JOIN (
        SELECT p.later, bool_or(e.status = 'master') AS has_master, bool_or(e.status = 'open') AS has_open
        FROM pairs p JOIN rounds e ON e.pos = p.earlier GROUP BY p.later) x ON x.later = r.pos
    WHERE EXISTS (SELECT 1 FROM rounds o WHERE o.status = 'open')),
final AS MATERIALIZED (SELECT pos, status FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
links AS MATERIALIZED (
    SELECT pos, pos AS master, 0 AS level, NULL::DOUBLE AS score FROM final WHERE status = 'master'
    UNION ALL
    SELECT later, earlier, level, CASE WHEN level = 3 THEN score END FROM (
        SELECT p.*, row_number() OVER (PARTITION BY later ORDER BY level, p.score DESC, earlier) AS rn
        FROM pairs p JOIN final m ON m.pos = p.earlier AND m.status = 'master'
        JOIN final f ON f.pos = p.later AND f.status = 'follower')
    WHERE rn = 1)"""


def gold(threshold):
    any_source = [
        "overview", "vote_average", "vote_count", "runtime_minutes", "budget", "revenue",
        "poster_path", "tmdb_id", "imdb_id",
    ]
    from_one = {
        "tomatometer_score": "rotten_tomatoes", "audience_score": "rotten_tomatoes",
        "critics_consensus": "rotten_tomatoes", "popularity": "spark",
    }
    own = ["source", "title", "original_title", "release_date", "title_norm", "year"]
    fields = [f"arg_min({c}, r.pos) FILTER ({c} IS NOT NULL) AS {c}" for c in any_source]
    fields += [
        f"arg_min({c}, r.pos) FILTER ({c} IS NOT NULL AND (r.pos = master OR source = '{s}')) AS {c}"
        for c, s in from_one.items()
    ]
    fields += [f"arg_min({c}, r.pos) FILTER ({c} IS NOT NULL AND r.pos = master) AS {c}" for c in own]
    fields += [
        f"arg_min({c}, r.pos) FILTER ({c} IS NOT NULL AND r.pos = master) AS registered_{c}"
        for c in ("tmdb_id", "imdb_id")
    ]
    fields.append("arg_min(genres, r.pos) FILTER (r.pos = master) AS genres")
    return f"""{settled(threshold)},
contributors AS (
    SELECT master, string_agg(source, ',' ORDER BY first) AS sources FROM (
        SELECT master, source, min(r.pos) AS first FROM kept r JOIN links USING (pos) GROUP BY master, source)
    GROUP BY master),
filled AS MATERIALIZED (
    SELECT master, {', '.join(fields)} FROM kept r JOIN links l USING (pos) GROUP BY master),
gold_ids AS (
    SELECT * FROM filled WHERE registered_tmdb_id IS NOT NULL
    UNION ALL
    SELECT * FROM filled f WHERE registered_tmdb_id IS NULL AND registered_imdb_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM filled c WHERE c.registered_tmdb_id IS NOT NULL AND c.imdb_id = f.imdb_id)),
last_of_key AS (
    SELECT * FROM filled
    QUALIFY row_number() OVER (PARTITION BY title_norm, year ORDER BY master DESC) = 1),
gold AS (
    SELECT g.*, c.sources FROM (
        SELECT * FROM gold_ids UNION ALL
        SELECT * FROM last_of_key b WHERE NOT EXISTS (
            SELECT 1 FROM gold_ids c WHERE c.title_norm IS NOT DISTINCT FROM b.title_norm
              AND c.year IS NOT DISTINCT FROM b.year)) g
    JOIN contributors c USING (master))"""
