"""Text clean-up, match keys, genre lists, theme predicates."""

from html.entities import html5

from pyspark.sql import functions as F

from cinelink.schema import THEME_KEYWORDS

# The blanks of Unicode text, control separators included. Single
# characters below 256 share one lookup table; ranges would be tested one by one.
BLANK = r"[\t\n\x0B\f\r\x1c\x1d\x1e\x1f \x85\xa0\p{Z}]"

# Markup whose content is not text.
MARKUP = [
    r"(?s)<!--.*?-->",
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?is)<template\b[^>]*>.*?</template\s*>",
    r"(?s)</?[A-Za-z!?][^>]*>",
]
# Where the content of a markup starts that is not text; without it only the tags themselves go.
OPENING = r"(?i)<(?:!--|(?:script|style|template)\b)"
ENTITY = r"&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)"
CLOSED_ENTITY = ENTITY.replace(";?", ";")
# Named references of HTML 5; the older ones are also known without a semicolon and then
# by their longest beginning. A map is searched from the front, so the usual names stand there.
USUAL = ["amp;", "quot;", "nbsp;", "lt;", "gt;", "apos;", "copy;", "middot;"]
NAMED = "\x00".join(f"{name}\x01{html5[name]}" for name in sorted(html5, key=lambda n: (n not in USUAL, n)))
OLDER = "^(" + "|".join(sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))) + ")(.*)$"
# Numbers 128 to 159 mean the characters of the Western code page where it has one.
WESTERN = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))


def valid_utf8(binary):
    """Bytes to text, replacing what is not UTF-8."""
    return F.make_valid_utf8(binary.cast("string"))


def _character(code):
    """Code point to a one-character string; invalid ones to the replacement character."""
    # A number too large for its type is null.
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    code = F.when(bad, 0xFFFD).otherwise(code)
    western = F.substring(F.lit(WESTERN), (code - 127).cast("int"), F.lit(1))
    return F.when(code.between(128, 159), western).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(col, unclosed=True):
    """Replace character references; unknown names stay as written, without `unclosed` also what lacks its semicolon."""
    pattern = ENTITY if unclosed else CLOSED_ENTITY
    named = F.str_to_map(F.lit(NAMED), F.lit("\x00"), F.lit("\x01"))

    def by_beginning(name):
        if not unclosed:
            return F.lit(None)
        older = F.regexp_extract(name, OLDER, 1)
        return F.when(older != "", F.concat(F.try_element_at(named, older), F.regexp_extract(name, OLDER, 2)))

    def resolve(name):
        return (
            F.when(name.rlike("^#[xX]"), _character(F.conv(F.regexp_extract(name, "^#[xX]0*([^;]{0,12})", 1), 16, 10).try_cast("bigint")))
            .when(name.startswith("#"), _character(F.regexp_extract(name, "^#([^;]*)", 1).try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(named, name), by_beginning(name), F.concat(F.lit("&"), name)))
        )

    plain = F.split(col, pattern)
    found = F.transform(F.regexp_extract_all(col, F.lit(pattern), F.lit(1)), resolve)
    joined = F.array_join(
        F.zip_with(plain, found, lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), ""
    )
    return F.when(col.contains("&"), joined).otherwise(col)


def strip_markup(col, unclosed=True):
    """HTML to text: every tag becomes a blank, comments and scripts vanish."""
    out = col
    for pattern in MARKUP[:-1]:
        out = F.regexp_replace(out, pattern, " ")
    out = F.regexp_replace(F.when(col.rlike(OPENING), out).otherwise(col), MARKUP[-1], " ")

    def decoded(stripped):
        # Where every reference is the most usual one, its text can be replaced as it stands.
        rare = F.replace(stripped, F.lit("&amp;"), F.lit("")).contains("&")
        return F.when(rare, decode_entities(stripped, unclosed)).otherwise(F.replace(stripped, F.lit("&amp;"), F.lit("&")))

    # The list of one gives the stripped text a name, so that it is computed once.
    return F.when(col.contains("&"), F.transform(F.array(out), decoded)[0]).otherwise(out)


def collapse_blanks(col):
    """Single blanks, trimmed; empty becomes null."""
    return F.nullif(F.trim(F.regexp_replace(col, BLANK + "+", " ")), F.lit(""))


def clean_text(col, unclosed=True):
    """Markup is removed only from text holding both angle brackets; `unclosed`: see `decode_entities`."""
    text = F.when(col.contains("<") & col.contains(">"), strip_markup(col, unclosed)).otherwise(col)
    return collapse_blanks(text)


def title_key(col, unclosed=True):
    """Lower-case letters, digits, underscore, hyphen and single blanks.

    May be the empty string, which is not the same as null: an empty key is known
    but matches nothing.
    """
    kept = F.regexp_replace(clean_text(col, unclosed), r"[^\p{L}\p{N}_\- ]", "")
    return F.lower(F.trim(F.regexp_replace(kept, " +", " ")))


def token_key(col):
    """Words in code point order; the key on which titles are compared."""
    return F.array_join(F.array_sort(F.split(col, " ")), " ")


def parse_genres(col):
    """JSON list of {"name": ...}, else text split on commas and bars."""
    names = F.transform(
        F.from_json(col, "array<struct<name:string>>"), lambda g: g["name"]
    )
    names = F.filter(names, lambda n: n.isNotNull())
    words = F.transform(F.split(col, r"[,|]"), lambda w: F.trim(w))
    words = F.filter(words, lambda w: w != "")
    is_list = col.startswith("[")
    return F.coalesce(F.when(is_list, names), words, F.array().cast("array<string>"))


def has_genre(genres, term):
    """Case-insensitive: any genre of the list contains the term."""
    return F.exists(genres, lambda g: F.contains(F.lower(g), F.lit(term.lower())))


def mentions(col, keywords=THEME_KEYWORDS):
    """Case-insensitive: the text contains one of the keywords."""
    text = F.lower(F.coalesce(col, F.lit("")))
    hit = F.lit(False)
    for word in keywords:
        hit = hit | text.contains(word)
    return hit


def completeness(columns):
    """How many of the columns are filled."""
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
