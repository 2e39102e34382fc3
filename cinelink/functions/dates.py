"""Free-form dates to DATE through a closed list of layouts."""

from pyspark.sql import functions as F

from cinelink.functions.text import BLANK

# Accepted layouts. Slashed and dashed numbers are month first, day
# first when the first number cannot be a month. Each layout names the shape it is
# tried on ("~" is a run of blanks), so a value reaches at most a few parsers.
LAYOUTS = [
    (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", ["yyyy-M-d"]),
    (r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", ["yyyy/M/d"]),
    (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:T|~)[0-9]{1,2}:[0-9]{2}.*", ["yyyy-M-d"]),
    (r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", ["M/d/yyyy", "d/M/yyyy"]),
    (r"[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", ["M-d-yyyy", "d-M-yyyy"]),
    (r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}", ["M.d.yyyy", "d.M.yyyy"]),
    (r"[A-Za-z]{3}~[0-9]{1,2},?~[0-9]{4}", ["MMM d yyyy"]),
    (r"[A-Za-z]{3,9}~[0-9]{1,2},?~[0-9]{4}", ["MMMM d yyyy"]),
    (r"[0-9]{1,2}~[A-Za-z]{3},?~[0-9]{4}", ["d MMM yyyy"]),
    (r"[0-9]{1,2}~[A-Za-z]{3,9},?~[0-9]{4}", ["d MMMM yyyy"]),
    (r"[A-Za-z]{3},?~[0-9]{4}", ["MMM yyyy"]),
    (r"[A-Za-z]{3,9},?~[0-9]{4}", ["MMMM yyyy"]),
    (r"[0-9]{8}", ["yyyyMMdd"]),
    (r"[0-9]{4}-[0-9]{1,2}", ["yyyy-M"]),
    (r"[0-9]{1,2}/[0-9]{4}", ["M/yyyy"]),
]

# Names in dates. Case is ignored, a dot may follow.
MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
    r"|nov(?:ember)?|dec(?:ember)?)\.?"
)
WEEKDAY = r"(?:(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?[.,]* )?"
DAY, YEAR = r"([0-9]{1,2})(?:st|nd|rd|th)?", r"([0-9]{4}|[0-9]{2})"
CLOCK = r"(?:(?:,? |T)[0-9]{1,2}:[0-9]{2}.*)?"
# Other spellings, on text with single blanks, each with its rewriting as year, month, day.
# Slashes in the rewriting stand for month first, day first when that is no date.
SPELLINGS = [
    (f"{WEEKDAY}{MONTH}[ -]{DAY},?[ -]([0-9]{{4}}){CLOCK}", "$3 $1 $2"),
    (f"{WEEKDAY}{DAY}(?: of |[ -]){MONTH},?[ -]{YEAR}{CLOCK}", "$3 $2 $1"),
    (f"([0-9]{{4}})[ -]{MONTH}[ -]([0-9]{{1,2}}){CLOCK}", "$1 $2 $3"),
    (rf"([0-9]{{1,2}})([/.-])([0-9]{{1,2}})\2{YEAR}{CLOCK}", "$4/$1/$3"),
    (rf"([0-9]{{4}})([/.])([0-9]{{1,2}})\2([0-9]{{1,2}}){CLOCK}", "$1 $3 $4"),
    (r"([0-9]{4})([0-9]{2})([0-9]{2})[T ][0-9]{4,6}.*", "$1 $2 $3"),
]
# Two-digit years from 69 on are of the 20th century, those below of the 21st.
CENTURIES = [("^(69|[7-9][0-9])([ /])", "19$1$2"), ("^([0-9]{2})([ /])", "20$1$2")]


def _once(value, body):
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _spelled(text):
    """Date from one of `SPELLINGS`."""
    ordered = None
    for spelling, order in SPELLINGS:
        pattern = f"(?i)^{spelling}$"
        turned = F.regexp_replace(text, pattern, order)
        ordered = F.when(text.rlike(pattern), turned) if ordered is None else ordered.when(text.rlike(pattern), turned)
    # Three letters of a month's name are enough to parse it.
    ordered = F.initcap(F.regexp_replace(ordered, "([A-Za-z]{3})[A-Za-z]+", "$1"))
    for pattern, full in CENTURIES:
        ordered = F.regexp_replace(ordered, pattern, full)
    return _once(ordered, lambda d: F.coalesce(*[
        F.try_to_date(d, f) for f in ("yyyy MMM d", "yyyy M d", "yyyy/M/d", "yyyy/d/M")]))


def _has_shape(col, shape):
    return col.rlike(f"^{BLANK}*(?:{shape.replace('~', BLANK + '+')}){BLANK}*$")


def null_tokens(col, tokens):
    """Null when the text is one of `tokens`."""
    return F.when(~col.isin(tokens), col)


def parse_date(col):
    """Date from text; a missing month or day becomes 01, anything unknown null.

    Null tokens have no accepted shape. The text is cleaned only in the branch whose
    shape it has. Two-digit years from 69 on are of the 20th century.
    """
    raw = col.cast("string")
    text = F.trim(F.regexp_replace(raw, BLANK + "+", " "))
    # Month names as the parser expects them, without commas or the time of day.
    words = F.initcap(F.regexp_replace(text, ",", ""))
    day_part = F.regexp_replace(text, "[T ][0-9]{1,2}:.*$", "")
    parsed = F.when(
        _has_shape(raw, "[0-9]{1,4}"), F.make_date(text.try_cast("int"), F.lit(1), F.lit(1))
    )
    for shape, layouts in LAYOUTS:
        if "A-Za-z" in shape:
            value = words
        elif ":[0-9]" in shape:
            value = day_part
        else:
            value = text
        parsed = parsed.when(
            _has_shape(raw, shape), F.coalesce(*[F.try_to_date(value, f) for f in layouts])
        )
    return F.coalesce(parsed, _once(text, _spelled))


def year_start(col):
    """'1980' to 1980-01-01; other text to null."""
    text = F.trim(col.cast("string"))
    return F.when(
        text.rlike("^[0-9]{1,4}$"), F.make_date(text.try_cast("int"), F.lit(1), F.lit(1))
    )
