"""Quality rules: cross-document line frequency.

Lines are normalised (lower case, one blank for white space, trimmed) and hashed. Of every
host the distinct texts that hold a line are counted; a line in more than `max_documents`
of them is boilerplate, whatever else these texts have in common. A document of whose
characters less than `min_left` percent remain without its boilerplate lines is depleted.
Exact copies count as one text, so copying does not make a line boilerplate; near copies
count one by one.

Defined results: null or empty text has no words and fails the base rules; a null host is a
host of its own; repeated rows get the same verdict each; an empty table gives no rows;
other columns are not looked at.
"""

from pyspark.sql import functions as F

from cinelink.llm.texts import SPACE, digest, group_key, let, split_words, text_or_empty
from cinelink.runtime import materialize

MAX_DOCUMENTS = 20
MIN_LEFT = 30
MIN_WORDS = 50
MAX_REPEATED = 50
SYMBOLS = "#*$%&|<>"


def _repeated_words(words):
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are sorted by hash, so that equal ones are neighbours; work is n log n.
    """
    windows = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at"),
        ),
    )).otherwise(F.expr("cast(array() as array<struct<h:bigint,at:int>>)"))

    def repeated(s):
        return F.transform(
            F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])),
            lambda x: x["at"],
        )

    def covered(at):
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, start, lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["last"])).cast("long").alias("n"), x.alias("last"),
        ))["n"]

    def count(w):
        several = F.size(F.array_distinct(F.transform(w, lambda x: x["h"]))) < F.size(w)
        return F.when(
            several, covered(F.sort_array(let(F.sort_array(w), repeated)))
        ).otherwise(F.lit(0).cast("long"))

    return let(windows, count)


def _normal(line):
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _line_hash(line):
    return F.xxhash64(_normal(line))


def facts(docs, text="text", host="source", keep=()):
    """Base figures, text digest and hashed lines of every row, stored once."""
    t = text_or_empty(F.col(text))
    rows = docs.select(
        *[F.col(c) for c in keep], group_key(F.col(host)).alias("host_"), digest(F.col(text)).alias("digest_"),
        split_words(F.col(text), SPACE).alias("words_"), t.alias("text_"),
    ).withColumn("lines_", F.filter(F.split("text_", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    normal = F.transform("lines_", _normal)
    return materialize(rows.select(
        *keep, "host_", "digest_",
        F.size("words_").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text_", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text_") - F.length(F.translate("text_", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words_")).alias("n_repeat_words"),
        F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("chars"))).alias("lines_"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))),
        "quality")


def boilerplate(found, max_documents=MAX_DOCUMENTS):
    """(host_, line) of the lines above the limit. Every step combines before it shuffles."""
    texts = found.dropDuplicates(["host_", "digest_"])
    return (
        texts.select("host_", F.explode(F.array_distinct("lines_.line")).alias("line"))
        .groupBy("host_", "line").agg(F.count("*").alias("texts"))
        .where(F.col("texts") > max_documents)
        .select("host_", "line")
    )


def depleted(found, max_documents=MAX_DOCUMENTS, min_left=MIN_LEFT):
    """(host_, digest_) of the texts that lose too much with their boilerplate lines."""
    frequent = materialize(boilerplate(found, max_documents), "boilerplate")
    texts = found.dropDuplicates(["host_", "digest_"])
    lines = texts.select("host_", "digest_", F.inline("lines_")).groupBy("host_", "digest_", "line").agg(
        F.sum("chars").alias("chars"))
    lost = lines.join(frequent, ["host_", "line"], "left_semi").groupBy("host_", "digest_").agg(F.sum("chars").alias("lost"))
    total = texts.select("host_", "digest_", F.aggregate("lines_.chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"))
    return lost.join(total, ["host_", "digest_"]).where(
        100 * (F.col("chars") - F.col("lost")) < min_left * F.col("chars")
    ).select("host_", "digest_")


def judge(docs, text="text", host="source", keep=("doc_id",), max_documents=MAX_DOCUMENTS, min_left=MIN_LEFT):
    """`keep` columns, the base figures, `base_failed`, `depleted` and `kept` of every row."""
    found = facts(docs, text, host, keep)
    poor = depleted(found, max_documents, min_left).withColumn("depleted", F.lit(True))
    return found.join(poor, ["host_", "digest_"], "left").select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("depleted", F.lit(False)).alias("depleted"),
    ).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def keep_good(docs, text="text", host="source", max_documents=MAX_DOCUMENTS, min_left=MIN_LEFT):
    """The rows of `docs` that pass, with their own columns."""
    found = facts(docs, text, host)
    bad = materialize(
        found.where("base_failed").select("host_", "digest_")
        .union(depleted(found, max_documents, min_left)).distinct(), "rejected")
    keys = bad.select(F.struct("host_", "digest_").alias("key"))
    own = docs.select(F.struct("*").alias("row"))
    key = F.struct(group_key(F.col(f"row.{host}")).alias("host_"), digest(F.col(f"row.{text}")).alias("digest_"))
    # Whole rows move once at every size; rejected texts grow with the rows, so they are not broadcast.
    return own.withColumn("key", key).join(keys.hint("merge"), "key", "left_anti").select("row.*")


def strip_boilerplate(docs, text="text", host="source", max_documents=MAX_DOCUMENTS):
    """The rows of `docs` with the boilerplate lines cut from their texts; null stays null."""
    found = facts(docs, text, host)
    frequent = materialize(boilerplate(found, max_documents), "boilerplate")
    cuts = found.dropDuplicates(["host_", "digest_"]).select("host_", "digest_", F.explode("lines_.line").alias("line"))
    cuts = cuts.join(frequent, ["host_", "line"], "left_semi").groupBy("host_", "digest_").agg(
        F.collect_set("line").alias("cuts")).select(F.struct("host_", "digest_").alias("key"), "cuts")
    own = docs.select(F.struct("*").alias("row")).withColumn(
        "key", F.struct(group_key(F.col(f"row.{host}")).alias("host_"), digest(F.col(f"row.{text}")).alias("digest_")))
    left = F.array_join(F.filter(
        F.split(F.col(f"row.{text}"), "\n"), lambda x: ~F.array_contains(F.col("cuts"), _line_hash(x))), "\n")
    return own.join(cuts, "key", "left").withColumn("left", F.when(F.col("cuts").isNull(), F.col(f"row.{text}")).otherwise(left)).select(
        *[F.col("left" if c == text else f"row.`{c}`").alias(c) for c in docs.columns])
