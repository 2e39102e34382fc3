"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule is host and path; it fits a url whose host is the rule's or a subdomain of it and
whose path starts with the rule's. The longest rule that fits decides. Urls that rules
decide are the labelled urls; trees fitted on them judge the others by length, depth, digit
ratio, entropy, parameter counts and what the labels say about host and file suffixes. The
first folder, which rules go by, is no feature: trees would only repeat the rules.

Half of the labelled urls, by hash, are counted for the suffix statistics, each once; trees learn from
the other half, so no url meets its own label in a feature. The fit takes at most `max_train` different
urls of that half, those with the smallest hashes. Every url is judged.

Defined results: null urls and urls without `://` have empty host and path, fit no rule and
are judged by their features; without labels of both kinds to learn from the verdict is the one label,
or allow when there is none; repeated urls get the same verdict each; an empty table gives no
rows; other columns are not looked at.
"""

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cinelink.llm.texts import ascii_lower, hot_splits, text_or_empty
from cinelink.runtime import materialize, skew_join

MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 20, 4, 7
PRIOR = 8.0  # urls that a suffix statistic starts with, at the common rate
FEATURES = [
    "length", "host_length", "path_length", "depth", "labels", "digits", "letters", "dashes", "entropy", "parameters",
    "query_length", "fragment", "secure", "longest_word", "suffix_rate", "suffix_share", "file_rate",
]


def host_of(url):
    rest = F.regexp_extract(text_or_empty(url), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url):
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host, path, rules):
    """Struct (rule, verdict) of the longest rule that fits, else nulls. `rules`: (verdict, host, path) each."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text):
    """Bits per character."""
    n = F.length(text)

    def part(c):
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.ln(share) / F.lit(math.log(2))

    each = F.transform(F.array_distinct(F.array_remove(F.split(text, ""), "")), part)
    return F.coalesce(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))


def lexical(urls):
    """Features of the columns url_, host, path that need nothing but the url."""
    url, host, path = F.col("url_"), F.col("host"), F.col("path")

    def count(text, pattern):
        return F.length(F.regexp_replace(text, f"[^{pattern}]", "")).cast("double")

    def share(pattern):
        return F.when(F.length(url) > 0, count(url, pattern) / F.length(url)).otherwise(0.0)

    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    words = F.split(url, "[^A-Za-z]+")
    return urls.withColumns({
        "length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "depth": count(path, "/"), "labels": count(host, "."),
        "digits": share("0-9"), "letters": share("A-Za-z"), "dashes": count(url, "_-"),
        "entropy": _entropy(url), "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "query_length": F.length(query).cast("double"), "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": url.startswith("https:").cast("double"),
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)).cast("double"),
        "suffix": F.substring_index(host, ".", -1),
        "file": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    })


def suffix_counts(urls, column):
    """Per value of `column`: allowed and labelled urls of the counted half, different urls and rows."""
    each = urls.groupBy(F.col(column).alias("value_"), "url_").agg(F.max("label").alias("label_"), F.count("*").alias("n_"))
    each = each.withColumn("label_", F.when(_counted(), F.col("label_")))
    return each.groupBy("value_").agg(
        F.coalesce(F.sum("label_"), F.lit(0.0)).alias("good_"), F.count("label_").alias("known_"),
        F.count("*").alias("urls_"), F.sum("n_").alias("rows_"))


def _counted():
    return F.xxhash64(F.lit("counted"), "url_") % 2 == 0


def with_rates(rows, column):
    """Adds what the counted urls of the same `column` say, drawn to one half while they are few."""
    table = materialize(suffix_counts(rows, column), "rates").withColumnRenamed("value_", column)
    total = table.agg(F.sum("rows_")).first()[0] or 0
    # An empty file suffix may stand on most rows.
    both = skew_join(
        rows, table.drop("rows_"), [column], "left", hot_splits(table, [column], "rows_", total), spread_by=["url_"])
    return both.withColumns({
        f"{column}_rate": (F.col("good_") + PRIOR / 2) / (F.col("known_") + PRIOR), f"{column}_share": F.ln(F.col("urls_") + 1.0),
    }).drop("good_", "known_", "urls_")


def judge(urls, rules, url="url", keep=("page_id",), max_train=MAX_TRAIN, trees=TREES, depth=DEPTH):
    """`keep` columns, host, path, rule, verdict and `score` (share of allow, null under a rule) of every row."""
    rows = urls.select(*keep, text_or_empty(F.col(url)).alias("url_")).withColumns(
        {"host": host_of(F.col("url_")), "path": path_of(F.col("url_"))})
    rows = rows.withColumn("found_", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = lexical(rows).withColumn("label", F.when(F.col("found_.verdict") == "allow", 1.0).when(F.col("found_.verdict") == "block", 0.0))
    rows = materialize(rows, "urls")
    for column in ("suffix", "file"):
        rows = with_rates(rows, column)
    learned = rows.where(F.col("label").isNotNull() & ~_counted())
    kinds = [r["label"] for r in learned.select("label").distinct().collect()]  # at most two
    if len(kinds) < 2:
        only = "allow" if not kinds or kinds[0] == 1.0 else "block"
        return rows.select(*keep, "host", "path", F.col("found_.rule").alias("rule"),
                           F.coalesce("found_.verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    labelled = learned.select("url_", "label", *FEATURES).dropDuplicates(["url_"])
    sample = materialize(labelled.orderBy(F.xxhash64("url_"), "url_").limit(max_train), "labelled")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features_")
    model = GBTClassifier(
        featuresCol="features_", labelCol="label", predictionCol="guess_", maxIter=trees, maxDepth=depth, seed=SEED,
    ).setProbabilityCol("chance_").setRawPredictionCol("raw_").fit(vectors.transform(sample))
    judged = model.transform(vectors.transform(rows))
    allow = F.when(F.col("guess_") == 1.0, "allow").otherwise("block")
    return judged.select(
        *keep, "host", "path", F.col("found_.rule").alias("rule"), F.coalesce("found_.verdict", allow).alias("verdict"),
        F.when(F.col("found_.rule").isNull(), F.get(vector_to_array("chance_"), F.lit(1))).alias("score"))


def keep_allowed(urls, rules, url="url", **options):
    """The rows of `urls` with verdict allow, with their own columns."""
    bad = judge(urls, rules, url, keep=(url,), **options).where("verdict = 'block'").select(text_or_empty(F.col(url)).alias("key")).distinct()
    own = urls.select(F.struct("*").alias("row"))
    return own.withColumn("key", text_or_empty(F.col(f"row.{url}"))).join(materialize(bad, "blocked"), "key", "left_anti").select("row.*")
