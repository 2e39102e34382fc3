"""Mixing sources to target weights: Poisson replication.

A source with share s of all characters and target weight w gets the repetition rate
w / s, so that the mix keeps the size of the input. Every document draws a uniform number
from a hash of the seed and its id, inverts the Poisson distribution with its source's rate
as mean, is repeated that often, and the copies are dealt out and ordered by a hash of seed,
id and copy number: a global shuffle that any task can repeat.

Defined results: a null source is a source of its own; sources without a weight share what
the given weights leave, equally (by default all sources weigh the same); a source without
characters has rate 1; a null id hashes like the empty text, and rows with the same id are
drawn alike; an empty table gives no rows; other columns pass through, and where one has the
name of an added column, the added one is called n_copies_2 and so on.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cinelink.llm.texts import free_name, group_key, text_or_empty
from cinelink.runtime import materialize

SEED = "mix-1"
BITS = 52


def uniform(*parts):
    """A number in [0, 1) from the hash of the parts, with 52 bits."""
    head = F.substring(F.md5(F.concat_ws(":", *parts)), 1, BITS // 4)
    return F.conv(head, 16, 10).cast("long") / F.lit(float(1 << BITS))


def rates(docs, weights=None, source="source", text="text"):
    """(source_, chars, weight, rate) of every source. One combined aggregation."""
    sizes = docs.groupBy(group_key(F.col(source)).alias("source_")).agg(F.sum(F.length(text_or_empty(F.col(text)))).alias("chars"))
    weights = {("=" + k if k is not None else ""): float(v) for k, v in (weights or {}).items()}
    given = F.lit(None).cast("double")
    for name, weight in weights.items():
        given = F.when(F.col("source_") == name, F.lit(weight)).otherwise(given)
    everything = Window.partitionBy(F.lit(1))  # one row per source
    rest = F.lit(max(0.0, 1.0 - sum(weights.values())))
    sizes = sizes.withColumn("given", given).withColumn("open", F.sum(F.when(F.col("given").isNull(), 1).otherwise(0)).over(everything))
    sizes = sizes.withColumn("weight", F.coalesce("given", rest / F.col("open"))).withColumn("total", F.sum("chars").over(everything))
    rate = F.when(F.col("chars") > 0, F.col("weight") * F.col("total") / F.col("chars")).otherwise(F.lit(1.0))
    return sizes.select("source_", "chars", "weight", rate.alias("rate"))


def thresholds(rated):
    """(source_, cdf): the distribution function at 0, 1, 2, ... up to where it is 1 in doubles."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    # In logarithms, so that large rates do not underflow.
    terms = rated.select("source_", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    log_factorial = F.sum(F.when(F.col("k") > 0, F.ln(F.col("k").cast("double"))).otherwise(F.lit(0.0))).over(
        Window.partitionBy("source_").orderBy("k"))
    log_rate = F.when(F.col("rate") > 0, F.ln("rate")).otherwise(F.lit(0.0))
    pmf = F.when(F.col("rate") > 0, F.exp(F.col("k") * log_rate - F.col("rate") - log_factorial)).otherwise(
        F.when(F.col("k") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    cdf = terms.withColumn("p", pmf).withColumn("cdf", F.sum("p").over(Window.partitionBy("source_").orderBy("k")))
    return cdf.groupBy("source_").agg(F.sort_array(F.collect_list("cdf")).alias("cdf"))


def replicate(docs, weights=None, doc_id="doc_id", source="source", text="text", seed=SEED):
    """Every column of `docs` with n_copies, copy_no (from 0) and shuffle_key, in shuffled order."""
    rated = materialize(rates(docs, weights, source, text), "rates")
    table = materialize(thresholds(rated), "thresholds")
    ident = text_or_empty(F.col(f"row.{doc_id}"))
    drawn = docs.select(F.struct("*").alias("row")).withColumn("source_", group_key(F.col(f"row.{source}"))).withColumn(
        "u", uniform(F.lit(seed), ident))
    counted = drawn.join(table, "source_").withColumn(
        "n_copies", F.size(F.filter("cdf", lambda c: F.col("u") >= c)))
    copies = counted.where("n_copies > 0").select(
        "row", "n_copies", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy_no"))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), ident, F.col("copy_no").cast("string"))))
    mixed = copies.repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")
    added = [F.col(c).alias(free_name(docs.columns, c)) for c in ("n_copies", "copy_no", "shuffle_key")]
    return mixed.select("row.*", *added)
