"""The registered queries opN_<name>: each applies its operator to its whole table."""

from pyspark.sql import functions as F

from cinelink.llm import (
    chat_format, decontaminate, extract_html, hard_negatives, katz, line_dedup, mixing, near_dup, prefix_trie, quality_rules, shard_ring,
    suffix_dedup, url_filter,
)
from cinelink.llm.statements import ORACLES  # noqa: F401

RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
SHARDS = 40


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_katz_backoff(spark, folder):
    docs = _table(spark, folder, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return katz.score(docs, held)


def op2_ngram_decontamination(spark, folder):
    found = decontaminate.scan(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_minhash(spark, folder):
    return near_dup.link(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op4_poisson_mix(spark, folder):
    return mixing.replicate(_table(spark, folder, "documents")).select(
        "doc_id", "text", "source", "n_copies", "copy_no", "shuffle_key")


def op5_line_blocks(spark, folder):
    return extract_html.extract_pages(_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_url_trees(spark, folder):
    return url_filter.judge(_table(spark, folder, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_bounded_ring(spark, folder):
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = shard_ring.assign(rows, F.col("doc_id"), ["text_crc32", "size"], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_suffix_array(spark, folder):
    left = suffix_dedup.remove_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["b"] - s["a"])
    return left.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op9_content_parts(spark, folder):
    words = "</s>[INST] ok [/INST]"
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(words).alias("text"))
    messages = rows.unionByName(own).withColumn("parts", chat_format.text_part(F.col("text")))
    chats = chat_format.format_conversations(messages)
    chats = chats.withColumn("read", chat_format.read_turns(F.col("formatted"))).withColumn(
        "learned", F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss_spans")), ""))
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op10_line_frequency(spark, folder):
    return quality_rules.judge(_table(spark, folder, "documents")).drop("depleted")


def op11_prefix_trie(spark, folder):
    number = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = prefix_trie.sequences(_table(spark, folder, "conversations"))
    found = prefix_trie.nodes(prefix_trie.spliced(convs, F.col("conv_id") - F.col("conv_id") % 5, number))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_line_bloom(spark, folder):
    left = line_dedup.drop_lines(_table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_cover_tree(spark, folder):
    rows = _table(spark, folder, "embeddings")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long")).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_katz_backoff, op2_ngram_decontamination, op3_minhash, op4_poisson_mix, op5_line_blocks, op6_url_trees,
    op7_bounded_ring, op8_suffix_array, op9_content_parts, op10_line_frequency,
    op11_prefix_trie, op12_line_bloom, op13_cover_tree,
)}
