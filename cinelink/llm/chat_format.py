"""Chat formatting: typed content parts.

A message is a list of parts of type text, image, audio or document. Formatting walks over
the parts in order: a text part is escaped and written out; any other part becomes a
placeholder `<|image:0|>` with its number in the conversation, and is recorded with its
reference, its place in the output and the number of tokens it will expand to.

Template: `<|turn:ROLE|>` CONTENT `<|end|>` per message. Texts and roles are escaped, `&` to
`&amp;`, `<` to `&lt;` and `[` to `&#91;`, so neither this template's marks nor those of
other common templates can come from a text, and `unescape` restores every text exactly.

Loss mask: spans [start, end) in code points of the formatted text that cover the content of
assistant messages, marks excluded.

Defined results: a null text, role or part list is empty; turns are ordered by number, null
first, then role and text; repeated rows are turns of their own; a null conv_id is one
conversation; an empty table gives no rows; other columns are not looked at. One
conversation is one row: its digest needs its turns in order, so it is assumed to fit a row.
"""

from pyspark.sql import functions as F

from cinelink.llm.texts import let, text_or_empty

TURN, MARK, END = "<|turn:", "|>", "<|end|>"
# Tokens a placeholder expands to: tiles of an image, frames of audio, pages of a document.
IMAGE_PATCH, AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 28, 25, 512
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text):
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def unescape(text):
    return F.replace(F.replace(F.replace(text, F.lit("&#91;"), F.lit("[")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_part(text):
    """A list of one text part."""
    null = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("type"), text_or_empty(text).alias("text"), null.cast("string").alias("ref"),
        null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"),
        null.cast("int").alias("pages")).cast(PART))


def expanded_tokens(part):
    """Tokens a part other than text expands to; unknown sizes count as one tile, second or page."""
    def tiles(side):
        return F.greatest(F.ceil(F.coalesce(side, F.lit(1)) / IMAGE_PATCH), F.lit(1))

    return (
        F.when(part["type"] == "image", tiles(part["width"]) * tiles(part["height"]))
        .when(part["type"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(1.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * DOCUMENT_TOKENS_PER_PAGE)
        .otherwise(0).cast("long")
    )


def format_conversations(messages, conv="conv_id", turn="turn", role="role", parts="parts", trained_role="assistant"):
    """One row per conversation: formatted, loss_spans, attachments, expanded_tokens, n_turns."""
    none = F.expr(f"cast(array() as array<{PART}>)")
    turns = messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_or_empty(F.col(role)).alias("role"),
        F.filter(F.coalesce(F.col(parts), none), lambda p: p.isNotNull()).alias("parts"))
    chats = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "parts"))).alias("turns"))

    def media(p):
        return F.coalesce(p["type"], F.lit("text")) != "text"

    media_before = F.aggregate(
        "turns", F.expr("cast(array(0) as array<int>)"),
        lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + F.size(F.filter(t["parts"], media)))))
    chats = chats.withColumn("before", media_before)

    def visit(t, number):
        """Content of one turn: parts in order, placeholders numbered from `number`."""
        return F.array_join(F.transform(t["parts"], lambda p, i: F.when(
            media(p),
            F.concat(F.lit("<|"), escape(p["type"]), F.lit(":"),
                     (number + F.size(F.filter(F.slice(t["parts"], 1, i), media))).cast("string"), F.lit("|>")),
        ).otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "")

    chats = chats.withColumn("pieces", F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(MARK)).alias("open"),
        visit(t, F.get("before", i)).alias("content"))))
    lengths = F.transform("pieces", lambda x: F.struct(
        x["role"].alias("role"), F.length(x["open"]).alias("open"), F.length(x["content"]).alias("content")))
    start = F.expr("struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as spans, cast(array() as array<int>) as starts)")

    def step(a, x):
        begin = a["at"] + x["open"]
        end = begin + x["content"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(x["role"] == trained_role, F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"),
            F.concat(a["starts"], F.array(begin)).alias("starts"))

    chats = chats.withColumn("walk", F.aggregate(lengths, start, step))
    attachments = F.flatten(F.transform("turns", lambda t, k: F.filter(F.transform(t["parts"], lambda p, i: F.struct(
        (F.get("before", k) + F.size(F.filter(F.slice(t["parts"], 1, i), media))).alias("number"),
        F.coalesce(p["type"], F.lit("text")).alias("type"), p["ref"].alias("ref"), k.alias("turn"), i.alias("part"),
        expanded_tokens(p).alias("tokens"))), lambda a: a["type"] != "text")))
    return chats.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["open"], x["content"], F.lit(END))), "").alias("formatted"),
        F.col("walk.spans").alias("loss_spans"),
        attachments.alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
    ).withColumn("expanded_tokens", F.aggregate("attachments.tokens", F.lit(0).cast("long"), lambda a, x: a + x))


def read_turns(formatted):
    """Array of (role, text) read back from a formatted conversation, without placeholders resolved."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")
    return F.transform(pieces, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"(?s)^<\|turn:(.*?)\|>", 1)).alias("role"),
        unescape(F.regexp_replace(x, r"(?s)^<\|turn:.*?\|>", "")).alias("text")))


def read_loss(formatted, spans):
    """The unescaped texts under the loss mask, one per span."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
