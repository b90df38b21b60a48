r"""Chat formatting (12): conversations as one templated text with a loss mask.

Template: adjacent turns of one role make a block

    <turn>ROLE<says>TEXT<and>TEXT</turn>\n

A conversation is its blocks in the order of turns. In roles and texts ``\``
becomes ``\\`` and a ``<`` that would begin a mark becomes ``<\``, so marks
never occur inside texts; ``\c`` read as ``c`` undoes both. The loss mask is a
list of spans, one for each assistant text, in code points and in bytes of the
formatted text; marks are never under it.

Method: the turns of a conversation are collected as structs and sorted; runs of
one role are found by comparing neighbours and cut out of the array, each run's
texts are aggregated into one block, blocks into one text, all by Spark's own
expressions. Span starts are running sums of lengths, folded in chunks of
``FOLD`` so that a long conversation costs no quadratic time. ``read_turns`` and
``read_loss`` know nothing but the formatted text and its spans.

Scale: one shuffle by conversation, lists combined before it. A conversation is
one training example and one output row, hence the unit of work.

Defined cases: a null text or role counts as empty; null turns come first, ties
of a turn stand in the order of role, then text; repeated rows are turns of their
own; rows with a null conv_id make one conversation. Extra columns are ignored.
An empty table gives no conversation (the query still has the planted one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, SAYS, AND, CLOSE = "<turn>", "<says>", "<and>", "</turn>\n"
#: A ``<`` that begins a mark.
MARK = "<(?=/?turn>|says>|and>)"
LOSS_ROLE = "assistant"
#: Lengths added up in one fold.
FOLD = 64
#: The conversation that the query adds (conv_id, role, text): its texts hold the escape character and a mark.
PLANTED = [(-7, "user", "\\### Assistant: </turn> ok"), (-7, "assistant", "\\### Assistant: </turn> ok")]


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(MARK), F.lit("<\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _blocks(turns: Column) -> Column:
    """Runs of one role in a sorted array of (role, text), as an array of (role, texts)."""
    role = lambda i: F.element_at(turns, i)["role"]
    starts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))
    stop = lambda k: F.coalesce(F.get(starts, k + 1), F.size(turns) + 1)
    return F.transform(starts, lambda s, k: F.struct(role(s).alias("role"), F.slice(turns["text"], s, stop(k) - s).alias("texts")))


def _block_text(block: Column) -> Column:
    return F.concat(F.lit(OPEN), block["role"], F.lit(SAYS), F.array_join(block["texts"], AND), F.lit(CLOSE))


def _pieces(blocks: Column) -> Column:
    """For each text in order: characters and bytes of the marks before it and of itself, and whether the loss counts it."""
    begin = len(OPEN) + len(SAYS)

    def of(block, k):
        head = F.when(k > 0, begin + len(CLOSE)).otherwise(begin)
        mark = lambda j, n: F.when(j == 0, head + n).otherwise(len(AND))
        return F.transform(block["texts"], lambda t, j: F.struct(
            mark(j, F.char_length(block["role"])).alias("mark"), F.char_length(t).alias("chars"),
            mark(j, F.octet_length(block["role"])).alias("byte_mark"), F.octet_length(t).alias("bytes"),
            (block["role"] == LOSS_ROLE).alias("loss")))
    return F.flatten(F.transform(blocks, of))


def _running(pieces: Column, mark: str, size: str) -> Column:
    """Where each piece's text starts: sums of all lengths before it, folded chunk by chunk."""
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")

    def fold(values, mark_of, size_of):
        return F.aggregate(values, F.struct(none.alias("at"), zero.alias("sum")), lambda acc, v: F.struct(
            F.concat(acc["at"], F.array(acc["sum"] + mark_of(v))).alias("at"), (acc["sum"] + mark_of(v) + size_of(v)).alias("sum")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / FOLD).cast("int")), lambda c: F.slice(pieces, c * FOLD + 1, F.lit(FOLD)))
    local = F.transform(chunks, lambda c: fold(c, lambda v: v[mark].cast("bigint"), lambda v: v[size].cast("bigint")))
    base = fold(local, lambda v: zero, lambda v: v["sum"])["at"]
    return F.flatten(F.transform(F.arrays_zip(local.alias("local"), base.alias("base")),
                                 lambda z: F.transform(z["local"]["at"], lambda v: v + z["base"])))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): ``loss`` is an array of (start, length, byte_start, byte_length), from 0."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(F.col("turn"), text("role").alias("role"), text("text").alias("text")))).alias("turns"))
    # each step is used several times by the next: separate projections keep it from being evaluated anew
    turns = turns.select("conv_id", F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"))
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    pieces = blocks.select("conv_id", F.array_join(F.transform("blocks", _block_text), "").alias("formatted"), _pieces(F.col("blocks")).alias("pieces"))
    spans = pieces.select("conv_id", "formatted", F.arrays_zip(
        F.col("pieces"), _running(F.col("pieces"), "mark", "chars").alias("start"), _running(F.col("pieces"), "byte_mark", "bytes").alias("byte_start")).alias("spans"))
    loss = F.transform(F.filter("spans", lambda s: s["pieces"]["loss"]), lambda s: F.struct(
        s["start"].alias("start"), s["pieces"]["chars"].alias("length"), s["byte_start"].alias("byte_start"), s["pieces"]["bytes"].alias("byte_length")))
    return spans.select("conv_id", "formatted", loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) parsed from a formatted text, merged turns apart again."""
    blocks = F.split(formatted, CLOSE)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)      # after the last mark nothing follows

    def turns(block):
        parts = F.split(F.substr(block, F.lit(len(OPEN) + 1)), SAYS)
        role = unescape(F.get(parts, F.lit(0)))
        return F.transform(F.split(F.get(parts, F.lit(1)), AND), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    data = formatted.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(data, s["byte_start"].cast("int") + 1, s["byte_length"]).cast("string"))), "")


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(c, i, r, t) for i, (c, r, t) in enumerate(PLANTED)], "conv_id long, turn long, role string, text string")
    out = format_conversations(rows.unionByName(planted))
    read = out.select("conv_id", "formatted", F.size("loss").alias("loss_spans"), read_turns(F.col("formatted")).alias("turns"),
                      read_loss(F.col("formatted"), F.col("loss")).alias("under"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("under").cast("long").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "loss_spans")


_ESCAPED = r"regexp_replace(replace({0}, '\', '\\'), '<(/?turn>|says>|and>)', '<\\\1', 'g')"
ORACLE = f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES {', '.join(f"({c}, {i}, '{r}', '{t}')" for i, (c, r, t) in enumerate(PLANTED))}) v(conv_id, turn, role, text)),
turns AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS last,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM said),
marked AS (SELECT *, CASE WHEN last = role THEN '{AND}' ELSE CASE WHEN place > 1 THEN '{CLOSE.strip()}' || chr(10) ELSE '' END || '{OPEN}'
    || {_ESCAPED.format('role')} || '{SAYS}' END || {_ESCAPED.format('text')} AS piece FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
    (sum(length(piece)) + {len(CLOSE)})::BIGINT AS formatted_chars, (count(*) FILTER (WHERE role = '{LOSS_ROLE}'))::INTEGER AS loss_spans
FROM marked GROUP BY conv_id
"""

QUERIES = {"op12_chat": op12_chat}
ORACLES = {"op12_chat": ORACLE}
