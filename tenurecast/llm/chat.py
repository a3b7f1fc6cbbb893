r"""Chat formatting with typed content parts, in Spark expressions only.

A turn's content is an array of parts ``struct<type, text, ref, size>``. A visitor goes
through them in order: text is escaped, an image, audio clip or document becomes a numbered
placeholder whose reference is recorded with the tokens it will expand to. Turns are written

    ### role:
    content
    </turn>

Control strings inside texts and roles get a backslash before them, as do backslashes, so
every conversation can be read back exactly. The loss mask holds the places (code points) of
the assistant's contents.

Turns are ordered by number, equal numbers by role and text; repeated rows are turns of
their own. Null role, text or parts count as empty; rows with a null id form one
conversation. An unknown type of part is shown as a placeholder of its own name and expands
to no tokens. An empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import table
from tenurecast.llm.quality import let
from tenurecast.llm.secrets import running_total

PART = "struct<type:string,text:string,ref:string,size:bigint>"
#: Tokens that one unit of size (image, second of audio, page) expands to.
TOKENS = {"image": 576, "audio": 25, "document": 700}
ASSISTANT = "assistant"

# The control strings of the template.
OPEN, HEAD_END, CLOSE = "### ", ":\n", "\n</turn>\n"
_CONTROL = r"\\|</turn>|###|<\|"
_LINE = "<|line|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"({_CONTROL})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({_CONTROL})", "$1")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(_LINE))


def unescaped_role(role: Column) -> Column:
    # A line mark counts after an even number of backslashes only.
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)<\|line\|>", "$1\n"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    null = F.lit(None).cast("string")
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), null.alias("ref"), F.lit(None).cast("bigint").alias("size"))
    return F.array(part)


def visit(parts: Column) -> Column:
    """The flattened content and its attachments, in order."""

    def of(parts: Column) -> Column:
        others = F.filter(parts, lambda p: p["type"] != "text")
        body = F.transform(
            parts,
            lambda p, i: F.when(p["type"] == "text", escaped(F.coalesce(p["text"], F.lit("")))).otherwise(
                F.concat(F.lit("<|"), escaped_role(p["type"]), F.lit(" "), _number(parts, i).cast("string"), F.lit("|>"))
            ),
        )
        tokens = F.create_map(*[F.lit(x) for pair in TOKENS.items() for x in pair])
        attachments = F.transform(
            others,
            lambda p, i: F.struct(
                i.alias("number"),
                p["type"].alias("type"),
                p["ref"].alias("ref"),
                (F.coalesce(tokens[p["type"]], F.lit(0)) * F.coalesce(p["size"], F.lit(1))).cast("bigint").alias("tokens"),
            ),
        )
        return F.struct(F.array_join(body, "").alias("body"), attachments.alias("attachments"))

    typed = F.transform(
        F.coalesce(parts, F.array().cast(f"array<{PART}>")),
        lambda p: F.struct(F.coalesce(p["type"], F.lit("unknown")).alias("type"), p["text"].alias("text"), p["ref"].alias("ref"), p["size"].alias("size")),
    )
    return let(typed, of)


def _number(parts: Column, at: Column) -> Column:
    """How many attachments stand before place ``at``."""
    return F.size(F.filter(F.slice(parts, 1, at), lambda p: p["type"] != "text"))


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts): the formatted text,
    the loss mask, the attachments and the tokens they expand to."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("content"))
    rows = rows.select("conv_id", F.struct("turn", "role", F.col("content.body").alias("body"), F.col("content.attachments").alias("attachments")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    written = ordered.select(
        "conv_id",
        "turns",
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit(HEAD_END))).alias("heads"),
    )
    size = lambda t, i: F.length(F.get("heads", i)) + F.length(t["body"]) + len(CLOSE)
    measured = written.withColumn("ends", running_total(F.transform("turns", lambda t, i: size(t, i).cast("long"))))
    place = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            (F.get("ends", i) - len(CLOSE) - F.length(t["body"])).alias("start"),
            (F.get("ends", i) - len(CLOSE)).alias("end"),
        ),
    )
    loss = F.transform(F.filter(place, lambda p: p["role"] == ASSISTANT), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(i.alias("turn"), a["number"].alias("number"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    text = F.array_join(F.transform("turns", lambda t, i: F.concat(F.get("heads", i), t["body"], F.lit(CLOSE))), "")
    return measured.select(
        "conv_id",
        text.alias("formatted"),
        loss.alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def read_chat(formatted: Column) -> Column:
    """Role and text of every turn of a formatted conversation of text parts."""

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        role = F.substring(head, len(OPEN) + 1, F.length(head) - len(OPEN) - 1)
        body = F.substring(segment, F.length(head) + 2, F.length(segment))
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    return let(F.split(formatted, CLOSE, -1), lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), turn))


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda p: unescaped(F.substring(formatted, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["conv_id", "turn", "role", "text"]
    said = r"\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise(ASSISTANT)
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select(*names).unionByName(extra)
    chats = format_chat(turns.withColumn("parts", text_part(F.coalesce("text", F.lit("")))))
    back = chats.select(
        "conv_id",
        read_chat(F.col("formatted")).alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("loss")), "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP6_SQL = r"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w as (
    select *, length(regexp_replace(role, '(\\|</turn>|###|<\|)', '\\\1', 'g')) + 7 * (length(role) - length(replace(role, chr(10), '')))
        + length(regexp_replace(text, '(\\|</turn>|###|<\|)', '\\\1', 'g')) + 15 as size
    from t
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(size)::bigint as formatted_chars
from w group by conv_id
"""
