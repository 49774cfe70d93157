r"""Chat formatting of typed content parts, with DataFrame functions only.

A turn has a role and an ordered array of parts, each of a kind: text, image, audio or document. A visitor over the array
gives every kind its own rendering: text is escaped, the others become an ordered placeholder ``<kind turn.part>`` and an entry
in ``attachments`` with the reference and the tokens the part expands to. A turn is written as

    <turn role=ROLE>\nBODY</turn>\n

Inside roles and texts the characters ``\``, ``<`` and ``>`` become ``\s``, ``\l`` and ``\g``. No text can therefore hold a marker,
and ``read_back`` recovers roles, texts and the text under the loss mask from the output alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import text_or_empty

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
#: Tokens that one unit of a part expands to; units are patches, seconds and pages.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}
TURN_END = "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """One text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text_or_empty(text).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("bigint").alias("units")))


def visit(part: Column, turn: Column, i: Column) -> Column:
    """The rendering of one part; an unknown or null kind that carries text is text."""
    media = part["kind"].isin(*TOKENS_PER_UNIT)
    return F.when(media, F.concat(F.lit("<"), part["kind"], F.lit(" "), turn.cast("string"), F.lit("."), i.cast("string"), F.lit(">"))).otherwise(escape(text_or_empty(part["text"])))


def attachment(part: Column, turn: Column, i: Column) -> Column:
    per = F.coalesce(*[F.when(part["kind"] == k, F.lit(v)) for k, v in TOKENS_PER_UNIT.items()], F.lit(0))
    return F.struct(turn.cast("int").alias("turn"), i.alias("part"), part["kind"].alias("kind"), part["ref"].alias("ref"), (F.coalesce(part["units"], F.lit(0)) * per).alias("n_tokens"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str | None = "text", parts_col: str | None = None, train_on: str = "assistant") -> DataFrame:
    """One row per conversation: conv_col, n_turns, formatted, loss_spans (code points, end exclusive), attachments.

    Turns are ordered by turn_col (nulls first), ties by role and then by rendering; repeated rows are turns of their own. A null
    text or role is empty. Rows with a null conversation form one of their own. An empty table gives no rows.
    """
    parts = F.coalesce(turns[parts_col], F.array().cast(f"array<{PART}>")) if parts_col else text_parts(turns[text_col])
    rows = turns.select(turns[conv_col].alias("_c"), turns[turn_col].alias("_k"), text_or_empty(turns[role_col]).alias("_role"), parts.alias("_parts"))
    order = Window.partitionBy("_c").orderBy("_k", "_role", "_parts")
    rows = rows.withColumn("_i", F.row_number().over(order) - 1)
    body = F.array_join(F.transform("_parts", lambda p, i: visit(p, F.col("_i"), i)), "")
    rows = rows.select(
        "_c", "_i", "_role", F.concat(F.lit("<turn role="), escape(F.col("_role")), F.lit(">\n")).alias("_head"), body.alias("_body"),
        F.transform(F.filter(F.transform("_parts", lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["p"]["kind"].isin(*TOKENS_PER_UNIT)), lambda x: attachment(x["p"], F.col("_i"), x["i"])).alias("_att"),
    )
    length = F.char_length("_head") + F.char_length("_body") + len(TURN_END)
    end = F.sum(length.cast("long")).over(Window.partitionBy("_c").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)) - len(TURN_END)
    rows = rows.withColumn("_end", end)
    turn = F.struct("_i", F.concat("_head", "_body", F.lit(TURN_END)).alias("s"), "_att", (F.col("_end") - F.char_length("_body")).alias("a"), F.col("_end").alias("b"), (F.col("_role") == train_on).alias("on"))
    return (
        rows.groupBy("_c").agg(F.array_sort(F.collect_list(turn)).alias("_t"))
        .select(
            F.col("_c").alias(conv_col), F.size("_t").cast("long").alias("n_turns"), F.array_join(F.col("_t.s"), "").alias("formatted"),
            F.transform(F.filter("_t", lambda t: t["on"]), lambda t: F.struct(t["a"].alias("start"), t["b"].alias("end"))).alias("loss_spans"),
            F.flatten(F.col("_t._att")).alias("attachments"),
        )
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of an output, placeholders left out."""
    pieces = F.split(formatted, TURN_END)
    head = F.lit("<turn role=")

    def parse(x: Column) -> Column:
        role = F.regexp_extract(x, r"^<turn role=([^>]*)>\n", 1)
        body = F.substr(x, F.char_length(head) + F.char_length(role) + 3)
        return F.struct(unescape(role).alias("role"), unescape(F.regexp_replace(body, r"<[^>]*>", "")).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parse)


def loss_text(formatted: Column, spans: Column) -> Column:
    """What lies under the loss mask of an output, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.regexp_replace(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), r"<[^>]*>", ""))), "")
