"""Heterogeneous chat records as canonical turns, and canonical turns as training text.

A record is a JSON object. Its nested field paths (``messages[].role``) are read off the schema of its variant
value, without types, and hashed; the hash selects a declarative mapping, which names where the turns lie. A record
of an unknown shape keeps its row, with null turns.

The template sets ``<|role|>`` + newline before each text and ``<|end|>`` + newline after it. Inside texts and roles
backslash, ``<`` and ``[`` are spelled ``\\b``, ``\\l`` and ``\\o``, so that no control string of this or another
template can occur there; in roles ``|`` is spelled ``\\p`` too. The spelling is undone on reading.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import compute_once
from .common import keeps_columns, without

TURNS = "array<struct<role:string,text:string>>"
END = "<|end|>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("|", "\\p"))
LEARNED = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Where a record holds its turns.

    ``like`` is an example record: its field paths are the fingerprint. Either ``items`` is the path of a list with a
    role and a text field, or ``fields`` are (path, role) pairs in order.
    """

    name: str
    like: str
    items: str | None = None
    role: str = "role"
    text: str = "content"
    rename: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()

    def turns(self, value: Column) -> Column:
        def get(path: str, kind: str = "string") -> Column:
            return F.variant_get(value, f"$.{path}", kind)

        if self.items is None:
            return F.array(*[F.struct(F.lit(role).alias("role"), F.coalesce(get(path), F.lit("")).alias("text")) for path, role in self.fields])

        def turn(x: Column) -> Column:
            role = x[self.role]
            for old, new in self.rename:
                role = F.when(x[self.role] == old, new).otherwise(role)
            return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(x[self.text], F.lit("")).alias("text"))

        return F.transform(get(self.items, f"array<struct<{self.role}:string,{self.text}:string>>"), turn)


MAPPINGS = (
    Mapping("messages", '{"messages":[{"role":"a","content":"b"}]}', items="messages"),
    Mapping("sharegpt", '{"conversations":[{"from":"a","value":"b"}]}', items="conversations", role="from", text="value",
            rename=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt", '{"prompt":"a","completion":"b"}', fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", '{"instruction":"a","input":"b","output":"c"}',
            fields=(("instruction", "system"), ("input", "user"), ("output", "assistant"))),
)


def fingerprint(value: Column) -> Column:
    """Hash of the nested field paths of a variant; field order, types and nulls do not matter."""
    shape = F.regexp_replace(F.schema_of_variant(value), r":\s*(?!ARRAY<|OBJECT<)[A-Z]+(\([0-9, ]*\))?", "")
    return F.xxhash64(shape)


@keeps_columns("record")
def canonical_turns(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``layout`` (name of the mapping) and ``turns``.

    A null record, broken JSON and an unknown shape give null in both. A null text or role reads as empty. Columns of
    these names are replaced, all others stay; repeated rows stay repeated.
    """
    step = compute_once(without(df, "layout", "turns"), _v=F.try_parse_json(F.col(record)))
    step = compute_once(step, _f=fingerprint(F.col("_v")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        hit = F.col("_f") == fingerprint(F.parse_json(F.lit(m.like)))
        layout, turns = F.when(hit, m.name).otherwise(layout), F.when(hit, m.turns(F.col("_v"))).otherwise(turns)
    return compute_once(step, layout=layout, turns=turns).drop("_v", "_f")


def escape(text: Column, role: bool = False) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES if role else ESCAPES[:3], text)


def unescape(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


@keeps_columns("turns")
def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (start and length in code points of every assistant text).

    Null turns give nulls; no turns give an empty text. Columns of these names are replaced.
    """
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit("<|"), escape(t["role"], True), F.lit("|>\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == LEARNED).alias("learned")))
    step = compute_once(without(df, "formatted", "loss_spans"), _parts=parts)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,learned:boolean>>").alias("spans"))

    def add(a: Column, p: Column) -> Column:
        first = a["at"] + F.length(p["head"])
        span = F.struct(first.alias("start"), F.length(p["body"]).alias("length"), p["learned"].alias("learned"))
        return F.struct((first + F.length(p["body"]) + len(END)).alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate("_parts", start, add)["spans"]
    return step.withColumns({
        "formatted": F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""),
        "loss_spans": F.transform(F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"], s["length"])),
    }).drop("_parts")


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    def turn(piece: Column) -> Column:
        mark = F.instr(piece, "|>\n")
        role, text = F.substring(piece, F.lit(3), mark - 3), F.substring(piece, mark + 3, F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    pieces = F.split(formatted, F.lit(r"\Q" + END + r"\E"), -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """What lies under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(spans, lambda s: F.substring(formatted, s["start"] + 1, s["length"])), ""))


def records(conversations: DataFrame) -> DataFrame:
    """conv_id and one JSON record per conversation, rows by turn (ties by role and text), null text as empty.

    The layout follows from the roles: prompt for user, assistant; instruction for system, user, assistant; the
    ``from``/``value`` list for other conversations that start with a user; the message list for the rest. One
    conversation is one row, as its text has to be.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = compute_once(conversations.groupBy("conv_id").agg(F.collect_list(turn).alias("_t")), _t=F.array_sort("_t"))
    grouped = compute_once(grouped, _roles=F.array_join(F.transform("_t", lambda t: t["role"]), ","))
    at = [F.get("_t", i)["text"] for i in range(3)]
    human = F.transform("_t", lambda t: F.struct(
        F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["text"].alias("value")))
    plain = F.transform("_t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    named = F.col("_roles").rlike("(^|,)(human|gpt)(,|$)")
    record = (
        F.when((F.size("_t") == 2) & (F.col("_roles") == "user,assistant"), F.to_json(F.struct(at[0].alias("prompt"), at[1].alias("completion"))))
        .when((F.size("_t") == 3) & (F.col("_roles") == "system,user,assistant"),
              F.to_json(F.struct(at[0].alias("instruction"), at[1].alias("input"), at[2].alias("output"))))
        .when((F.get("_t", 0)["role"] == "user") & ~named, F.to_json(F.struct(human.alias("conversations"))))
        .otherwise(F.to_json(F.struct(plain.alias("messages")))))
    return grouped.select("conv_id", record.alias("record"))


def control_conversation(conversations: DataFrame) -> DataFrame:
    """Conversation -7: a user and an assistant whose texts are control strings of templates."""
    two = conversations.sparkSession.range(2)
    return two.select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                      F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, layout, formatted and loss_spans of every conversation."""
    turned = canonical_turns(records(conversations))
    return format_turns(turned).select("conv_id", "layout", "formatted", "loss_spans")


def digest_formatted(df: DataFrame) -> DataFrame:
    """What reading ``formatted`` back gives: number and digest of the turns, length and digest of the loss text."""
    step = compute_once(df, _turns=parse_turns(F.col("formatted")), _loss=loss_text(F.col("formatted"), F.col("loss_spans")))
    lines = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return step.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout")
