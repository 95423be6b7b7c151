"""Chat formatting: records of different layouts become canonical turns, then one marked text with a loss mask.

A record's layout is told by the fingerprint of its nested field paths; the fingerprint selects a declared mapping.
DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
#: What is escaped in texts, in this order; all control strings of common templates begin with one of the last two.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def skeleton(shape) -> str:
    """The nested field paths of a declared shape (dict, one-element list, None for a value) as a text."""
    if isinstance(shape, dict):
        return "<" + ", ".join(f"{k}: {skeleton(shape[k])}" for k in sorted(shape)) + ">"
    if isinstance(shape, list):
        return "<" + (skeleton(shape[0]) if shape else "") + ">"
    return ""


@dataclass(frozen=True)
class Mapping:
    """How a layout gives turns: a list of messages at ``turns`` (with the names of its role and text), or ``fields`` of a fixed role each.

    ``shapes`` are the field paths that the mapping stands for; ``roles`` renames roles. Absent fields give no turn.
    """

    name: str
    shapes: tuple
    turns: str = ""
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def fingerprints(self) -> list[str]:
        return [hashlib.sha256(skeleton(s).encode()).hexdigest() for s in self.shapes]

    def extract_text(self, record: Column) -> Column:
        """``extract`` from a JSON text; null if it has not the mapping's fields."""
        if self.fields:
            names = list(dict.fromkeys(name for _, name in self.fields))
            got = F.from_json(record, ", ".join(f"`{n}` string" for n in names))
            each = [F.struct(F.lit(role).alias("role"), got[name].alias("text")) for role, name in self.fields]
            some = F.filter(F.array(*each), lambda t: t["text"].isNotNull())
            return F.when(F.size(some) > 0, some)
        got = F.from_json(record, f"`{self.turns}` array<struct<`{self.role}`:string,`{self.text}`:string>>")[self.turns]
        return self._turns(got)

    def _turns(self, got: Column) -> Column:
        renamed = lambda r: F.coalesce(*[F.when(r == a, F.lit(b)) for a, b in self.roles.items()], r, F.lit(""))
        return F.transform(got, lambda m: F.struct(renamed(m[self.role]).alias("role"), F.coalesce(m[self.text], F.lit("")).alias("text")))

    def extract(self, record: Column) -> Column:
        if self.fields:
            each = [F.struct(F.lit(role).alias("role"), F.try_variant_get(record, f"$.{name}", "string").alias("text")) for role, name in self.fields]
            return F.filter(F.array(*each), lambda t: t["text"].isNotNull())
        kind = f"array<struct<`{self.role}`:string,`{self.text}`:string>>"
        return self._turns(F.try_variant_get(record, f"$.{self.turns}", kind))


MAPPINGS = (
    Mapping("messages", ({"messages": [{"role": None, "content": None}]}, {"messages": []}), turns="messages"),
    Mapping("shared", ({"conversations": [{"from": None, "value": None}]}, {"conversations": []}), turns="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt", ({"prompt": None, "response": None}, {"prompt": None, "completion": None}), fields=(("user", "prompt"), ("assistant", "response"), ("assistant", "completion"))),
    Mapping("instruction", ({"instruction": None, "output": None}, {"system": None, "instruction": None, "output": None}, {"instruction": None, "input": None, "output": None}),
            fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def schema_fingerprint(record: Column) -> Column:
    """SHA-256 of the nested field paths of a variant: names and nesting, not the types of values."""
    types = r"(?<=^|<|: )(?:OBJECT|ARRAY|STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|VARIANT|DECIMAL\([0-9, ]*\))(?=<|>|,|$)"
    return F.sha2(F.regexp_replace(F.schema_of_variant(record), types, ""), 256)


def canonical_turns(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Turns (role, text) of a variant record by the mapping of its fingerprint; null if no mapping knows the layout."""
    mark = schema_fingerprint(record)
    chosen = F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        chosen = F.when(mark.isin(m.fingerprints()), m.extract(record).cast(TURNS)).otherwise(chosen)
    return chosen


def escape(text: Column) -> Column:
    for a, b in ESCAPES:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column) -> Column:
    for a, b in reversed(ESCAPES):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


#: Longer records do not fit a variant; they are read with the first mapping that finds its fields.
VARIANT_BYTES = 16 << 20


def format_chats(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS, variant_bytes: int = VARIANT_BYTES) -> DataFrame:
    """``records`` with ``formatted`` and ``segments`` in place of the JSON text column ``record``.

    ``segments`` are (text, loss) pieces whose texts joined are ``formatted``; loss marks what a model learns: the assistant's
    texts, without the marks around them. No control string of a text survives in it (see ``escape``). Malformed JSON
    and unknown layouts give null; a record without turns the empty text. Records over ``variant_bytes`` are not told by their
    fingerprint but by the fields that are found in them.
    """
    turns = F.col("turns_")
    pieces = F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    large = F.octet_length(record) > variant_bytes
    parsed = records.withColumn("record_", F.when(~large, F.try_parse_json(record)))
    parsed = parsed.withColumn("turns_", F.when(large, F.coalesce(*[m.extract_text(F.col(record)) for m in mappings])).otherwise(canonical_turns(F.col("record_"), mappings)))
    out = parsed.withColumn("segments", pieces).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    return out.drop(record, "record_", "turns_")


def parse_turns(formatted: Column) -> Column:
    """Turns read back from a formatted text."""
    parts = F.slice(F.split(formatted, r"<\|start\|>", -1), 2, 1 << 30)
    halves = F.transform(parts, lambda p: F.split(p, r"<\|sep\|>", 2))
    return F.transform(halves, lambda h: F.struct(
        unescape(F.get(h, F.lit(0))).alias("role"), unescape(F.regexp_replace(F.get(h, F.lit(1)), r"<\|end\|>$", "")).alias("text")))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def records_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, record): one JSON record a conversation from rows (conv_id, turn, role, text), in the layout that its shape allows.

    Turns are ordered by turn, then role and text; null turns come first; null roles and texts are empty; repeated rows are
    repeated turns; a null conv_id is one conversation. A conversation becomes one record, and so lies in one task.
    """
    rows = conversations.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    roles = F.transform("ts", lambda t: t["role"])
    is_ = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    text = lambda k: F.get("ts", F.lit(k))["text"]
    plain = F.forall(roles, lambda r: r.isin("user", "assistant"))
    shared = F.transform("ts", lambda t: F.struct(F.when(t["role"] == "user", "human").otherwise("gpt").alias("from"), t["text"].alias("value")))
    messages = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(is_("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(is_("system", "user", "assistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .when(plain, F.to_json(F.struct(shared.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages")))))
    return grouped.select("conv_id", record.alias("record"))
