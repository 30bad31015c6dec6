"""Chat formatting: records of different layouts to canonical turns, and turns to training text and back.

A record is a JSON object. The paths of its fields, whatever their types, are hashed to its schema fingerprint, which
selects a declarative mapping: where the turns are, and what the fields and roles are called there. A record whose
fingerprint no mapping has, gets no turns and its fingerprint, so that a mapping can be added.

A turn is written as `### role`, line break, text, `</turn>`, line break. Inside texts and roles, backslash, `###` and
`</turn>` are written as `\\b`, `\\h` and `\\t` (and a line break in a role as `\\n`), so markers never occur there and
every backslash says what it stands for; undoing that in the order h, t, n, b gives the text back. The loss mask holds,
for each turn of an assistant, where its text starts and how long it is.

Nulls and odd input: a null text or role is empty; a null turn sorts first; ties in turn sort by role and text; rows
that repeat are turns that repeat; rows with a null conv_id are one conversation. An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "### ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
LEARNED_ROLE = "assistant"

# The layouts that are known. `many`: path of an array of turns, with the names of role and text in it;
# `fields`: one text field per turn, in order, with the turn's role; empty ones are left out.
LAYOUTS = {
    "messages": {"many": ("messages", "role", "content"), "with": ["messages", "messages[].content", "messages[].role"]},
    "share": {"many": ("conversations", "from", "value"), "with": ["conversations", "conversations[].from", "conversations[].value"]},
    "prompt_response": {"fields": [("prompt", "user"), ("response", "assistant")], "with": ["prompt", "response"]},
    "prompt_completion": {"fields": [("prompt", "user"), ("completion", "assistant")], "with": ["completion", "prompt"]},
    "question_answer": {"fields": [("question", "user"), ("answer", "assistant")], "with": ["answer", "question"]},
    "system_prompt_response": {"fields": [("system", "system"), ("prompt", "user"), ("response", "assistant")],
                               "with": ["prompt", "response", "system"]},
    "instruction": {"fields": [("instruction", "user"), ("output", "assistant")], "with": ["instruction", "output"]},
    "instruction_input": {"fields": [("instruction", "user"), ("input", "user"), ("output", "assistant")],
                          "with": ["input", "instruction", "output"]},
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

_TURNS = "array<struct<role string, text string>>"


def schema_text(paths: list[str]) -> str:
    """The shape that `shape` finds in a record with these paths."""
    tops = [p for p in paths if "[" not in p]
    inner = {t: [p.split("[].")[1] for p in paths if p.startswith(f"{t}[].")] for t in tops}
    return "OBJECT<" + ",".join(f"{t}:ARRAY<OBJECT<{','.join(f'{x}:' for x in inner[t])}>>" if inner[t] else f"{t}:" for t in tops) + ">"


def shape(record: Column) -> Column:
    """The nested field paths of a JSON text: its schema without the types of its values.

    Contents of strings, and objects that repeat the shape of the one before, are left out first, as the parser for
    unknown layouts takes a limited size. Possessive groups, which need no stack however long a string is.
    """
    bare = F.regexp_replace(record, r':\s*"(?:[^"\\]++|\\.)*+"', ':""')
    bare = F.regexp_replace(bare, r"(\{[^{}]*+\})(?:\s*+,\s*+\1)++", "$1")
    schema = F.schema_of_variant(F.try_parse_json(bare))
    return F.regexp_replace(F.regexp_replace(schema, " ", ""), r":(STRING|VOID|BIGINT|DOUBLE|BOOLEAN|DECIMAL\([0-9,]*\))", ":")


def turns_of(records: DataFrame) -> DataFrame:
    """conv_id, fingerprint, layout, turns (array of struct(role, text)) of rows (conv_id, record), records in JSON."""
    known = records.select("conv_id", "record", F.xxhash64(shape(F.col("record"))).alias("fingerprint"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for name, spec in LAYOUTS.items():
        hit = F.col("fingerprint") == F.xxhash64(F.lit(schema_text(spec["with"])))
        if "many" in spec:
            at, role, text = spec["many"]
            found = F.from_json("record", f"`{at}` array<struct<`{role}` string, `{text}` string>>")[at]
            found = F.transform(found, _turn(role, text))
        else:
            fields = F.from_json("record", ", ".join(f"`{path}` string" for path, _ in spec["fields"]))
            each = F.array(*[F.struct(F.lit(role).alias("role"), fields[path].alias("text")) for path, role in spec["fields"]])
            found = F.filter(each, lambda t: F.coalesce(t["text"], F.lit("")) != "")
        layout, turns = F.when(hit, F.lit(name)).otherwise(layout), F.when(hit, found.cast(_TURNS)).otherwise(turns)
    return known.select("conv_id", "fingerprint", layout.alias("layout"), turns.alias("turns"))


def _turn(role: str, text: str) -> Callable[[Column], Column]:
    return lambda t: F.struct(_role(t[role]).alias("role"), F.coalesce(t[text], F.lit("")).alias("text"))


def _role(role: Column) -> Column:
    out = F.coalesce(role, F.lit(""))
    for known, canonical in ROLES.items():
        out = F.when(role == known, F.lit(canonical)).otherwise(out)
    return out


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, mask: one text per conversation from rows (conv_id, turns).

    The mask has an entry per turn: struct(at, length), where in the turn's piece the learned text is; null for others.
    """
    def piece(turn: Column) -> Column:
        return F.concat(F.lit(START), F.replace(escape(turn["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"), escape(turn["text"]))

    def mask(turn: Column) -> Column:
        length = F.length(escape(turn["text"]))
        return F.when(turn["role"] == LEARNED_ROLE, F.struct(
            (F.length(piece(turn)) - length + 1).alias("at"), length.alias("length")))

    pieces = F.transform("turns", piece)
    return conversations.select(
        "conv_id", F.concat(F.array_join(pieces, END), F.lit(END)).alias("formatted"), F.transform("turns", mask).alias("mask"))


def read_back(texts: DataFrame) -> DataFrame:
    """conv_id, turns (array of struct(role, text)), learned (text under the mask), from formatted text and mask."""
    pieces = texts.withColumn("pieces", F.split("formatted", END.replace("\n", "\\n")))
    pieces = pieces.withColumn("pieces", F.filter("pieces", lambda p: p != ""))
    turns = F.transform("pieces", lambda p: F.struct(
        unescape(F.replace(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1), F.lit("\\n"), F.lit("\n"))).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))
    learned = F.zip_with("pieces", "mask", lambda p, m: F.when(m.isNotNull(), unescape(F.substr(p, m["at"], m["length"]))))
    return pieces.select(
        "conv_id", turns.alias("turns"), F.array_join(F.array_compact(learned), "").alias("learned"), F.length("formatted").alias("formatted_chars"))


def conversation_records(rows: DataFrame) -> DataFrame:
    """conv_id, record: conversations as JSON records, in the layout that fits: pairs as prompt and response, others as
    lists of messages."""
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")))).alias("t"))
    pair = (F.size("t") == 2) & (F.col("t")[0]["role"] == "user") & (F.col("t")[1]["role"] == "assistant") & (
        F.col("t")[0]["content"] != "") & (F.col("t")[1]["content"] != "")
    messages = F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages")))
    return ordered.select("conv_id", F.when(pair, F.to_json(F.struct(
        F.col("t")[0]["content"].alias("prompt"), F.col("t")[1]["content"].alias("response")))).otherwise(messages).alias("record"))
