"""Chat formatting: layouts told apart by a fingerprint of their field paths, one escaped template.

A layout is declared as field paths and an expression that gives its turns. Records that come as JSON
are told apart row by row, by the digest of their sorted nested paths; a frame whose columns are already
typed by the digest of its schema. The template marks a turn as::

    <|turn|>role
    text<|end|>

Texts and roles are escaped so that no ``<`` or ``[`` of theirs is left, which makes every control string
in the output the template's own, and the escapes can be undone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|turn|>", "<|end|>\n"
ASSISTANT = "assistant"
# Escapes in the order in which they are applied; undone from the last to the first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
LINE = "&#10;"  # a line end in a role
ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}

TURN = "struct<role: string, text: string>"


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def _turn(role: Column | str, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _list(items: str, role: str, text: str):
    return lambda r: F.transform(r[items], lambda m: _turn(m[role], m[text]))


def _fields(*pairs: tuple[str, str]):
    return lambda r: F.array(*[_turn(role, r[name]) for role, name in pairs])


def _instruction(r: Column) -> Column:
    more = F.coalesce(r["input"], F.lit(""))
    asked = F.when(more == "", F.coalesce(r["instruction"], F.lit(""))).otherwise(F.concat_ws("\n", r["instruction"], more))
    return F.array(_turn("user", asked), _turn(ASSISTANT, r["output"]))


@dataclass(frozen=True)
class Layout:
    """``schema`` of a JSON record and the expression that turns a parsed record into turns."""

    name: str
    schema: str
    turns: object


LAYOUTS = (
    Layout("messages", "messages array<struct<role: string, content: string>>", _list("messages", "role", "content")),
    Layout("conversations", "conversations array<struct<from: string, value: string>>", _list("conversations", "from", "value")),
    Layout("prompt_completion", "prompt string, completion string", _fields(("user", "prompt"), (ASSISTANT, "completion"))),
    Layout("prompt_response", "prompt string, response string", _fields(("user", "prompt"), (ASSISTANT, "response"))),
    Layout("system_prompt_response", "system string, prompt string, response string", _fields(("system", "system"), ("user", "prompt"), (ASSISTANT, "response"))),
    Layout("question_answer", "question string, answer string", _fields(("user", "question"), (ASSISTANT, "answer"))),
    Layout("instruction_output", "instruction string, output string", _fields(("user", "instruction"), (ASSISTANT, "output"))),
    Layout("instruction_input_output", "instruction string, input string, output string", _instruction),
)
TURN_ROWS = "conv_id bigint, turn bigint, role string, text string"
PAYLOADS = "conv_id bigint, payload string"


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths below a type, in order: ``a.b[].c``."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{at}[]")
    return [at]


def fingerprint_of(kind: T.DataType) -> str:
    return hashlib.sha256(",".join(paths_of(kind)).encode()).hexdigest()


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _shape(kind: T.DataType) -> str:
    """A type as the shape of a variant, fields by name and scalars without their types."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f"{f.name}: {_shape(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_shape(kind.elementType)}>"
    return "-"


def payload_fingerprint(payload: Column) -> Column:
    """The digest of a JSON record's nested paths; null where it is no JSON. Scalars' types do not count."""
    shape = F.schema_of_variant(F.try_parse_json(payload))
    return F.sha2(F.regexp_replace(shape, r"\b(?!OBJECT\b|ARRAY\b)[A-Z]+(\(\d+,\d+\))?(?=[,>]|$)", "-"), 256)


def canonical_payloads(records: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of JSON records (conv_id, payload), whatever their layouts.

    The record's fingerprint picks the layout. A record of no known layout, or that is null or no JSON,
    gives one turn with null role and the payload as its text: it is kept for others to see. A field of
    JSON null is an empty text; an empty list gives no turns. Other columns are not read.
    """
    marked = records.select("conv_id", "payload", payload_fingerprint(F.col("payload")).alias("_print"))
    turns = F.array(_turn(F.lit(None).cast("string"), F.col("payload")))
    for layout in LAYOUTS:
        kind = schema_of(layout.schema)
        print_ = hashlib.sha256(_shape(kind).encode()).hexdigest()
        parsed = F.from_json("payload", kind)
        turns = F.when(F.col("_print") == print_, layout.turns(parsed)).otherwise(turns)
    rows = marked.select("conv_id", F.posexplode(turns).alias("turn", "t"))
    role = F.col("t.role")
    for name, known in ROLES.items():
        role = F.when(F.col("t.role") == name, known).otherwise(role)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.col("t.text").alias("text"))


def canonical(df: DataFrame) -> DataFrame:
    """Turns of a frame, by the fingerprint of its columns: rows of turns, or JSON records.

    Columns beyond those of a layout are left out first, so extra ones do not matter. A null text is
    empty, a null role stays null.
    """
    for ddl, convert in ((TURN_ROWS, _turn_rows), (PAYLOADS, canonical_payloads)):
        wanted = schema_of(ddl)
        if set(wanted.names) <= set(df.columns):
            own = df.select(*[F.col(f.name).cast(f.dataType) for f in wanted.fields])
            if fingerprint_of(own.schema) == fingerprint_of(wanted):
                return convert(own)
    raise ValueError(f"no layout has the columns {df.columns}")


def _turn_rows(df: DataFrame) -> DataFrame:
    return df.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_chars): the template's text of every turn.

    A formatted conversation is its segments in the order of ``turn``, then role, then text. The loss
    mask of a segment is ``loss_chars`` code points from ``loss_start``: an assistant's text, and nothing
    of others. A null role is written empty. A conversation of any length stays spread over tasks.
    """
    role = escape(F.coalesce("role", F.lit("")))
    head = F.concat(F.lit(START), F.replace(role, F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    text = escape(F.coalesce("text", F.lit("")))
    masked = F.col("role").eqNullSafe(ASSISTANT)
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, text, F.lit(END)).alias("segment"),
        F.length(head).alias("loss_start"),
        F.when(masked, F.length(text)).otherwise(0).alias("loss_chars"),
    )


def read_segments(segments: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, loss_text) read back from formatted segments."""
    body = F.substring(F.col("segment"), len(START) + 1, 2**31 - 1)
    role = F.substring_index(body, "\n", 1)
    text = F.substr(body, F.length(role) + 2, F.length(body) - F.length(role) - 1 - len(END))
    loss = F.substr(F.col("segment"), F.col("loss_start") + 1, F.col("loss_chars"))
    return segments.select(
        "conv_id",
        "turn",
        unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"),
        unescape(text).alias("text"),
        unescape(loss).alias("loss_text"),
        F.length("segment").cast("long").alias("segment_chars"),
    )


def conversations_of(segments: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): whole texts, and for each segment (chars, loss_start, loss_chars)."""
    parts = F.sort_array(F.collect_list(F.struct("turn", "segment", "loss_start", "loss_chars")))
    return (
        segments.groupBy("conv_id")
        .agg(parts.alias("parts"))
        .select(
            "conv_id",
            F.array_join(F.col("parts.segment"), "").alias("formatted"),
            F.transform("parts", lambda p: F.struct(F.length(p["segment"]).alias("chars"), p["loss_start"].alias("loss_start"), p["loss_chars"].alias("loss_chars"))).alias("loss"),
        )
    )


def summary(segments: DataFrame) -> DataFrame:
    """Digests of each conversation's turns and masked text, read back from its segments.

    A digest is over a whole conversation in order, so the texts of one conversation meet in one row.
    """
    back = read_segments(segments)
    row = F.struct("turn", "role", "text", "loss_text")
    lists = back.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(row)).alias("rows"),
        F.count("*").alias("n_turns"),
        F.sum("segment_chars").alias("formatted_chars"),
        F.sum(F.length("loss_text").cast("long")).alias("loss_chars"),
    )
    said = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    return lists.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join(F.col("rows.loss_text"), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )
