"""Chat formatting: layouts are told apart by a fingerprint of their fields.

The fingerprint is a hash over the sorted nested field paths of a table or of
a JSON record (types and values left out). It selects
a declarative ``Layout``, which says where turns, roles and texts stand; one
function turns any layout into canonical turns (conversation, position, role,
text). So prompt / response, instruction / input / output, message lists and
rows by turn are all formatted alike.

Template, one piece per turn::

    ### Role: text</turn>\\n

Control strings inside texts are escaped reversibly: a backslash is doubled,
``</turn>`` becomes ``<\\/turn>`` and ``###`` gets backslashes between its
signs, so neither control string can occur in an escaped text; removing one
backslash from each escape restores the text. Roles are escaped in the same
way, and their colons too. The loss mask lists the stretches (start and length
in code points) of the escaped assistant texts.

Everything is DataFrame functions. A conversation becomes one row, so its
turns are gathered by its key; the number of rows of a conversation is bounded
by what fits in one formatted text.

Defined results: a null text is empty; a null role is the role "" (empty);
rows with the same turn number are ordered by role and text; rows without a
conversation id form one conversation with a null id; a record whose layout
is not known raises with its paths when it is a table, and is returned with
null turns when it is a JSON record; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</turn>"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A mapping from a layout's fields, beside the conversation key, to
    canonical turns. One of:

    * ``turns``: (role, path) pairs, a turn for each; several paths of one
      role are joined by a blank line, empty ones left out;
    * ``messages``: the array, with ``role`` and ``text`` fields in it;
    * ``order``: rows by turn, with the ``role`` and ``text`` columns.
    """
    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    messages: str = ""
    order: str = ""
    role: str = "role"
    text: str = "text"


LAYOUTS = (
    Layout("turn rows", order="turn"),
    Layout("prompt and response", turns=(("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout("prompt and completion", turns=(("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout("question and answer", turns=(("user", ("question",)), (ASSISTANT, ("answer",)))),
    Layout("instruction", turns=(("user", ("instruction",)), (ASSISTANT, ("output",)))),
    Layout("instruction with input", turns=(("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout("system, prompt and response",
           turns=(("system", ("system",)), ("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout("messages", messages="messages", text="content"),
    Layout("conversations", messages="conversations", role="from", text="value"),
)
#: Names that layouts use for the same roles (fixed values).
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def nested_paths(schema: T.DataType) -> str:
    """The nested field paths of a schema as one text: names in order of
    their code points, objects and arrays as such, values as ``_``."""
    if isinstance(schema, T.ArrayType):
        return f"ARRAY<{nested_paths(schema.elementType)}>"
    if not isinstance(schema, T.StructType):
        return "_"
    return "OBJECT<" + ", ".join(f"{f.name}: {nested_paths(f.dataType)}"
                                 for f in sorted(schema.fields, key=lambda f: f.name)) + ">"


def fingerprint(paths: str) -> str:
    return hashlib.sha256(paths.encode()).hexdigest()


def _struct(layout: Layout) -> T.StructType:
    """The layout's fields as a schema of strings."""
    text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
    if layout.messages:
        return T.StructType([T.StructField(layout.messages, T.ArrayType(T.StructType(text(layout.role, layout.text))))])
    if layout.order:
        return T.StructType(text(layout.order, layout.role, layout.text))
    return T.StructType(text(*dict.fromkeys(p for _, paths in layout.turns for p in paths)))


_BY_FINGERPRINT = {fingerprint(nested_paths(_struct(x))): x for x in LAYOUTS}


def layout_of(df: DataFrame, key: str) -> Layout:
    """The layout that the columns of ``df``, without its key, ask for."""
    paths = nested_paths(T.StructType([f for f in df.schema.fields if f.name != key]))
    found = _BY_FINGERPRINT.get(fingerprint(paths))
    if found is None:
        raise ValueError(f"no layout for the fields {paths}")
    return found


def escape(text: Column) -> Column:
    x = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(END), F.lit(f"<\\{END[1:]}"))
    return F.regexp_replace(x, "#(?=##)", r"#\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(known[F.coalesce(role, F.lit(""))], role, F.lit(""))


def _field_turns(layout: Layout, value) -> Column:
    """Turns of a record whose texts ``value(path)`` gives."""
    if layout.messages:
        return F.transform(value(layout.messages), lambda m: F.struct(
            _role(m[layout.role]).alias("role"), F.coalesce(m[layout.text], F.lit("")).alias("text")))
    made = []
    for role, paths in layout.turns:
        parts = [value(p) for p in paths]
        text = parts[0] if len(parts) == 1 else F.concat_ws("\n\n", *[F.when(p != "", p) for p in parts])
        made.append(F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text")))
    return F.array(*made)


def turns(df: DataFrame, key: str = "conv_id", extra: Sequence[str] = ()) -> DataFrame:
    """Canonical conversations (key, turns) of a table in any known layout;
    ``extra`` names columns that are no part of the layout."""
    df = df.drop(*extra)
    layout = layout_of(df, key)
    if layout.order:
        row = F.struct(F.col(layout.order).alias("turn"), _role(F.col(layout.role)).alias("role"),
                       F.coalesce(F.col(layout.text), F.lit("")).alias("text"))
        return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(row)), lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return df.select(key, _field_turns(layout, F.col).alias("turns"))


def json_paths(record: Column) -> Column:
    """``nested_paths`` of one JSON record (of all elements of its arrays);
    null if it is no JSON."""
    schema = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(schema, r"(?<=[:<] ?)(?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]+\))?(?=[,>])", "_")


def json_turns(df: DataFrame, record: str, key: str = "conv_id") -> DataFrame:
    """(key, turns) of JSON records of mixed layouts, each mapped by its own
    fingerprint; null turns where no layout fits."""
    doc, out = F.col("record"), F.lit(None).cast(TURNS)
    for mark, layout in _BY_FINGERPRINT.items():
        if layout.order:
            continue
        value = F.from_json(doc, _struct(layout))
        out = F.when(F.col("mark") == mark, _field_turns(layout, lambda p, v=value: v[p])).otherwise(out)
    marked = df.select(F.col(key).alias("key"), F.col(record).alias("record"))
    return (marked.withColumn("mark", F.sha2(json_paths(doc), 256))
            .select(F.col("key").alias(key), out.alias("turns")))


def format_turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, formatted, loss): the formatted text and its loss mask, an array
    of (start, length) in code points."""
    def heading(t: Column) -> Column:
        return F.concat(F.lit("### "), F.replace(escape(t["role"]), F.lit(":"), F.lit("\\:")), F.lit(": "))

    parts = F.transform("turns", lambda t: F.struct(
        heading(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("learn")))
    df = conversations.filter("turns IS NOT NULL").select(key, parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(f"{END}\n"))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    tail = len(END) + 1

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        span = F.struct(begin.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct((begin + F.length(p["body"]) + tail).alias("at"),
                        F.when(p["learn"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))
    return df.select(key, text.alias("formatted"), F.aggregate("parts", start, step)["spans"].alias("loss"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted text: what ``format_turns`` was given."""
    pieces = F.split(formatted, f"{END}\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        role = F.regexp_extract(p, r"(?s)^### ((?:[^\\:]|\\.)*): ", 1)
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substring(p, F.length(role) + 7, F.length(p))).alias("text"))
    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, one stretch after another."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
