"""Conversations of many layouts in one chat format, with a loss mask.

Schema fingerprinting: the nested field paths of a table, or of a JSON record, are hashed;
the hash selects a declarative mapping (``LAYOUTS``) that says where the turns are.  All
layouts become rows of turns, and these one text per conversation.

Template: each turn is ``TURN role SAY text END``.  Wherever a role or text contains a
control string, or one with backslashes after its first character, it gets one
more backslash there; taking one away again restores it, so the format is reversible.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

TURN, SAY, END = "<|turn|>", "<|text|>", "<|end|>"
#: Also the marks of other templates, so that no text can pass for one of them.
CONTROL = r"\|(?:turn|text|end)\||/?s>|/?INST\]"
NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """``turns``: the array of turns with fields ``role`` and ``text``, or "" for one row a turn
    in the order of ``place``; or else ``fixed``: pairs of a role and the fields of its text."""

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    place: str = "turn"
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = field(default=())


#: Field paths of the layouts in common use.
LAYOUTS = (
    Layout(("turn", "role", "text"), turns=""),
    Layout(("messages[].role", "messages[].content"), turns="messages", text="content"),
    Layout(("conversations[].from", "conversations[].value"), turns="conversations",
           role="from", text="value"),
    Layout(("instruction", "input", "output"),
           fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout(("instruction", "output"),
           fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout(("system", "prompt", "response"),
           fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(("prompt", "response"), fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(("prompt", "completion"),
           fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(("question", "answer"), fixed=(("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(kind: T.DataType, before: str = "") -> list[str]:
    """Paths of all leaves of a type; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in field_paths(f.dataType, f"{before}.{f.name}".lstrip("."))]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, before + "[]")
    return [before]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def select_layout(schema: T.StructType, id_column: str) -> Layout:
    """The layout of a table: that of its fingerprint, or the largest that its paths hold."""
    paths = {p for p in field_paths(schema) if p != id_column}
    exact = BY_FINGERPRINT.get(fingerprint(paths))
    if exact:
        return exact
    held = [layout for layout in LAYOUTS if paths.issuperset(layout.paths)]
    if not held:
        raise ValueError(f"no layout for the field paths {sorted(paths)}")
    return max(held, key=lambda layout: len(layout.paths))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _role(c: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in NAMES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.lower(_text(c))), _text(c))


def _fixed_turns(layout: Layout, at=F.col) -> Column:
    said = []
    for role, names in layout.fixed:
        texts = F.filter(F.array(*(_text(at(n)) for n in names)), lambda t: t != "")
        said.append(F.struct(F.lit(role).alias("role"), F.array_join(texts, "\n").alias("text")))
    return F.array(*said)


def _array_turns(layout: Layout, turns: Column) -> Column:
    return F.transform(turns, lambda m: F.struct(
        _role(m[layout.role]).alias("role"), _text(m[layout.text]).alias("text")))


def to_turns(table: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Rows ``conv_id, place, role, text`` of a table in any known layout.

    Role names of other layouts are translated (``NAMES``); null roles and texts are empty.
    A record without turns (null or empty array) has no rows.
    """
    layout = select_layout(table.schema, id_column)
    conv = F.col(f"`{id_column}`").alias("conv_id")
    if layout.turns == "":
        return table.select(
            conv, F.col(layout.place).cast("long").alias("place"),
            _text(F.col(layout.role)).alias("role"), _text(F.col(layout.text)).alias("text"))
    turns = _array_turns(layout, F.col(layout.turns)) if layout.turns else _fixed_turns(layout)
    return table.select(conv, F.posexplode(turns).alias("place", "turn")).select(
        "conv_id", F.col("place").cast("long").alias("place"), "turn.role", "turn.text")


def json_to_turns(table: DataFrame, json_column: str, id_column: str = "conv_id") -> DataFrame:
    """Rows of turns of JSON records, each in its own layout by its own fingerprint.

    Records of an unknown layout, or that are not JSON, raise an error when they are read.
    """
    pair = "array<struct<{}:string,{}:string>>"
    names = sorted({n for x in LAYOUTS for _, ns in x.fixed for n in ns})
    schema = ", ".join(
        [f"messages {pair.format('role', 'content')}",
         f"conversations {pair.format('from', 'value')}"] + [f"{n} string" for n in names])
    got = F.col("record")
    present = [F.when(got[n].isNotNull(), F.lit(n)) for n in names]
    for layout in LAYOUTS:
        if layout.turns:
            present += [F.when(got[layout.turns].isNotNull(), F.lit(p)) for p in layout.paths]
    hashed = F.sha2(F.array_join(F.array_sort(F.array_compact(F.array(*present))), "\n"), 256)
    turns = F.when(F.lit(False), F.lit(None))
    for mark, layout in BY_FINGERPRINT.items():
        if layout.turns != "":
            turns = turns.when(F.col("mark") == mark, _array_turns(layout, got[layout.turns])
                               if layout.turns else _fixed_turns(layout, lambda n: got[n]))
    turns = turns.otherwise(F.raise_error(F.concat(
        F.lit("no layout for record "), F.col("conv_id").cast("string"))))
    return (
        table.select(F.col(f"`{id_column}`").alias("conv_id"),
                     F.from_json(F.col(json_column), schema).alias("record"))
        .withColumn("mark", hashed)
        .select("conv_id", F.posexplode(turns).alias("place", "turn"))
        .select("conv_id", F.col("place").cast("long").alias("place"), "turn.role", "turn.text")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def format_chats(turns: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """Per conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` are the stretches of ``formatted`` (start from 0 and length, in code points)
    that hold the escaped texts of the role ``learn``.  Turns are ordered by place, null first;
    equal places by role and text, so repeated rows follow each other.  Rows with a null
    id make one conversation; an empty table gives an empty result.  One shuffle by id; a
    conversation is one row of the result, so it is put together by one task.
    """
    order = Window.partitionBy("conv_id").orderBy("place", "role", "text")
    said, role = escape(F.col("text")), escape(F.col("role"))
    piece = F.concat(F.lit(TURN), role, F.lit(SAY), said, F.lit(END))
    rows = (
        turns.withColumn("piece", piece)
        .withColumn("size", F.char_length(said).cast("long"))
        .withColumn("n", F.row_number().over(order))
        .withColumn("stop", F.sum(F.char_length("piece").cast("long")).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    part = F.struct("n", "piece", (F.col("role") == learn).alias("learn"),
                    (F.col("stop") - len(END) - F.col("size")).alias("start"), "size")
    return (
        rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "conv_id",
            F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
            F.transform(
                F.filter("parts", lambda p: p["learn"]),
                lambda p: F.struct(p["start"].alias("start"), p["size"].alias("length")),
            ).alias("loss_spans"),
        )
    )


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and text, as they went in."""
    ends = F.split(formatted, END.replace("|", r"\|"))
    turns = F.slice(ends, F.lit(1), F.size(ends) - 1)
    cut = SAY.replace("|", r"\|")
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring(F.split(t, cut, 2)[0], len(TURN) + 1, 1 << 30)).alias("role"),
        unescape(F.split(t, cut, 2)[1]).alias("text")))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(formatted.substr(
        (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
