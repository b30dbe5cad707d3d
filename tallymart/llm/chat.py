"""Chat formatting: records of many layouts become turns, turns become marked text with a loss mask.

The layout of a record is the set of nested field paths that hold a value, such as
``messages[].role``. Its fingerprint is a hash of the sorted paths. A registry of
declarative mappings lists, for each layout, where roles and texts are; the
fingerprint picks the mapping of each row, so one table can mix layouts, as the
reader merges them. Paths that no mapping names don't count. A row whose fingerprint no mapping has
gives no turns and is counted by ``layout_counts``.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a control
string; a line break in a role becomes ``\\n``. Reading undoes this exactly. The loss mask is
the span of an assistant's text within its turn, in code points.

Turns stay rows up to the end: the text of a conversation is its pieces in order, and
its digests are taken by a task that streams its sorted rows and holds one
batch of them, as a digest has to meet the texts one after another.

Edge cases: a null text is empty, a null role is empty; turns go by number, nulls
first, then role and text, equal rows count as often as they are there; rows
without an id are one conversation; an empty or null list of messages gives
no turns; a null message in a list is an empty turn without role; an empty table
gives no rows; columns beside the payload aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, STOP = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

#: Names of the speakers in public chat layouts that name them by ``from``.
SPEAKERS = (("human", "user"), ("prompter", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


@dataclass(frozen=True)
class Say:
    """One turn: a fixed role, and the texts at ``paths`` that are there, joined by a line break."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn for each item of a list, with role and text in fields of the item; ``names`` renames roles."""

    items: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Pairs:
    """Two turns for each item of a list: the user's at one path, the assistant's at another."""

    items: str
    user: str
    assistant: str


@dataclass(frozen=True)
class Row:
    """The record is itself a turn and says its number."""

    number: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Say | Each | Pairs | Row, ...]
    required: tuple[str, ...]
    optional: tuple[str, ...] = field(default=())

    def fingerprints(self) -> Iterator[str]:
        for n in range(len(self.optional) + 1):
            for some in combinations(self.optional, n):
                yield fingerprint_of({*self.required, *some})


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _asked(name: str, question: tuple[str, ...], answer: str, more: tuple[str, ...] = ()) -> Layout:
    turns = (Say("system", ("system",)), Say("user", question + more), Say("assistant", (answer,)))
    return Layout(name, turns, (*question, answer), ("system", *more))


LAYOUTS = (
    Layout("turn_rows", (Row("turn", "role", "text"),), (), ("turn", "role", "text")),
    Layout(
        "messages",
        (Say("system", ("system",)), Each("messages", "role", "content")),
        ("messages[].role",),
        ("messages[].content", "system"),
    ),
    Layout(
        "from_value",
        (Say("system", ("system",)), Each("conversations", "from", "value", SPEAKERS)),
        ("conversations[].from",),
        ("conversations[].value", "system"),
    ),
    Layout("dialog", (Pairs("dialog", "user", "assistant"),), ("dialog[].user",), ("dialog[].assistant",)),
    _asked("instruction", ("instruction",), "output", ("input",)),
    _asked("prompt_completion", ("prompt",), "completion"),
    _asked("prompt_response", ("prompt",), "response"),
    _asked("question_answer", ("question",), "answer", ("context",)),
    _asked("nested_prompt", ("data.prompt",), "data.response"),
)

Test = Callable[[Column], Column]


def _leaves(kind: DataType) -> Iterator[tuple[str, Test]]:
    """The paths below a value of this type, each with the test whether it holds a value."""
    if isinstance(kind, StructType):
        for f in kind.fields:
            for path, test in _leaves(f.dataType):
                yield f".{f.name}{path}", lambda c, n=f.name, t=test: t(c.getField(n))
    elif isinstance(kind, ArrayType):
        for path, test in _leaves(kind.elementType):
            yield f"[]{path}", lambda c, t=test: F.exists(c, lambda x: F.coalesce(t(x), F.lit(False)))
    else:
        yield "", lambda c: c.isNotNull()


def fingerprint(schema: StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of the field paths that hold a value in a row, among those that the layouts name."""
    known = {p for layout in layouts for p in (*layout.required, *layout.optional)}
    tests = []
    for f in schema.fields:
        for rest, test in _leaves(f.dataType):
            if f.name + rest in known:
                tests.append((f.name + rest, test(F.col(f"`{f.name}`"))))
    held = [F.when(F.coalesce(test, F.lit(False)), F.lit(path)) for path, test in sorted(tests, key=lambda x: x[0])]
    return F.sha2(F.concat_ws("\n", *held) if held else F.lit(""), 256)


def _at(schema: StructType, path: str) -> Column | None:
    """The column at a dotted path, None where the table has none."""
    column, kind = None, schema
    for name in path.split("."):
        if not isinstance(kind, StructType) or name not in kind.names:
            return None
        column = F.col(f"`{name}`") if column is None else column.getField(name)
        kind = kind[name].dataType
    return column


def _turn(role: Column, text: Column, names: tuple[tuple[str, str], ...] = ()) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    if names:
        renamed = F.create_map(*(F.lit(x) for pair in names for x in pair))
        role = F.coalesce(renamed[role], role)
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _said(schema: StructType, part: Say | Each | Pairs | Row) -> Column | None:
    """An array of turns, None where the table lacks the fields."""
    at = lambda path: _at(schema, path)
    if isinstance(part, Say):
        held = [c for p in part.paths if (c := at(p)) is not None]
        if not held:
            return None
        there = F.array_compact(F.array(*(c.cast("string") for c in held)))
        said = F.array(_turn(F.lit(part.role), F.array_join(there, "\n")))
        return F.when(F.size(there) > 0, said).otherwise(F.slice(said, 1, 0))
    if isinstance(part, Row):
        role, text = at(part.role), at(part.text)
        return F.array(_turn(F.lit(None) if role is None else role, F.lit(None) if text is None else text))
    items = at(part.items)
    kind = schema[part.items].dataType if items is not None and "." not in part.items else None
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, StructType):
        return None
    own = lambda x, name: x.getField(name) if name in kind.elementType.names else F.lit(None)
    if isinstance(part, Each):
        return F.transform(items, lambda x: _turn(own(x, part.role), own(x, part.text), part.names))
    both = lambda x: F.array(
        _turn(F.lit("user"), own(x, part.user)), _turn(F.lit("assistant"), own(x, part.assistant))
    )
    return F.flatten(F.transform(items, both))


def _recognised(records: DataFrame, layouts: tuple[Layout, ...]) -> Column:
    """The name of the layout that has the row's fingerprint."""
    by_print: dict[str, str] = {}
    for layout in layouts:
        if not layout.required and not set(layout.optional) & set(records.columns):
            continue  # a record without any value is a turn only where turns are rows
        for each in layout.fingerprints():
            if by_print.setdefault(each, layout.name) != layout.name:
                raise ValueError(f"{layout.name} and {by_print[each]} have a fingerprint in common")
    names = F.create_map(*(F.lit(x) for pair in by_print.items() for x in pair))
    return names[fingerprint(records.schema, layouts)]


def layout_counts(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Rows of each fingerprint with the layout it selects; null for rows that no mapping covers."""
    return records.groupBy(
        fingerprint(records.schema, layouts).alias("fingerprint"), _recognised(records, layouts).alias("layout")
    ).agg(F.count(F.lit(1)).alias("n"))


def canonical_turns(records: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The turns of every record: ``key``, ``turn`` (number), ``role``, ``text``, ``layout``."""
    chosen = records.withColumn("_layout", _recognised(records, layouts))
    said = F.lit(None).cast("array<struct<role:string,text:string>>")
    number = F.lit(None).cast("long")
    for layout in layouts:
        parts = [c for p in layout.turns if (c := _said(records.schema, p)) is not None]
        if not parts:
            continue
        here = F.col("_layout") == layout.name
        said = F.when(here, F.concat(*parts)).otherwise(said)
        for p in layout.turns:
            if isinstance(p, Row) and (own := _at(records.schema, p.number)) is not None:
                number = F.when(here, own.cast("long")).otherwise(number)
    is_row = F.col("_layout").isin([x.name for x in layouts if isinstance(x.turns[0], Row)])
    made = chosen.select(
        F.col(f"`{key}`"),
        number.alias("_number"),
        is_row.alias("_is_row"),
        F.col("_layout").alias("layout"),
        F.posexplode(said).alias("_at", "_turn"),
    )
    return made.select(
        key,
        F.when(F.col("_is_row"), F.col("_number")).otherwise(F.col("_at").cast("long")).alias("turn"),
        "_turn.role",
        "_turn.text",
        "layout",
    )


def escaped(column: Column, in_line: bool = False) -> Column:
    """Without control strings, and with ``in_line`` without line breaks."""
    column = F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(column, F.lit("\n"), F.lit("\\n")) if in_line else column


def unescaped(column: Column) -> Column:
    """The inverse of ``escaped``, with and without ``in_line``."""
    column = F.regexp_replace(column, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(column, r"\\([\\|])", "$1")


def rendered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``piece``, the turn as written, and its loss span ``loss_at``, ``loss_chars``."""
    head = F.concat(F.lit(START), escaped(F.col("role"), in_line=True), F.lit("\n"))
    body = escaped(F.col("text"))
    learns = F.col("role") == LOSS_ROLE
    return turns.withColumns(
        {
            "piece": F.concat(head, body, F.lit(STOP + "\n")),
            "loss_at": F.when(learns, F.char_length(head)),
            "loss_chars": F.when(learns, F.char_length(body)).otherwise(0),
        }
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """Role, text and text under the loss mask, from the written pieces and spans alone."""
    whole = r"(?s)\A<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n\z"
    masked = F.substr("piece", F.col("loss_at") + 1, F.col("loss_chars"))
    return pieces.withColumns(
        {
            "role": unescaped(F.regexp_extract("piece", whole, 1)),
            "text": unescaped(F.regexp_extract("piece", whole, 2)),
            "loss_text": F.coalesce(unescaped(masked), F.lit("")),
            "piece_chars": F.char_length("piece").cast("long"),
        }
    )


def digests(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """A row per conversation with counts and digests of what ``read_back`` read."""
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(F.col(f"`{key}`").alias("conv_id"), "turn", "role", "text", "loss_text", "piece_chars")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, said, learned = None, hashlib.sha256(), hashlib.sha256()
        n = loss = chars = 0

        def ended() -> tuple:
            return current[0], n, said.hexdigest(), loss, learned.hexdigest(), chars

        for batch in batches:
            for own, role, text, loss_text, piece in zip(
                *(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True
            ):
                if current != (own,):
                    if current:
                        done.append(ended())
                    current, said, learned = (own,), hashlib.sha256(), hashlib.sha256()
                    n = loss = chars = 0
                said.update(f"{role}\n{text}\n".encode())
                learned.update(loss_text.encode())
                n, loss, chars = n + 1, loss + len(loss_text), chars + piece
            if done:
                yield pa.RecordBatch.from_arrays(_columns(done, batch.schema.field(0).type), names)
                done = []
        if current:
            yield pa.RecordBatch.from_arrays(_columns([ended()], batch.schema.field(0).type), names)

    return rows.mapInArrow(
        streamed,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _columns(rows: list[tuple], key: pa.DataType) -> list[pa.Array]:
    kinds = (key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]


def formatted(records: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Every turn of every record as written, with its loss span."""
    return rendered(canonical_turns(records, key, layouts))
