"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

The shape of a record (its nested field paths, sorted, without leaf types) is
hashed; the hash selects a mapping, one SQL expression that yields the turns.
Tables are fingerprinted once by their schema, JSON records one by one.

Defined cases: a null text or role is empty; an empty text is a turn with no
characters; turns with equal numbers keep all their rows, ordered by role and
text; a null turn number sorts first; a null conversation id is one
conversation; an empty table gives an empty result; columns a mapping does not
name are ignored, whatever they are called. A JSON record of unknown shape is
kept whole as one turn with an empty role. Everything is DataFrame code.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control strings of the template (fixed values).
BEGIN, END = "<s>", "</s>"
USER_OPEN, USER_CLOSE = "[INST]", "[/INST]"
SYSTEM_OPEN, SYSTEM_CLOSE = "<<SYS>>", "<</SYS>>"
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"

TURNS_TYPE = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """One way of storing chats. ``shape`` names the fields a record has and
    ``turns`` is the SQL expression of its turns over those fields."""

    name: str
    shape: str
    turns: str

    @property
    def fields(self) -> tuple[str, ...]:
        depth, names, word = 0, [], ""
        for c in self.shape.removeprefix("OBJECT<"):
            depth += (c == "<") - (c == ">")
            if depth == 0 and c == ":":
                names.append(word.strip(" ,"))
            word = "" if depth or c in ":," else word + c
        return tuple(names)

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.shape.encode()).hexdigest()


ROLE_NAMES = "CASE {0} WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' ELSE {0} END"
PAIR = "filter(array({0}), t -> t.text IS NOT NULL)".format(
    ", ".join(f"struct({i}L AS turn, '{r}' AS role, {{{r[0]}}} AS text)" for i, r in enumerate(("system", "user", "assistant")))
)

LAYOUTS = (
    Layout("rows", "OBJECT<conv_id: _, role: _, text: _, turn: _>", "array(struct(CAST(turn AS BIGINT) AS turn, role AS role, text AS text))"),
    Layout(
        "messages",
        "OBJECT<conv_id: _, messages: ARRAY<OBJECT<content: _, role: _>>>",
        "transform(messages, (m, i) -> struct(CAST(i AS BIGINT) AS turn, m.role AS role, m.content AS text))",
    ),
    Layout(
        "conversations",
        "OBJECT<conv_id: _, conversations: ARRAY<OBJECT<from: _, value: _>>>",
        f"transform(conversations, (m, i) -> struct(CAST(i AS BIGINT) AS turn, {ROLE_NAMES.format('m.from')} AS role, m.value AS text))",
    ),
    Layout(
        "instruction",
        "OBJECT<conv_id: _, input: _, instruction: _, output: _>",
        PAIR.format(s="CAST(NULL AS STRING)", u="concat_ws('\\n', instruction, nullif(input, ''))", a="output"),
    ),
    Layout("prompt", "OBJECT<completion: _, conv_id: _, prompt: _>", PAIR.format(s="CAST(NULL AS STRING)", u="prompt", a="completion")),
    Layout("system_prompt", "OBJECT<conv_id: _, prompt: _, response: _, system: _>", PAIR.format(s="nullif(system, '')", u="prompt", a="response")),
)


def shape_of(kind: T.DataType, only: tuple[str, ...] | None = None) -> str:
    """The nested field paths of a type, sorted, leaf types left out."""
    if isinstance(kind, T.StructType):
        kept = sorted((f for f in kind.fields if only is None or f.name in only), key=lambda f: f.name)
        return "OBJECT<" + ", ".join(f"{f.name}: {shape_of(f.dataType)}" for f in kept) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{shape_of(kind.elementType)}>"
    return "_"


def layout_of(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout with most fields whose fingerprint the schema has."""
    for layout in sorted(layouts, key=lambda x: -len(x.fields)):
        shape = shape_of(schema, layout.fields)
        if hashlib.sha256(shape.encode()).hexdigest() == layout.fingerprint:
            return layout
    raise ValueError(f"no layout for {shape_of(schema)}")


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role, text from a table of any known layout."""
    layout = layout_of(df.schema, layouts)
    return df.select("conv_id", F.inline(F.expr(layout.turns).cast(TURNS_TYPE)))


def canonical_json(df: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The same from JSON records of mixed layouts; each record's own
    fingerprint selects its mapping."""
    shaped = df.select(
        F.monotonically_increasing_id().alias("record"),
        F.col(column).alias("raw"),
        F.try_parse_json(F.col(column)).alias("v"),
    ).withColumn(
        "fingerprint",
        F.sha2(F.regexp_replace(F.schema_of_variant("v"), r"(?<=[:<] ?)(?:STRING|VOID|BIGINT|BOOLEAN|DOUBLE|DECIMAL\(\d+,\d+\))", "_"), 256),
    )
    known = [x.fingerprint for x in layouts]
    parts = []
    for layout in layouts:
        own = shaped.where(F.col("fingerprint") == layout.fingerprint)
        kinds = {"messages": "array<struct<content:string,role:string>>", "conversations": "array<struct<`from`:string,value:string>>"}
        fields = own.select(*[F.expr(f"variant_get(v, '$.{x}', '{kinds.get(x, 'string')}')").alias(x) for x in layout.fields])
        parts.append(fields.select("conv_id", F.inline(F.expr(layout.turns).cast(TURNS_TYPE))))
    rest = shaped.where(F.col("fingerprint").isNull() | ~F.col("fingerprint").isin(known))
    parts.append(
        rest.select(
            F.coalesce(F.expr("try_variant_get(v, '$.conv_id', 'string')"), F.concat(F.lit("record-"), F.col("record"))).alias("conv_id"),
            F.lit(0).cast("long").alias("turn"),
            F.lit("").alias("role"),
            F.col("raw").alias("text"),
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def escape(text: Column) -> Column:
    """No control string is left in the result; ``unescape`` gives the text back.

    A backslash becomes two, and one more is put behind the first character of
    every control string.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"(<)(?=/?s>|</?SYS>>)|(\[)(?=/?(?:INST|ROLE)\])", r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (start from 1, code points).

    One exchange by conversation: offsets are running sums over its turns and
    the grouping uses the same partitioning. A conversation is one training
    record, so its turns meet in one row; nothing else is gathered.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.when(role == "user", BEGIN + USER_OPEN)
        .when(role == "system", BEGIN + SYSTEM_OPEN)
        .when(role == "assistant", BEGIN)
        .otherwise(F.concat(F.lit(BEGIN + ROLE_OPEN), escape(role), F.lit(ROLE_CLOSE)))
        .alias("head"),
        escape(text).alias("body"),
        F.when(role == "user", USER_CLOSE + END).when(role == "system", SYSTEM_CLOSE + END).otherwise(END).alias("tail"),
    )
    chars = F.char_length("head") + F.char_length("body") + F.char_length("tail")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = framed.select(
        "conv_id",
        F.row_number().over(order).alias("pos"),
        "role",
        F.concat("head", "body", "tail").alias("piece"),
        (F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.char_length("head").alias("head_chars"),
        F.char_length("body").alias("body_chars"),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(
            F.collect_list(
                F.struct("pos", "piece", "role", (F.coalesce("before", F.lit(0)) + F.col("head_chars") + 1).alias("start"), F.col("body_chars").alias("chars"))
            )
        ).alias("pieces"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.transform(
            F.filter("pieces", lambda p: p["role"] == "assistant"),
            lambda p: F.struct(p["start"].alias("start"), p["chars"].alias("chars")),
        ).alias("loss_spans"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns read back from a formatted chat: array of role and text."""

    def inner(piece: Column, opening: str, closing: str) -> Column:
        return unescape(F.substring(piece, F.lit(len(opening) + 1), F.char_length(piece) - len(opening) - len(closing)))

    def turn(piece: Column) -> Column:
        user, system, other = BEGIN + USER_OPEN, BEGIN + SYSTEM_OPEN, BEGIN + ROLE_OPEN
        role = (
            F.when(F.startswith(piece, F.lit(user)), F.lit("user"))
            .when(F.startswith(piece, F.lit(system)), F.lit("system"))
            .when(F.startswith(piece, F.lit(other)), unescape(F.substring_index(F.substring(piece, len(other) + 1, 2**31 - 1), ROLE_CLOSE, 1)))
            .otherwise(F.lit("assistant"))
        )
        text = (
            F.when(F.startswith(piece, F.lit(user)), inner(piece, user, USER_CLOSE))
            .when(F.startswith(piece, F.lit(system)), inner(piece, system, SYSTEM_CLOSE))
            .when(F.startswith(piece, F.lit(other)), unescape(F.substring(piece, F.instr(piece, ROLE_CLOSE) + len(ROLE_CLOSE), F.char_length(piece))))
            .otherwise(inner(piece, BEGIN, ""))
        )
        return F.struct(role.alias("role"), text.alias("text"))

    pieces = F.split(formatted, END)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def text_under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped text of the loss mask, nothing between its parts."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["chars"]))), "")
