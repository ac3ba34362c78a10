"""Chat formatting by schema fingerprints, in built-in functions only.

Chat data comes as one row a turn, as prompt and answer columns, as
instruction, input and output, or as nested messages, under several names.
The nested field paths of a record that some layout knows are put in order
and hashed; this fingerprint selects a declarative mapping, an expression that
makes the canonical turns, an array of (role, text).  Columns of a table have
one fingerprint for all rows; JSON records have one each.

The template writes turns between control strings.  A backslash is put into
every control string that stands in a text, and before every backslash, so no
control string survives inside a text and the texts can be read back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

# The template's control strings.
_OPEN = {"user": "[INST]", "system": "[SYS]"}
_CLOSE = {"user": "[/INST]", "system": "[/SYS]"}
_ANSWERED = "</s>"
_OTHER, _NAMED, _ENDED = "[ROLE]", "[TEXT]", "[/ROLE]"
#: The first character of a control string and what follows it.
_CONTROL = r"(\[)(?=/?(?:INST|SYS|ROLE|TEXT)\])|(<)(?=/?s>)"
#: One turn of a formatted conversation, whatever its role.
_TURN = r"(?s)\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|\[ROLE\].*?\[/ROLE\]|.*?</s>"


def escape(text: Column) -> Column:
    """Double backslashes, and a backslash inside every control string."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fingerprint(paths: Iterable[str]) -> Column:
    """64-bit hash of field paths, whatever their order."""
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


@dataclass(frozen=True)
class Layout:
    """A layout of one record: the field paths that tell it, and (role, path of
    its text) in order, or the path of an array of turns with the names of
    their role and text fields."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    array: tuple[str, str, str] | None = None


LAYOUTS = (
    Layout("messages", ("messages", "messages.role", "messages.content"), array=("messages", "role", "content")),
    Layout("conversations", ("conversations", "conversations.from", "conversations.value"), array=("conversations", "from", "value")),
    Layout("prompt_completion", ("prompt", "completion"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("system_prompt_response", ("system", "prompt", "response"),
           turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", ("question", "answer"), turns=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", ("instruction", "input", "output"),
           turns=(("user", "instruction+input"), ("assistant", "output"))),
)

#: Canonical names of roles that layouts call otherwise.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _known(layouts: Sequence[Layout]) -> list[str]:
    return sorted({p for layout in layouts for p in layout.paths})


def _role(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(names[F.lower(role)], role, F.lit(""))


def _turns(layout: Layout, value) -> Column:
    """The canonical turns of a record; ``value(path, type)`` is the record's
    field of that path.  Null texts are empty; an empty input adds nothing."""
    if layout.array:
        path, role, text = layout.array
        made = F.transform(  # fields by name: their order differs between sources
            value(path, f"array<struct<`{role}`:string,`{text}`:string>>"),
            lambda t: F.struct(
                _role(t[role].cast("string")).alias("role"), F.coalesce(t[text].cast("string"), F.lit("")).alias("text")
            ),
        )
        return F.coalesce(made, F.array().cast(TURNS))

    def text_of(path: str) -> Column:
        first, *more = (F.coalesce(value(p, "string"), F.lit("")) for p in path.split("+"))
        for x in more:
            first = F.when(x == "", first).otherwise(F.concat(first, F.lit("\n\n"), x))
        return first

    return F.array(*[F.struct(F.lit(r).alias("role"), text_of(p).alias("text")) for r, p in layout.turns]).cast(TURNS)


def _select(print_: Column, layouts: Sequence[Layout | TurnRows], made, none: Column) -> tuple[Column, Column]:
    """(``made`` of the layout, layout name) by fingerprint; ``none`` and
    'unknown' if none."""
    out, name = none, F.lit("unknown")
    for layout in layouts:
        fits = print_ == fingerprint(layout.paths)
        out = F.when(fits, made(layout)).otherwise(out)
        name = F.when(fits, F.lit(layout.name)).otherwise(name)
    return out, name


def schema_paths(schema: T.StructType) -> list[str]:
    """Nested field paths of a schema; arrays add nothing to a path."""
    out = []

    def walk(kind: T.DataType, path: str) -> None:
        if path:
            out.append(path)
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)

    walk(schema, "")
    return out


def table_turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Append ``turns`` and ``layout`` to records in typed columns.

    Columns and fields that no layout knows don't count.  A table whose known
    fields fit no layout gets null turns and the layout 'unknown'.
    """
    paths = [p for p in schema_paths(records.schema) if p in _known(layouts)]
    fitting = [layout for layout in layouts if set(layout.paths) <= set(paths)]

    def value(path: str, kind: str) -> Column:
        return F.col(path) if kind.startswith("array") else F.col(path).cast(kind)

    turns, name = _select(fingerprint(paths), fitting, lambda layout: _turns(layout, value), F.lit(None).cast(TURNS))
    return records.withColumns({"turns": turns, "layout": name})


def json_turns(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Append ``turns`` and ``layout`` to rows whose column ``record`` holds a
    JSON object in any layout, each row by its own fingerprint.

    A null, malformed or unknown record gets null turns, layout 'unknown'.
    """
    parsed = F.try_parse_json(F.col(record))

    def at(path: str) -> str:
        head, *rest = path.split(".")
        return ".".join([f"$.{head}[0]", *rest]) if rest else f"$.{head}"

    found = F.filter(
        F.array(*[F.when(F.try_variant_get("__record", at(p), "variant").isNotNull(), F.lit(p)) for p in _known(layouts)]),
        lambda p: p.isNotNull(),
    )
    held = records.withColumn("__record", parsed).withColumn("__print", F.xxhash64(F.array_join(found, "\n")))

    def value(path: str, kind: str) -> Column:
        return F.try_variant_get("__record", f"$.{path}", kind)

    turns, name = _select(F.col("__print"), layouts, lambda layout: _turns(layout, value), F.lit(None).cast(TURNS))
    return held.withColumns({"turns": turns, "layout": name}).drop("__record", "__print")


@dataclass(frozen=True)
class TurnRows:
    """A layout with one row a turn: conversation, order, role and text."""

    name: str
    conversation: str
    order: str
    role: str
    text: str

    @property
    def paths(self) -> tuple[str, ...]:
        return (self.conversation, self.order, self.role, self.text)


TURN_ROWS = (
    TurnRows("turn_rows", "conv_id", "turn", "role", "text"),
    TurnRows("message_rows", "thread_id", "position", "author", "body"),
)


def row_turns(rows: DataFrame, layouts: Sequence[TurnRows] = TURN_ROWS) -> DataFrame:
    """(conv_id, turns) of conversations that come as one row a turn.

    The fingerprint of the column names that some layout knows selects which
    columns are conversation, order, role and text.  Turns are ordered by
    their number, then role and text, so repeated rows are kept, in a defined
    order; null numbers come first.  Null texts and roles are empty.  A
    conversation is one formatted text, hence one row, of at most 2 GB.
    """
    columns = [c for c in rows.columns if c in {p for layout in layouts for p in layout.paths}]
    fitting = [layout for layout in layouts if set(layout.paths) <= set(columns)]
    if not any(set(layout.paths) == set(columns) for layout in fitting):
        raise ValueError(f"no layout of one row a turn has the columns {columns}")

    def row(layout: TurnRows) -> Column:
        turn = F.struct(
            F.col(layout.order).alias("turn"),
            F.coalesce(F.col(layout.role), F.lit("")).alias("role"),
            F.coalesce(F.col(layout.text), F.lit("")).alias("text"),
        )
        return F.struct(F.col(layout.conversation).alias("conv_id"), turn.alias("turn"))

    mapped, _ = _select(fingerprint(columns), fitting, row, F.lit(None))
    gathered = rows.select(mapped.alias("row")).groupBy(F.col("row.conv_id").alias("conv_id")).agg(
        F.sort_array(F.collect_list("row.turn")).alias("found")
    )
    return gathered.select(
        "conv_id", F.transform("found", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def _written(turn: Column) -> Column:
    role, text = turn["role"], escape(turn["text"])
    out = F.concat(F.lit(_OTHER), escape(role), F.lit(_NAMED), text, F.lit(_ENDED))
    for known in _OPEN:
        out = F.when(role == known, F.concat(F.lit(_OPEN[known]), text, F.lit(_CLOSE[known]))).otherwise(out)
    return F.when(role == "assistant", F.concat(text, F.lit(_ANSWERED))).otherwise(out)


def format_turns(conversations: DataFrame) -> DataFrame:
    """Append ``formatted``, the text of ``turns`` under the template.

    Null turns give a null text, no turns an empty one.
    """
    return conversations.withColumn("formatted", F.array_join(F.transform("turns", _written), ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Append ``parts``, one (role, text, written, start, whole, loss) for each
    turn found in ``formatted``: what the template was given, the text as
    written, where that starts in its turn and the length of the turn (in code
    points), and whether the text is under the loss mask, as the assistant's
    are."""
    found = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(0))

    def part(turn: Column) -> Column:
        named = F.instr(turn, _NAMED)
        other = turn.startswith(_OTHER)
        opening = F.when(other, named - 1 + len(_NAMED))
        closing = F.when(other, len(_ENDED))
        role = F.when(other, unescape(F.substring(turn, len(_OTHER) + 1, named - 1 - len(_OTHER))))
        for known in _OPEN:
            fits = turn.startswith(_OPEN[known])
            opening, closing = opening.when(fits, len(_OPEN[known])), closing.when(fits, len(_CLOSE[known]))
            role = role.when(fits, F.lit(known))
        opening, closing = opening.otherwise(0), closing.otherwise(len(_ANSWERED))
        role = role.otherwise(F.lit("assistant"))
        written = F.substring(turn, opening + 1, F.length(turn) - opening - closing)
        return F.struct(
            role.alias("role"), unescape(written).alias("text"), written.alias("written"),
            opening.alias("start"), F.length(turn).alias("whole"), (role == "assistant").alias("loss"),
        )

    return formatted.withColumn("parts", F.transform(found, part))


def loss_mask(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, start, length) of every text under the loss mask, in code points
    from the start of ``formatted``."""
    parts = read_back(formatted).select(key, F.posexplode("parts").alias("turn", "part"))
    before = Window.partitionBy(key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("part.whole").over(before), F.lit(0)) + F.col("part.start")
    return parts.withColumn("start", at).filter("part.loss").select(key, "start", F.length("part.written").alias("length"))


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars, read back from the formatted texts."""
    made = read_back(format_turns(row_turns(conversations)))
    whole = F.array_join(F.transform("parts", lambda p: F.concat(p["role"], F.lit("\n"), p["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: unescape(p["written"])), "")
    return made.select("conv_id", "formatted", F.size("parts").alias("n"), whole.alias("whole"), loss.alias("loss")).select(
        "conv_id",
        F.col("n").cast("long").alias("n_turns"),
        F.sha2(F.col("whole").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
