"""Chat formatting: layouts told apart by a fingerprint of their field paths.

The nested field paths of a table or of a JSON record are hashed; the hash
selects a declarative mapping that turns that layout into canonical turns
(conv_id, turn, role, text). The template then marks each turn, escapes its own
control strings inside texts, and keeps the code point spans under the loss
mask. The format can be read back exactly.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.tables import named

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>"
LOSS_ROLE = "assistant"
# Replacements in this order; each puts in a backslash, and reading back drops one before every character.
ESCAPES = [("\\", "\\\\"), (OPEN, "#\\## "), (CLOSE, "<\\/turn>")]
ROLE_ESCAPES = [*ESCAPES, (MIDDLE, ":\\ ")]
TURNS = "array<struct<role:string,text:string>>"


def paths_of(kind: T.DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a type, arrays shown by [], sorted."""
    if isinstance(kind, T.StructType):
        return sorted(
            path for part in kind.fields for path in paths_of(part.dataType, f"{prefix}.{part.name}".lstrip("."))
        )
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """How one layout of records becomes turns.

    Either one record holds one turn (``turn``, ``role`` and ``text`` name its
    fields), or a list of messages (``messages``, with ``role`` and ``text``
    inside it), or one field per turn (``fields``: role and field names in
    order; the fields of one turn are joined by a blank line, empty ones left
    out). ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    conv_id: str = "conv_id"
    turn: str | None = None
    role: str | None = None
    text: str | None = None
    messages: str | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def key(self) -> str:
        return fingerprint(list(self.paths))


_SPEAKERS = {"human": "user", "gpt": "assistant"}
LAYOUTS = [
    Layout("turn rows", ("conv_id", "turn", "role", "text"), turn="turn", role="role", text="text"),
    Layout("messages", ("conv_id", "messages[].role", "messages[].content"),
           messages="messages", role="role", text="content"),
    Layout("speakers", ("conv_id", "conversations[].from", "conversations[].value"),
           messages="conversations", role="from", text="value", roles=_SPEAKERS),
    Layout("prompt", ("conv_id", "prompt", "response"),
           fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", ("conv_id", "instruction", "input", "output"),
           fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("system prompt", ("conv_id", "system", "prompt", "response"),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
]


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    role = F.coalesce(role, F.lit(""))
    for old, new in roles.items():
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _exploded(rows: DataFrame, turns: Column) -> DataFrame:
    return rows.select("conv_id", F.posexplode(turns).alias("turn", "at")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "at.role", "at.text"
    )


def table_turns(df: DataFrame, layouts: list[Layout] | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Canonical turns of a table, by the layout its field paths select.

    Columns named in ``ignore`` take no part. An unknown layout is an error
    that lists its paths. Null roles and texts become empty.
    """
    kept = [name for name in df.columns if name not in ignore]
    df = df.select(*map(named, kept))
    paths = paths_of(df.schema)
    known = {layout.key: layout for layout in layouts or LAYOUTS}
    layout = known.get(fingerprint(paths))
    if layout is None:
        raise ValueError(f"no layout has the field paths {paths}")
    rows = df.withColumn("conv_id", named(layout.conv_id))
    empty = F.lit("")
    if layout.turn:
        return rows.select(
            "conv_id",
            named(layout.turn).cast("long").alias("turn"),
            _renamed(named(layout.role), layout.roles).alias("role"),
            F.coalesce(named(layout.text), empty).alias("text"),
        )
    if layout.messages:
        turns = _messages(named(layout.messages), layout)
    else:
        turns = F.array(
            *(F.struct(F.lit(role).alias("role"), _joined(map(named, names)).alias("text"))
              for role, names in layout.fields)
        )
    return _exploded(rows, turns)


def _messages(messages: Column, layout: Layout) -> Column:
    return F.transform(
        messages,
        lambda at: F.struct(
            _renamed(at[layout.role], layout.roles).alias("role"),
            F.coalesce(at[layout.text], F.lit("")).alias("text"),
        ),
    )


def _joined(parts) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda part: part.isNotNull() & (part != "")), "\n\n")


def record_paths(record: Column) -> Column:
    """The field paths of a variant record, sorted and joined by newlines.

    Known for records nested as layouts are: fields, and lists of objects.
    """
    shown = F.schema_of_variant(record)
    flat = F.regexp_replace(shown, r"(\w+|`[^`]*`): ARRAY<OBJECT<([^<>]*)>>", "[$1]$2;")
    names = F.transform(
        F.regexp_extract_all(flat, F.lit(r"\[(\w+)\]([^;]*);|(\w+): [A-Z]"), F.lit(0)),
        lambda part: F.when(
            part.startswith("["),
            F.array_join(
                F.transform(
                    F.regexp_extract_all(F.regexp_extract(part, r"\]([^;]*);", 1), F.lit(r"(\w+): "), F.lit(1)),
                    lambda inner: F.concat(F.regexp_extract(part, r"\[(\w+)\]", 1), F.lit("[]."), inner),
                ),
                "\n",
            ),
        ).otherwise(F.regexp_extract(part, r"(\w+): ", 1)),
    )
    return F.array_join(F.array_sort(F.split(F.array_join(names, "\n"), "\n")), "\n")


def record_turns(records: DataFrame, json_col: str = "record", layouts: list[Layout] | None = None) -> DataFrame:
    """Canonical turns of JSON records of mixed layouts; each record's own paths select its mapping.

    The ids of records have to be whole numbers. Records that are null, not
    JSON or of no known layout give one row with a null turn, so that nothing
    is lost unseen.
    """
    parsed = records.select(F.try_parse_json(named(json_col)).alias("record"))
    keyed = parsed.select("record", F.sha2(record_paths(F.col("record")), 256).alias("key"))
    turns, ids = F.lit(None).cast(TURNS), F.lit(None).cast("long")
    for layout in layouts or LAYOUTS:
        if layout.turn:
            continue
        get = lambda path, kind: F.try_variant_get("record", path, kind)
        if layout.messages:
            kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
            mapped = _messages(get(f"$.{layout.messages}", kind), layout)
        else:
            mapped = F.array(
                *(F.struct(F.lit(role).alias("role"),
                           _joined([get(f"$.{name}", "string") for name in names]).alias("text"))
                  for role, names in layout.fields)
            )
        matches = F.col("key") == layout.key
        turns = F.when(matches, mapped.cast(TURNS)).otherwise(turns)
        ids = F.when(matches, get(f"$.{layout.conv_id}", "long")).otherwise(ids)
    return keyed.select(ids.alias("conv_id"), F.posexplode_outer(turns).alias("turn", "at")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "at.role", "at.text"
    )


def escaped(text: Column, replacements: list[tuple[str, str]] = ESCAPES) -> Column:
    for plain, safe in replacements:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans (code points, end exclusive) of each conversation.

    Turns stand in the order of turn, role and text; repeated rows stay. A
    null turn number comes first, null roles and texts are empty, null ids form
    one conversation. An empty table gives an empty result. A conversation is
    one text, so its turns meet in one task: that is the result asked for.
    """
    empty = F.lit("")
    head = F.concat(F.lit(OPEN), escaped(F.coalesce(F.col("role"), empty), ROLE_ESCAPES), F.lit(MIDDLE))
    body = escaped(F.coalesce(F.col("text"), empty))
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.col("turn").isNotNull().alias("known"),
                "turn",
                F.coalesce(F.col("role"), empty).alias("role"),
                F.coalesce(F.col("text"), empty).alias("text"),
                F.concat(head, body, F.lit(CLOSE)).alias("piece"),
                F.length(head).alias("before"),
                F.length(body).alias("size"),
            )
        )
    )
    grouped = turns.groupBy("conv_id").agg(ordered.alias("turns"))
    spans = "array<struct<start:bigint,stop:bigint>>"
    walked = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("out")),
        lambda done, turn: F.struct(
            (done["at"] + F.length(turn["piece"])).alias("at"),
            F.when(
                turn["role"] == LOSS_ROLE,
                F.concat(
                    done["out"],
                    F.array(
                        F.struct(
                            (done["at"] + turn["before"]).alias("start"),
                            (done["at"] + turn["before"] + turn["size"]).alias("stop"),
                        )
                    ),
                ),
            )
            .otherwise(done["out"])
            .alias("out"),
        ),
        lambda done: done["out"],
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda turn: turn["piece"]), "").alias("formatted"),
        walked.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.split(formatted, F.lit(r"\Q" + CLOSE + r"\E"), F.lit(-1))
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda piece: F.struct(
            unescaped(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
            unescaped(F.substr(piece, F.instr(piece, MIDDLE) + len(MIDDLE))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda span: unescaped(
                F.substr(formatted, (span["start"] + 1).cast("int"), (span["stop"] - span["start"]).cast("int"))
            ),
        ),
        "",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    turns = read_turns(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    listed = F.array_join(
        F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), ""
    )
    return formatted.select(
        "conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
