"""Chat formatting: records of any layout become turns, turns become a templated text with a loss mask.

A record's layout is known by its fingerprint, the hash of its nested field paths; the fingerprint selects a
declarative mapping to turns. A record that has more fields than a layout needs is mapped by the first layout whose
paths it has; one that no layout fits is set apart, with its fingerprint. Everything is a column expression over VARIANT
values and strings.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.native import let

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How records with certain field paths become turns.

    ``paths`` are the paths of the fields, as ``field_paths`` writes them. With ``turns`` (a path to an array) each
    element is a turn with the fields ``role`` and ``text``; else ``parts`` lists (role, paths): the texts at the paths
    that are not empty, joined by a blank line; a role that begins with ``$`` is itself a path. ``names`` renames roles.
    """

    paths: str
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    names: dict[str, str] = field(default_factory=dict)


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("{completion,prompt}", (("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("{prompt,response}", (("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("{instruction,output}", (("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Layout("{input,instruction,output}", (("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("{messages:[{content,role}]}", turns="$.messages"),
    Layout("{conversations:[{from,value}]}", turns="$.conversations", role="from", text="value", names=SPEAKERS),
    Layout("{role,text}", (("$.role", ("$.text",)),)),
    Layout("{role}", (("$.role", ()),)),
    Layout("{text}", (("", ("$.text",)),)),
    Layout("{}", (("", ()),)),
)


def field_paths(record: Column) -> Column:
    """Names of all fields of a VARIANT, nested as they are, in alphabetical order and without the types of plain values."""
    shape = F.schema_of_variant(record)
    # Types of plain values go, those of fields and of array elements.
    plain = "(:? ?)\\b(?:VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|STRING|BINARY|DATE|TIMESTAMP(?:_NTZ)?|UUID|VARIANT|DECIMAL\\(\\d+, ?\\d+\\))(?=[,>])"
    for pattern, text in (("OBJECT<", "{"), ("ARRAY<", "["), (plain, ""), (": (?=[{\\[])", ":"), (", ", ",")):
        shape = F.regexp_replace(shape, pattern, text)
    # Brackets close in the order in which they were opened, so the kind of each follows from what stands before it.
    for _ in range(NESTED):
        shape = F.regexp_replace(F.regexp_replace(shape, "\\{([^{}\\[\\]<>]*)>", "\u0001$1\u0002"), "\\[([^{}\\[\\]<>]*)>", "\u0003$1\u0004")
    return F.translate(shape, "\u0001\u0002\u0003\u0004", "{}[]")


#: Levels of nested fields that are written out.
NESTED = 4


def fingerprint(record: Column) -> Column:
    """Hash of the field paths; NULL for a NULL record."""
    return F.when(record.isNotNull(), F.xxhash64(field_paths(record)))


def _at(record: Column, path: str, outside: Mapping[str, Column]) -> Column:
    """Text at a path; ``outside`` has texts that are not in the record itself, by their path."""
    if path in outside:
        return F.coalesce(outside[path], F.lit(""))
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _renamed(role: Column, names: dict[str, str]) -> Column:
    for old, new in names.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def _turns(record: Column, layout: Layout, outside: Mapping[str, Column]) -> Column:
    if layout.turns is not None:
        elements = F.try_variant_get(record, layout.turns, "array<variant>")

        def turn(e: Column) -> Column:
            role = _renamed(_at(e, f"$.{layout.role}", {}), layout.names)
            return F.struct(role.alias("role"), _at(e, f"$.{layout.text}", {}).alias("text"))

        return F.transform(elements, turn)
    made = []
    for role, paths in layout.parts:
        name = _renamed(_at(record, role, outside), layout.names) if role.startswith("$") else F.lit(role)
        filled = F.filter(F.array(*(_at(record, p, outside) for p in paths)).cast("array<string>"), lambda x: x != "")
        made.append(F.struct(name.alias("role"), F.array_join(filled, "\n\n").alias("text")))
    return F.array(*made)


def _has(record: Column, layout: Layout) -> Column:
    """Whether a record has the paths that a layout reads, beside any others."""
    if layout.turns is not None:
        elements = F.try_variant_get(record, layout.turns, "array<variant>")
        named = F.forall(elements, lambda e: F.try_variant_get(e, f"$.{layout.role}", "string").isNotNull())
        told = F.exists(elements, lambda e: F.try_variant_get(e, f"$.{layout.text}", "string").isNotNull())
        return F.coalesce(named & (told | (F.size(elements) == 0)), F.lit(False))
    paths = [p for role, texts in layout.parts for p in (role, *texts) if p.startswith("$")]
    return reduce(lambda a, b: a & b, [F.try_variant_get(record, p, "variant").isNotNull() for p in paths])


def _needs(layout: Layout) -> int:
    """Fields that a layout reads; with fewer than two a record says too little to be taken for one of its kind."""
    return 2 if layout.turns is not None else sum(len(p) + role.startswith("$") for role, p in layout.parts)


def canonical(record: Column, layouts: tuple[Layout, ...] = LAYOUTS, outside: Mapping[str, Column] | None = None) -> Column:
    """Turns (role, text) of a VARIANT record; NULL if no layout fits it. A missing text is empty.

    A layout with the record's fingerprint is chosen first, then the one with the most paths that the record has,
    arrays of turns before all others. A VARIANT is limited in size: texts of any length may be given
    ``outside`` of it, by path, with something short in their place.
    """
    outside = outside or {}
    loose = [x for x in layouts if _needs(x) > 1]
    loose.sort(key=lambda x: (x.turns is not None, _needs(x)))

    def selected(shape: Column) -> Column:
        out = F.lit(None).cast(TURNS)
        for layout in loose:
            out = F.when(_has(record, layout), _turns(record, layout, outside).cast(TURNS)).otherwise(out)
        for layout in layouts:
            out = F.when(shape == F.xxhash64(F.lit(layout.paths)), _turns(record, layout, outside).cast(TURNS)).otherwise(out)
        return out

    return let(fingerprint(record), selected)


def split_records(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, turn, record) as turns (conv_id, turn, turns), and those without a layout with fingerprint and JSON text.

    Together they are all rows; a NULL record has no layout, no fingerprint and no text.
    """
    mapped = records.select("conv_id", "turn", "record", canonical(F.col("record"), layouts).alias("turns"))
    known = F.col("turns").isNotNull()
    lost = mapped.where(~known).select("conv_id", "turn", fingerprint(F.col("record")).alias("fingerprint"), F.to_json("record").alias("record"))
    return mapped.where(known).select("conv_id", "turn", "turns"), lost


def turns_of_columns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, turns) of rows (conv_id, turn, role, text): records of the layout that the columns are, at any length."""
    shape = F.to_variant_object(F.struct(F.substring("role", 1, 0).alias("role"), F.substring("text", 1, 0).alias("text")))
    outside = {"$.role": F.col("role"), "$.text": F.col("text")}
    return rows.select("conv_id", "turn", canonical(shape, outside=outside).alias("turns"))


def escaped(text: Column) -> Column:
    """Text in which no control string occurs; ``unescaped`` restores it."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\N|"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\N|"), F.lit("\n")))


def formatted(turns: Column) -> Column:
    """Segments (text, loss) of the templated text: loss is true for the texts of the assistant and nothing else."""

    def segments(t: Column) -> Column:
        loss = t["role"] == ASSISTANT
        return F.array(
            F.struct(F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"]).alias("text"), loss.alias("loss")),
            F.struct(F.lit(f"{CLOSE}\n").alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, segments))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its segments, from rows (conv_id, turn, turns).

    Rows are ordered by turn, then by their turns (so repeated rows stay, and ties have one order). Rows whose ``turns``
    are NULL add nothing (``split_records`` sets records without a layout apart). The rows of a conversation meet in one row, since they are one text.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "turns")))
    together = turns.groupBy("conv_id").agg(ordered.alias("rows"))
    every = F.flatten(F.filter(F.transform("rows", lambda r: r["turns"]), lambda t: t.isNotNull()))
    return together.select("conv_id", formatted(every).alias("segments"))


def parsed(text: Column) -> Column:
    """Turns of a templated text."""

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        size = F.length(part) - F.length(role) - 1 - len(CLOSE) - 1
        body = F.substring(part, F.length(role) + 2, size)
        return F.struct(_unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    parts = F.filter(F.split(text, "<\\|im_start\\|>"), lambda p: p != "")
    return F.transform(parts, turn)


def conversation_digest(output: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted conversations."""
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    masked = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")

    def digest(t: Column, turns: Column, loss: Column) -> Column:
        joined = F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
        return F.struct(
            F.size(turns).cast("bigint").alias("n_turns"),
            F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
            F.length(loss).cast("bigint").alias("loss_chars"),
            F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
            F.length(t).cast("bigint").alias("formatted_chars"),
        )

    whole = let(text, lambda t: let(parsed(t), lambda turns: let(masked, lambda loss: digest(t, turns, loss))))
    return output.select("conv_id", whole.alias("d")).select("conv_id", "d.*")
