"""String expressions on built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a run of digits and blanks that starts and ends with a digit. ``(?U)`` makes the
# word boundary and the digit class follow Unicode.
DIGIT_RUN = r"(?U)\b(\d[\d ]{0,11}\d)\b"
SIREN_LENGTH = 9


def present(column: Column) -> Column:
    """NULL for the empty string, the value otherwise."""
    return F.nullif(column, F.lit(""))


def siren_in_text(text: Column) -> Column:
    """Nine-digit identifier in the first digit run of ``text``; NULL when that run is not one.

    ``text`` may hold a JSON array of strings, of which only the first element is read.
    """
    listed = F.from_json(text, "array<string>")
    is_list = text.startswith("[") & listed.isNotNull()
    first = F.when(is_list, F.get(listed, F.lit(0))).otherwise(text)
    digits = F.replace(F.regexp_extract(first, DIGIT_RUN, 1), F.lit(" "), F.lit(""))
    return F.when(F.length(digits) == SIREN_LENGTH, digits)


def person_name(surname: Column, given: Column) -> Column:
    """``surname given``; NULL without a surname, whatever the given name says."""
    full = F.trim(F.concat_ws(" ", surname, present(given)))
    return F.when(present(surname).isNotNull(), F.when(present(given).isNull(), surname).otherwise(full))


def folded(*parts: Column) -> Column:
    """Lower-case text of the blank-joined parts, NULL read as empty."""
    joined = F.concat_ws(" ", *[F.coalesce(part, F.lit("")) for part in parts])
    return F.lower(F.trim(joined))


def segment_keys(text: Column, depth: int, parts: int | None = None) -> Column:
    """Hashes of the segments that a text is cut into (``depth + 1`` unless told), each with its place and the text's length.

    At most ``depth`` edits leave all but ``depth`` segments as they are, so a text within that Levenshtein distance
    has one of any ``depth + 1`` of these hashes among its ``segment_probes``: a similarity join becomes an
    equality join, with a number of keys that does not grow with the texts.
    """
    parts = parts or depth + 1
    size = F.length(text)
    step = F.floor(size / parts).cast("int")
    return F.array(*(_segment(text, size, step, parts, i, i * step) for i in range(parts)))


def segment_probes(text: Column, depth: int, parts: int | None = None) -> Column:
    """Hashes of all segments that a text within ``depth`` edits of this one may have unchanged.

    The other text's length, and the place of an unchanged segment, differ by at most ``depth``.
    """
    own, n, wide = F.length(text), parts or depth + 1, 2 * depth + 1

    def probe(k: Column) -> Column:
        size = own + F.floor(k / (n * wide)).cast("int") - depth
        i = F.floor(k / wide).cast("int") % n
        step = F.floor(size / n).cast("int")
        start = i * step + k % wide - depth
        length = F.when(i < n - 1, step).otherwise(size - (n - 1) * step)
        fits = (size >= 0) & (start >= 0) & (start + length <= own)
        return F.when(fits, _hashed(size, i, text.substr(start + 1, length)))

    every = F.transform(F.sequence(F.lit(0), F.lit(n * wide * wide - 1)), probe)
    return F.array_distinct(F.array_compact(every))


def _segment(
    text: Column, size: Column, step: Column, parts: int, i: int, start: Column
) -> Column:
    length = step if i < parts - 1 else size - (parts - 1) * step
    return _hashed(size, F.lit(i), text.substr(start + 1, length))


def _hashed(size: Column, place: Column, segment: Column) -> Column:
    return F.xxhash64(size.cast("int"), place.cast("int"), segment)


MASK_WORDS = 2


def with_character_masks(df: DataFrame, text: str, suffix: str) -> DataFrame:
    """Adds ``length_<suffix>`` and the bit masks ``mask<i>_<suffix>`` of a text column.

    A mask holds the (character, n-th occurrence) pairs of the text, 64 bits per word. A bit set in
    one text's masks and not in another's stands for at least one character that the other lacks.
    """
    low = [F.lit(64 * i) for i in range(MASK_WORDS)]
    one = F.lit(1).cast("long")

    def word(first: Column) -> Column:
        here = F.filter("_slots", lambda s: s.between(first, first + 63))
        return F.aggregate(
            here,
            F.lit(0).cast("long"),
            lambda mask, s: mask.bitwiseOR(
                F.call_function("shiftleft", one, (s - first).cast("int"))
            ),
        )

    # Each step is a column of its own: an expression inside a lambda is computed per element.
    chars = df.withColumn("_chars", F.sort_array(F.array_remove(F.split(text, ""), "")))
    slots = chars.withColumn(
        "_slots",
        F.transform(
            "_chars",
            lambda c, i: F.pmod(
                F.xxhash64(c, i - F.array_position("_chars", c).cast("int")),
                F.lit(64 * MASK_WORDS),
            ),
        ),
    )
    added = {f"length_{suffix}": F.length(text).cast("double")}
    added |= {f"mask{i}_{suffix}": word(first) for i, first in enumerate(low)}
    # Columns that cannot be NULL: a join on them would otherwise filter for that first, computing
    # them a second time.
    zero = F.lit(0)
    return slots.withColumns({name: F.coalesce(c, zero) for name, c in added.items()}).drop(
        "_chars", "_slots"
    )
