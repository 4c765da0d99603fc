"""Quality rules as a ledger of failure bits: rules are evaluated once, policies are masks over the bits.

Everything is a column expression: nothing leaves the JVM, and a document is measured in one pass over its
text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.native import let, longs
from ledgerline.llm.tables import narrow, words

REPEAT_WINDOW = 8

#: Rule, its bit, and when a document fails it, over the measurements.
RULES: dict[str, tuple[int, Callable[[Column], Column]]] = {
    "few_words": (0, lambda m: m["n_words"] < 20),
    "repeated_windows": (1, lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    "symbols": (2, lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    "repeated_lines": (3, lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    "long_words": (4, lambda m: m["word_chars"] > 25 * m["n_words"]),
    "short_words": (5, lambda m: m["word_chars"] < 2 * m["n_words"]),
    "many_words": (6, lambda m: m["n_words"] > 1_000_000),
    "echoed_words": (7, lambda m: 10 * m["n_echo_words"] > 3 * m["n_words"]),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echo_words"]


def mask(*names: str) -> int:
    return sum(1 << RULES[n][0] for n in names)


BASE = mask("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the bits in ``required`` is set and at most ``tolerated`` of those in ``counted`` are."""

    required: int
    counted: int = 0
    tolerated: int = 0

    @property
    def bits(self) -> int:
        return self.required | self.counted

    def keeps(self, failed: Column, without: int = 0) -> Column:
        """Verdict over failure bits; rules in ``without`` are left out."""
        hard = failed.bitwiseAND(longs(self.required & ~without)) == 0
        return hard & (F.bit_count(failed.bitwiseAND(longs(self.counted & ~without))) <= self.tolerated)


#: Published policies stay as they are; a change is a new version.
POLICIES = {
    "v1": Policy(BASE),
    "v2": Policy(BASE | mask("symbols", "repeated_lines"), mask("long_words", "short_words"), 0),
    # Repeated lines say little about short texts: the rule is still measured, but rejects nothing.
    "v3": Policy(BASE | mask("symbols", "echoed_words"), mask("long_words", "short_words"), 0),
}
CURRENT = "v3"


def _repeat_words(found: Column) -> Column:
    """Words that lie in a window of eight words which the text has more than once, the first one included."""

    def repeated(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        none = F.struct(longs(0).alias("n"), F.lit(0).alias("upto"))

        def cover(seen: Column, i: Column) -> Column:
            fresh = F.lit(REPEAT_WINDOW) - F.greatest(seen["upto"] - i, F.lit(0))
            return F.struct((seen["n"] + fresh).alias("n"), (i + REPEAT_WINDOW).alias("upto"))

        def flagged(r: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                return F.coalesce(F.get(r, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(r, k + 1)["h"] == x["h"], F.lit(False))

            places = F.sort_array(F.transform(F.filter(r, twin), lambda x: x["i"]))
            return F.aggregate(places, none, cover, lambda seen: seen["n"])

        # Most texts repeat no window, and are done here.
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), longs(0)).otherwise(let(ranked, flagged))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - REPEAT_WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(REPEAT_WINDOW))))

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) < REPEAT_WINDOW, longs(0)).otherwise(let(let(hashes, windows), repeated))


def _echo_words(found: Column) -> Column:
    """Words that equal the word before them."""
    return F.size(F.filter(found, lambda w, i: (i > 0) & (F.get(found, i - 1) == w))).cast("bigint")


def measured(text: Column | str) -> Column:
    """Measurements of a whole text as a struct of numbers; a null or empty text measures zero everywhere."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))

    def all_of(found: Column) -> Column:
        return let(
            lines,
            lambda kept: F.struct(
                F.size(found).cast("bigint").alias("n_words"),
                F.length(F.array_join(found, "")).cast("bigint").alias("word_chars"),
                symbols.cast("bigint").alias("n_symbols"),
                F.size(kept).cast("bigint").alias("n_lines"),
                (F.size(kept) - F.size(F.array_distinct(kept))).cast("bigint").alias("n_dup_lines"),
                _repeat_words(found).alias("n_repeat_words"),
                _echo_words(found).alias("n_echo_words"),
            ),
        )

    return let(words(text), all_of)


def failure_bits(m: Column) -> Column:
    """Failure bits of a struct of measurements."""
    bits = longs(0)
    for bit, fails in RULES.values():
        bits = bits.bitwiseOR(F.when(fails(m), longs(1 << bit)).otherwise(longs(0)))
    return bits


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the measurements, and ``failed``, a bit for each rule that it fails.

    Repeated rows and null keys are kept as they are. A null, empty or blank text has no words and fails ``few_words``.
    """
    entry = let(measured("text"), lambda m: F.struct(*(m[c].alias(c) for c in MEASURES), failure_bits(m).alias("failed")))
    return narrow(docs, key, text).select("doc_id", entry.alias("entry")).select("doc_id", "entry.*")


def judged(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with the verdict of a policy: base_failed and kept."""
    failed = F.col("failed")
    return entries.withColumns({"base_failed": failed.bitwiseAND(longs(BASE)) != 0, "kept": POLICIES[policy].keeps(failed)})


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that are kept without it.

    Documents are first counted by their bits, so all rules follow from one aggregation to a few hundred rows
    at most (two to the number of rules).
    """
    rule, failed = POLICIES[policy], F.col("failed")
    counts = entries.groupBy(failed.bitwiseAND(longs(rule.bits)).alias("failed")).count()
    names = [(n, 1 << bit) for n, (bit, _) in RULES.items() if rule.bits >> bit & 1]
    parts = []
    for name, bit in names:
        parts += [
            F.struct(
                F.lit(name).alias("rule"),
                failed.bitwiseAND(longs(bit)).alias("fails"),
                (failed == bit).alias("alone"),
                rule.keeps(failed, without=bit).alias("kept_without"),
            )
        ]
    each = counts.select("count", F.explode(F.array(*parts)).alias("r")).select("count", "r.*")
    total = lambda condition: F.sum(F.when(condition, F.col("count")).otherwise(0))
    return each.groupBy("rule").agg(
        total(F.col("fails") != 0).alias("n_fails"), total(F.col("alone")).alias("n_alone"), total(F.col("kept_without")).alias("n_kept_without")
    )


def accepted(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    return docs.where(let(measured(docs[text]), lambda m: POLICIES[policy].keeps(failure_bits(m))))
