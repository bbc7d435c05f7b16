"""Quality rules as a ledger of failure bits, from DataFrame functions only.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule.
A policy is a named, versioned set of rules: applying it, comparing versions and ablations are then bit
operations on the ledger, which never reads a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Rules by bit: name and the condition under which a document fails, over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
)
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version of a policy: the rules that reject a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = [name for name, _ in RULES]
        return sum(1 << known.index(rule) for rule in self.rules)


BASE = Policy("base", 1, BASE_RULES)
POLICY = Policy("web", 2, BASE_RULES + ("many_symbols", "repeated_lines", "word_length"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _sorted_windows(words: Column) -> Column:
    """One number per window, ascending: equal windows are neighbours, and the number modulo their count is the place.

    A window's hash is rounded down to a multiple of the number of windows and its place added.
    """
    n = F.size(words) - (WINDOW - 1)

    def number(place: Column) -> Column:
        parts = [words[place + k] for k in range(WINDOW)]
        h = F.shiftrightunsigned(F.xxhash64(*parts), 2)
        return h - F.pmod(h, n.cast("bigint")) + place

    return F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), number))


def _repeat_words(words: Column) -> Column:
    """Words inside windows whose five words stand in the text twice or more."""
    n = F.size(words) - (WINDOW - 1)

    def places(numbers: Column) -> Column:
        size = F.size(numbers).cast("bigint")

        def place(x: Column) -> Column:
            return F.pmod(x, size).cast("int")

        def same(x: Column, y: Column) -> Column:
            # hashes decide first; the words themselves confirm
            return (x - F.pmod(x, size) == y - F.pmod(y, size)) & (
                F.slice(words, place(x) + 1, WINDOW) == F.slice(words, place(y) + 1, WINDOW)
            )

        def repeated(x: Column, i: Column) -> Column:
            before = (i > 0) & same(x, F.get(numbers, i - 1))
            after = (i < F.size(numbers) - 1) & same(x, F.get(numbers, i + 1))
            return before | after

        return F.sort_array(F.transform(F.filter(numbers, repeated), place))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            found,
            start,
            lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total")),
            lambda acc: acc["total"],
        )

    counted = let(_sorted_windows(words), lambda numbers: let(places(numbers), covered))
    return F.when(n >= 2, counted).otherwise(0).cast("bigint")


def measure(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements of every row: words, their characters, symbols, lines, repeats.

    A null text has no words. Other columns are ignored, repeated rows repeat.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def lines_of(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        let(words, of).alias("w"),
        let(lines, lines_of).alias("l"),
        (F.size(F.split(text, r"[#*$%&|<>]")) - 1).cast("bigint").alias("n_symbols"),
    )
    return rows.select(
        "doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines"
    )


def ledger(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements with ``failed``: bit k is set where rule k fails."""
    bits = [F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, condition) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(documents, id_col, text_col).withColumn("failed", failed)


def kept_by(policy: Policy) -> Column:
    """True where the ledger's row breaks none of the policy's rules."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def verdicts(rows: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """The contract's columns from a ledger: ``base_failed`` by the base rules, ``kept`` by base rules and policy."""
    base_failed = ~kept_by(BASE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (kept_by(policy) & ~base_failed).alias("kept"), "failed",
    )


def ablations(rows: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Per rule of the policy: documents that fail it, fail it alone, and would be kept without it.

    One pass of map-side sums over the bits, then one row per rule; an empty ledger gives zeros.
    """
    chosen = [(k, name) for k, (name, _) in enumerate(RULES) if name in policy.rules]
    broken = F.col("failed").bitwiseAND(F.lit(policy.mask))
    sums = [F.count_if(broken.bitwiseAND(F.lit(1 << k)) != 0).alias(f"f{k}") for k, _ in chosen]
    sums += [F.count_if(broken == (1 << k)).alias(f"a{k}") for k, _ in chosen]
    kept = F.count_if(broken == 0).alias("kept")
    table = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"f{k}").alias("n_failed"), F.col(f"a{k}").alias("n_alone"),
                 (F.col("kept") + F.col(f"a{k}")).alias("n_kept_without"))
        for k, name in chosen
    ])
    return rows.agg(F.count("*").alias("n"), kept, *sums).select(
        F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.explode(table).alias("r")
    ).select("policy", "version", "r.*")
