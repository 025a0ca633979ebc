"""Quality rules kept as a bitmask ledger.

Every rule is evaluated once per document. The ledger row holds the raw
measurements and one bit per failed rule; which rules count is the business of
a versioned policy, a second bitmask. Changing the policy, or asking what a
rule costs, reads the ledger and never the texts again.

All work inside a document is done with array functions on its row: there is
no shuffle, a very long text costs n log n, and a hot source means nothing.

Defined cases: a null or blank text has no words and fails ``too_few_words``;
repeated rows give repeated ledger rows; a null doc_id is kept; an empty table
gives an empty ledger; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import documents_core, materialise, once, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LONG = "bigint"


def _repeat_words(tokens: Column, hashes: Column) -> Column:
    """Words inside windows of WINDOW words that occur at least twice.

    Windows are compared by 64-bit hash. Texts without an equal pair (the
    usual case) stop at one distinct; for the others (hash, position) pairs
    are sorted, positions next to an equal hash kept, and the stretch each
    position adds up to the next one summed."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(ps: Column) -> Column:
        return F.transform(F.filter(ps, lambda p, k: (
            ((k > 0) & (F.try_element_at(ps, F.greatest(k, F.lit(1)))["h"] == p["h"]))
            | F.coalesce(F.try_element_at(ps, k + 2)["h"] == p["h"], F.lit(False)))), lambda p: p["i"])

    # one-element transforms name an intermediate array so that it is built once
    at = F.transform(F.array(pairs), lambda ps: F.array_sort(repeated(ps)))
    covered = F.transform(at, lambda s: F.aggregate(
        F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.try_element_at(s, k + 2) - p, F.lit(WINDOW)))),
        F.lit(0).cast(LONG), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast(LONG)).otherwise(covered[0])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every document."""
    return _measure(documents_core(docs))


def _measure(rows: DataFrame) -> DataFrame:
    """Of rows (doc_id, text); the doc_id can be of any type."""
    d = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = once(d, w=words(F.col("t")))
    d = d.select("doc_id", "t", "w", F.size("w").cast(LONG).alias("n_words"),
                 F.filter(F.split("t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("ln"))
    grams = F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice("w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    d = once(d, g=grams)
    return d.select(
        "doc_id", "n_words",
        F.length(F.array_join("w", "")).cast(LONG).alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast(LONG).alias("n_symbols"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast(LONG).alias("n_dup_lines"),
        F.size("ln").cast(LONG).alias("n_lines"),
        _repeat_words(F.col("w"), F.col("g")).alias("n_repeat_words"))


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` holds; ``bit`` never changes meaning."""
    bit: int
    name: str
    fails: str


# Ratios are compared in whole numbers; limits are those usual for web text.
RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols_per_word", "10 * n_symbols > 4 * n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    """The rules a version of the filter applies, as a bitmask."""
    version: str
    mask: int


POLICIES = {p.version: p for p in (Policy("base", BASE), Policy("v1", 0b1111), Policy("v2", 0b111111))}
CURRENT = "v2"


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits`` (bit r set: rule r fails), every rule evaluated once."""
    return _with_bits(measure(docs))


def _with_bits(measured: DataFrame) -> DataFrame:
    bits = F.lit(0).cast(LONG)
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast(LONG))
    return once(measured, fail_bits=bits)


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """``base_failed`` and ``kept`` under a policy, read from the bits alone."""
    mask = POLICIES[version].mask | BASE
    return rows.select("*", (F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"),
                       (F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0).alias("kept"))


def ablations(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents it fails, documents only it fails
    (they come back if it is dropped) and those kept without it. One
    aggregation over the distinct bitmasks, of which there are at most 2^rules."""
    mask = POLICIES[version].mask
    by_bits = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("b")).agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    rules = spark.createDataFrame([(r.name, 1 << r.bit) for r in RULES if mask >> r.bit & 1], "rule string, bit bigint")
    # rows of by_bits carry each rule by an explode of a literal array: no join
    one = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast(LONG).alias("bit"))
                              for r in RULES if mask >> r.bit & 1])).alias("r")
    x = by_bits.select("b", "n", one)
    got = x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("b").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("b").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"))
    return rules.join(got, "rule", "left").select("rule", *[F.coalesce(c, F.lit(0)).cast(LONG).alias(c) for c in (
        "n_failed", "n_failed_alone", "n_kept_without")])


def judge(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger, stored once, under a policy."""
    return apply_policy(materialise(ledger(docs), "quality-ledger"), version)


def filter_documents(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """Documents the policy keeps, with all their columns. The bits are made
    on the rows themselves: one pass, and no join back."""
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(own.alias("doc_id"), docs["text"].cast("string").alias("text"))
    return apply_policy(_with_bits(_measure(rows)), version).where("kept").select("doc_id.*")
