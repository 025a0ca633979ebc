"""How quality filters overlap: every order of five filters, per source.

A filter that compares a text with itself (A words, B distinct words, C capital
letters, D symbols) is a bit of one pass over the texts. The fifth, E, asks
whether a smaller doc_id has the same text: a left-semi join of the rows on
hash, exact text and a smaller doc_id. Its ids are put beside the other failure
ids and united per row by OR; rows are counted by part and bit combination.
From at most 32 counts of a part follow all 120 orders: what a step removes has
its bit and none of an earlier filter.

Scale: one pass reads the texts for the four bits and writes ids, hashes and
bits, no text. Only texts whose hash stands under two ids meet in the semi
join; its right side holds one row per distinct text, its smallest doc_id,
combined in each task before it moves, and is written out, so the many left
rows of one hot text can be split. Sources, ids and combinations are sums with
map-side combine; what one source holds after them is 32 rows.

Defined cases: a null text is the empty text; a null source is the part '';
a null doc_id is not smaller or larger than any (never E, never makes another
E, no label); rows repeated in full each count, and do not make each other E,
nor do texts of one doc_id; of repeated labels one that says 1 is enough; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import core, materialise, once, words

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
#: Orders of five filters in which one of n failing filters comes first, by n.
FIRST = {n: 120 // n for n in range(1, 6)}


def text_bits(text: Column, ws: Column) -> Column:
    """Bits of the filters that look at one text (``ws``: its words)."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {"A": F.size(ws) < 200,
             "B": F.size(F.array_distinct(ws)) * 100 < F.size(ws) * 50,
             "C": capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * 2,
             "D": text.rlike(r"[#$%&*|]")}
    out = F.lit(0)
    for f, c in fails.items():
        out = out + F.when(c, BIT[f]).otherwise(0)
    return out


def _rows(docs: DataFrame) -> DataFrame:
    d = core(docs, ("doc_id", "bigint"), ("text", "string"), ("source", "string"))
    text = F.coalesce("text", F.lit(""))
    return d.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"),
                    F.unhex(F.md5(text)).alias("hash"))


def exact_copies(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """Rows of ``rows`` (doc_id, part, text, hash) whose text a smaller doc_id
    has too. ``shared``: the hashes under two ids or more."""
    meet = rows.where("doc_id is not null").join(shared, "hash", "left_semi")
    least = materialise(meet.groupBy("hash", "text").agg(F.min("doc_id").alias("least")), "audit-least")
    least = least.select(F.col("hash").alias("h"), F.col("text").alias("t"), "least")
    return meet.join(least, (F.col("hash") == F.col("h")) & (F.col("text") == F.col("t"))
                     & (F.col("least") < F.col("doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bits of the filters a row fails), n, good, toxic."""
    rows = _rows(docs)
    seen = once(rows, ws=words(F.col("text"))).select("doc_id", "hash", "part", text_bits(F.col("text"), F.col("ws")).alias("bits"))
    ids = materialise(seen, "audit-ids")
    shared = materialise(ids.where("doc_id is not null").groupBy("hash").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("hash"), "audit-shared")
    copies = exact_copies(rows, shared).select("doc_id", "hash", "part", F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("n"))
    failures = ids.withColumn("n", F.lit(1)).unionByName(copies)
    masks = failures.groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))
    known = core(labels, ("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")).where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("bad"))
    return masks.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("toxic"))


def steps() -> list[tuple[str, int, int, int]]:
    """(order, step, its bit, bits of the steps before) of all orders."""
    out = []
    for p in permutations(FILTERS):
        before = 0
        for i, f in enumerate(p):
            out.append(("".join(p), i + 1, BIT[f], before))
            before |= BIT[f]
    return out


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step."""
    cells = combinations(docs, labels).groupBy("part").agg(  # 32 cells of a part at most
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    made = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "bit", "before"), s)) for s in steps()])),
                       "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    each = cells.select("part", "cells", F.explode(made).alias("s")).select("part", "cells", "s.*")
    bit, before = F.col("bit"), F.col("before")

    def total(value, test) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + F.when(test(c["mask"]), value(c)).otherwise(0))

    def has(m):
        return m.bitwiseAND(bit) != 0

    def here(m):
        return has(m) & (m.bitwiseAND(before) == 0)

    def n(c):
        return c["n"]

    def weight(c):
        bits = F.bit_count(c["mask"])
        return c["n"] * F.element_at(F.array(*[F.lit(FIRST[k]) for k in range(1, 6)]), F.greatest(bits, F.lit(1)))

    return each.select(
        "part", "filter_order", "step",
        total(n, lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(n, here).alias("removed"),
        total(n, lambda m: has(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total(n, lambda m: m == bit).alias("unique_fails"),
        total(lambda c: c["good"], here).alias("good_lost"),
        total(lambda c: c["toxic"], here).alias("toxic_lost"),
        total(weight, has).alias("shapley"))
