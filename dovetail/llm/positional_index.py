"""Benchmark decontamination by a distributed positional inverted index.

The index holds one posting (term, document, position) per training token, in
Parquet, sorted by term inside each file: it is built by one pass over the
texts without a shuffle and serves every later test set. A term is the 64-bit
hash of its word.

A window of test words (ten, or all words of a shorter item) is looked up by
its RAREST rarest terms. Their posting lists, shifted by the place of the term
in the item, meet where a document holds them at the same distances: on a
diagonal (item, document, shift). Diagonals with fewer of an item's rare terms
than a window must have are dropped; the text along the others is compared
word by word, which also settles hash collisions. A window with a word the
index does not know cannot occur and is never looked up.

Scale: the index is read with the rare terms of the test set as the small side
of a join (broadcast only while its written size is under the session's
threshold; else both sides are shuffled by term). Lists are reduced by map-side
combine. Texts move only if the matching documents are too many to broadcast
their ids. A passage shared by a third of all documents costs each a diagonal.

Defined cases: a null text has no words and a text without words no windows; an
item without words matches nothing; equal item_ids are one item, and a null one
is listed as the empty string; rows repeated in full get the same result each;
a null doc_id is kept; empty documents, or an empty benchmark, give an empty or
clean result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dovetail.llm.common import core, documents_core, materialise, once, same_row

WINDOW = 10
RAREST = 3
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LONG = "bigint"


def tokens(text: Column) -> Column:
    """Words with A-Z lower-cased: runs of 0-9, a-z and all that is not ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), A_TO_Z, A_TO_Z.lower()), BREAK), "")


def _docs(docs: DataFrame) -> DataFrame:
    d = documents_core(docs)
    return d.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text")


def build_index(docs: DataFrame) -> DataFrame:
    """Postings (term, doc, pos) of every token, stored."""
    d = _docs(docs).select("doc", F.posexplode(tokens(F.col("text"))).alias("pos", "word"))
    return materialise(d.select(F.xxhash64("word").alias("term"), "doc", "pos").sortWithinPartitions("term"), "postings")


def test_items(benchmark: DataFrame) -> DataFrame:
    """item, item_id (text), its words, window length m; one row per distinct item with words."""
    b = core(benchmark, ("item_id", "bigint"), ("text", "string"))
    b = once(b, w=tokens(F.col("text"))).where(F.size("w") > 0)
    b = b.select(F.xxhash64("item_id", "w").alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                 "w", F.least(F.size("w"), F.lit(WINDOW)).alias("m")).distinct()
    return materialise(b, "items")


def rare_terms(items: DataFrame, index: DataFrame) -> DataFrame:
    """(item, p, term, need): the places of an item to look up, and how many of
    them any of its windows has on its diagonal."""
    at = items.select("item", "m", F.size("w").alias("size"), F.posexplode("w").alias("p", "word")).select(
        "item", "m", "size", "p", F.xxhash64("word").alias("term"))
    terms = materialise(at.select("term").distinct(), "test-terms")
    df = materialise(index.select("term").join(terms, "term").groupBy("term").agg(F.count("*").alias("df")), "test-df")
    known = at.join(df, "term")
    # the windows a place is in; windows with an unknown word are left out
    first, last = F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)), F.least(F.col("p"), F.col("size") - F.col("m"))
    inside = known.select("item", "m", "p", "term", "df", F.explode(F.sequence(first, last)).alias("start"))
    w = Window.partitionBy("item", "start")
    ranked = inside.select("*", F.count("*").over(w).alias("n"), F.row_number().over(w.orderBy("df", "p")).alias("r"))
    picked = ranked.where((F.col("n") == F.col("m")) & (F.col("r") <= RAREST))
    return materialise(picked.select("item", "p", "term", F.least("m", F.lit(RAREST)).alias("need")).distinct(), "rare-terms")


def diagonals(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(doc, item, shift) that hold enough of an item's rare terms."""
    met = index.join(rare, "term").select("doc", "item", (F.col("pos") - F.col("p")).alias("shift"), "need")
    return met.groupBy("doc", "item", "shift", "need").agg(F.count("*").alias("n")).where("n >= need").select("doc", "item", "shift")


def exact_matches(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, doc, item_id and the places (array) of all words inside exact
    occurrences of the item's windows, for each diagonal that has one."""
    by_doc = materialise(found.groupBy("doc").agg(F.collect_list(F.struct("item", "shift")).alias("along")), "diagonals")
    d = once(_docs(docs).join(by_doc, "doc"), w=tokens(F.col("text"))).select("doc_id", "doc", "w", "along")
    sizes = items.select("item", "item_id", "m", F.col("w").alias("iw"))
    # cut each diagonal's stretch out of the row before rows are multiplied
    longest = items.agg(F.max(F.size("w"))).first()[0] or 1
    part = F.transform("along", lambda x: F.struct(
        x["item"].alias("item"), x["shift"].alias("shift"), F.greatest(x["shift"], F.lit(0)).alias("start"),
        F.slice("w", F.greatest(x["shift"], F.lit(0)) + 1, F.lit(longest)).alias("dw")))
    rows = d.select("doc_id", "doc", F.inline(part)).join(sizes, "item")
    # words past the item's end compare with null and count as unequal
    rows = once(rows, same=F.transform("dw", lambda x, i: F.coalesce(
        x == F.get("iw", i + F.col("start") - F.col("shift")), F.lit(False))))
    whole = F.filter(F.sequence(F.lit(0), F.greatest(F.size("same") - F.col("m"), F.lit(0))), lambda s: (
        F.size(F.filter(F.slice("same", s + 1, F.col("m")), lambda x: x)) == F.col("m")))
    rows = once(rows, at=whole).where(F.size("at") > 0)
    places = F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(
        F.col("start") + s, F.col("start") + s + F.col("m") - 1))))
    return rows.select("doc_id", "doc", "item_id", places.alias("places"))


def proximity_terms(items: DataFrame, index: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Known places (item, p, term, wanted: words a match holds), and of these
    the rarest (item, p, term, need): enough that a match holds ``need`` of them
    whichever words it lacks. Items of which too many words are unknown to the
    index have none, as no document can hold them."""
    at = items.select("item", F.size("w").alias("size"), F.posexplode("w").alias("p", "word")).select(
        "item", "p", F.xxhash64("word").alias("term"), F.ceil(F.col("size") * share - 1e-9).alias("wanted"))
    terms = materialise(at.select("term").distinct(), "near-terms")
    df = materialise(index.select("term").join(terms, "term").groupBy("term").agg(F.count("*").alias("df")), "near-df")
    w = Window.partitionBy("item")
    known = at.join(df, "term").select("*", F.count("*").over(w).alias("k"), F.row_number().over(w.orderBy("df", "p")).alias("r"))
    known = materialise(known.where("k >= wanted"), "near-places")
    need = F.least(F.lit(RAREST), F.col("wanted"))
    rare = known.where(F.col("r") <= F.col("k") - F.col("wanted") + need).select("item", "p", "term", need.alias("need"))
    return known.select("item", "p", "term", "wanted"), rare


def proximity_matches(index: DataFrame, items: DataFrame, slack: int = 5, share: float = 0.8) -> DataFrame:
    """(doc, item_id, terms): documents that hold at least ``share`` of an
    item's words with shifts at most ``slack`` apart, words inserted, replaced or
    left out between them notwithstanding. Shifts are met in overlapping bands
    of twice the slack, so no match falls between two. The rarest places find
    candidates; all known places are then counted in these."""
    known, rare = proximity_terms(items, index, share)
    low = F.floor((F.col("pos") - F.col("p")) / (slack + 1))
    met = index.join(rare, "term").select("doc", "item", "p", "need", F.explode(F.array(low, low + 1)).alias("band")).distinct()
    found = materialise(met.groupBy("doc", "item", "band", "need").agg(F.count("*").alias("n")).where("n >= need").select(
        "doc", "item", "band"), "near-candidates")
    held = index.join(found, "doc").join(known, ["item", "term"]).where(low.isin(F.col("band"), F.col("band") - 1))
    n = held.select("doc", "item", "band", "p", "wanted").distinct().groupBy("doc", "item", "band", "wanted").agg(
        F.count("*").alias("terms")).where("terms >= wanted")
    near = n.groupBy("doc", "item").agg(F.max("terms").alias("terms"))
    return near.join(items.select("item", "item_id"), "item").select("doc", "item_id", "terms")


def near_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_near, near_items (item_ids by :func:`proximity_matches`, sorted) of every row."""
    near = proximity_matches(build_index(docs), test_items(benchmark))
    listed = near.select("doc", "item_id").distinct().groupBy("doc").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    out = _docs(docs).select("doc_id", "doc").join(materialise(listed, "near-hits"), "doc", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select("doc_id", F.size(ids).cast(LONG).alias("n_near"), F.array_join(ids, ",").alias("near_items"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """:func:`exact_matches`, from an index built for the occasion."""
    index = build_index(docs)
    items = test_items(benchmark)
    found = diagonals(index, rare_terms(items, index))
    return materialise(exact_matches(docs, items, found), "matches")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    hits = matches(docs, benchmark)
    n_hit = hits.select("doc_id", "doc", F.explode("places").alias("p")).distinct().groupBy("doc_id", "doc").agg(
        F.count("*").alias("n_hit"))
    listed = hits.select("doc_id", "doc", "item_id").distinct().groupBy("doc_id", "doc").agg(
        F.sort_array(F.collect_list("item_id")).alias("ids"))
    per_doc = materialise(same_row(n_hit, listed, "inner", "doc_id", "doc"), "hits")
    # A-Z are word characters here, so the count needs no lower-casing
    d = _docs(docs).select("doc_id", "doc", F.size(F.array_remove(F.split(
        F.coalesce("text", F.lit("")), BREAK), "")).cast(LONG).alias("n_words"))
    out = same_row(d, per_doc, "left", "doc_id", "doc")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast(LONG)).alias("n_hit"),
                      F.size(ids).cast(LONG).alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = materialise(matches(docs, benchmark).select("doc").distinct(), "contaminated")
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    d = docs.select(own, F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string")).alias("doc"))
    return d.join(bad, "doc", "left_anti").select("row.*")
