"""Comment moderation, block-list membership and the allowed-charset filter
over ``documents`` (comments are documents whose id is an order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dovetail.operators.windows import latest_per_key
from dovetail.registry import query
from dovetail.sources.literal import literal_table
from dovetail.sources.tables import load

# Fixed values (test fixture): the block list. The reference's list is
# offensive; these are neutral invented words that occur in the test prose.
BLOCK_WORDS = ["queeux", "ouaux", "aich", "étre", "outre", "menteux", "leaux", "aipa", "eauch", "nicht", "anwh",
               "heble"]

# Characters a clean comment may consist of (CJK ideographs,
# ASCII letters and digits, listed punctuation), whole line.
ALLOWED_RE = r'^[一-龥a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+$'

_WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in BLOCK_WORDS) + "]"


def block_list(spark):
    return literal_table(spark, [(w,) for w in BLOCK_WORDS], "word string")


def comments(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return d.join(o, d.doc_id == o.o_orderkey, "left").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("text").alias("msg"), F.col("o_orderdate").alias("ts"))


@query("moderate_comments", f"""
    WITH c AS (SELECT doc_id AS id, o_custkey AS user_id, text AS msg, strftime(o_orderdate, '%Y%m%d') AS ds
               FROM documents LEFT JOIN orders ON doc_id = o_orderkey),
         w AS (SELECT *, regexp_replace(msg, ',+$', '') AS trimmed FROM c),
         l AS (SELECT *, CASE WHEN contains(trimmed, ',') THEN regexp_extract(trimmed, '[^,]*$') ELSE trimmed END
                         AS last_part FROM w),
         f AS (SELECT *, list_transform(list_sort(list_transform(
                    list_filter({_WORDS_SQL}, lambda x: instr(msg, x) > 0), lambda x: {{'pos': instr(msg, x), 'w': x}})),
                    lambda s: s.w) AS found FROM l)
    SELECT id, user_id, ds,
           CASE WHEN list_contains({_WORDS_SQL}, last_part) THEN 1 ELSE 0 END AS is_violation,
           CASE WHEN list_contains({_WORDS_SQL}, last_part) THEN 'P0' WHEN len(found) > 0 THEN 'P1' ELSE '' END
               AS violation_grade,
           CASE WHEN list_contains({_WORDS_SQL}, last_part) THEN last_part
                WHEN len(found) > 0 THEN array_to_string(found, ', ') ELSE '' END AS violation_msg
    FROM f""")
def moderate_comments(spark, sf_dir):
    """Comments de-duplicated on order and time, moderated: last
    comma-separated part on the block list -> P0 (``is_violation=1``); else
    every listed word contained in the whole text -> P1 with the words in
    order of appearance, joined by ', ' (``is_violation`` stays 0 as in the
    reference). The list is a literal array: a projection, no join, no
    per-row lookup service."""
    return moderate(comments(spark, sf_dir))


def moderate(c):
    """Flags first, then the de-duplication: ids and flags move, texts do not."""
    words = F.array(*[F.lit(w) for w in BLOCK_WORDS])
    trimmed = F.regexp_replace("msg", ",+$", "")
    last = F.element_at(F.split(trimmed, ","), -1)
    found = F.transform(F.array_sort(F.transform(F.filter(words, lambda w: F.instr("msg", w) > 0),
                                                 lambda w: F.struct(F.instr("msg", w).alias("pos"), w.alias("w")))),
                        lambda s: s["w"])
    p0 = F.array_contains(words, last)
    flagged = c.select("id", "order_id", "user_id", "ts", F.when(p0, last).alias("p0"), F.array_join(found, ", ").alias("p1"))
    one = latest_per_key(flagged, ["order_id", "ts"], ["id", "p0", "p1"])
    is_p0 = F.col("p0").isNotNull()
    return one.select(
        "id", "user_id", F.date_format("ts", "yyyyMMdd").alias("ds"), F.when(is_p0, 1).otherwise(0).alias("is_violation"),
        F.when(is_p0, "P0").when(F.col("p1") != "", "P1").otherwise("").alias("violation_grade"),
        F.when(is_p0, F.col("p0")).otherwise(F.coalesce("p1", F.lit(""))).alias("violation_msg"))


@query("blocklist_membership", f"""
    SELECT DISTINCT w AS word, list_contains({_WORDS_SQL}, w) AS is_blocked
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\pL]+')) AS w FROM documents) t
    WHERE w <> ''""")
def blocklist_membership(spark, sf_dir):
    """Bulk membership: every distinct word of the documents against the block
    list (broadcast left join of a bounded list)."""
    d = load(spark, sf_dir, "documents")
    words = d.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where(F.col("word") != "") \
        .distinct()
    b = F.broadcast(block_list(spark).withColumn("hit", F.lit(True)))
    return words.join(b, "word", "left").select("word", F.coalesce("hit", F.lit(False)).alias("is_blocked"))


@query("text_charset_filter", f"""
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE regexp_matches(line, '{ALLOWED_RE}')) AS n_allowed
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) l GROUP BY doc_id""")
def text_charset_filter(spark, sf_dir):
    """Per document: lines, and lines made only of allowed characters."""
    d = load(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"),
                                       F.count(F.when(F.col("line").rlike(ALLOWED_RE), 1)).alias("n_allowed"))
