"""Incremental secret scan over content-addressed texts.

A text is known by the SHA-256 of its bytes (its blob), however many paths,
copies or historical versions carry it. The ledger is a Parquet table with one
row per (blob, rule, rule version) that was scanned and the spans found. A run
scans only pairs the ledger does not hold, appends them, and joins the spans
back to every path of the blob: a re-run scans nothing, a new rule version
scans each blob once, a copy is never scanned.

Positions come from built-in regex functions alone: ``split`` gives the gaps
and ``regexp_extract_all`` the matches of the same left-to-right search, so the
k-th match starts at the summed lengths of k+1 gaps and k matches. Positions
count code points, ends are exclusive.

Scale: blobs are grouped by hash with map-side combine (a hot blob costs a row
per task), texts move once, spread by doc_id, and spans are written before they
are joined back, so that adaptive execution can split a hot blob's paths.
``commit`` keeps which blob stood at which path in which version; ``history``
joins findings back to all of them.

Defined cases: a text of any length and content is scanned whole (no pattern
recurses with it); a null text is the empty text; a null doc_id is kept; rows
repeated in full each get their row; an empty table gives an empty result;
columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dovetail.llm.common import documents_core, materialise, same_row
from dovetail.session import scratch_dir

LONG = "bigint"
BUFFER = 256


@dataclass(frozen=True)
class Rule:
    """A pattern; where ``group`` is set, the match counts if that group has
    ``least`` characters. ``hint``: a cheaper pattern every match contains;
    ``plain``: the pattern in the common syntax, where it uses Java's own."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str = ""
    plain: str = ""


# The three base kinds (order as listed), then kinds of this method.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, hint=r"(?i:passw|secret|token|api_?key)"),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
# A private key: from its BEGIN line to the END line that is its next five dashes;
# where there is none, to the end of the header and base64 lines that follow (of
# these, all but the last have 16 characters or more). Loops over groups are
# possessive: Java runs them as loops, not by recursion, so no length overflows
# the stack, and none needs a bound.
_KEY = r"[A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
_BASE64 = "[A-Za-z0-9+/=]"
_BETWEEN = r"""(?:[\s>|#*"',+]|\\[nr])*+"""
_TAIL = (rf"(?:{_BETWEEN}[A-Za-z][A-Za-z0-9-]*: [^\r\n]*)*+"
         rf"(?:(?:{_BETWEEN}{_BASE64 * 16}(?:[A-Za-z0-9+/=\r\n]*{_BASE64})?)++(?:(?:[\r\n]|\\[nr]){_BETWEEN}{_BASE64}+)?)?")
_PEM = rf"-----BEGIN {_KEY}(?:(?:[^-]++|-(?!----))*+-----END {_KEY}|{_TAIL})"
#: The same for engines without possessive loops and look-ahead, which do not recurse either.
PEM_PLAIN = (rf"-----BEGIN {_KEY}(?:[^-]*(?:-{{1,4}}[^-]+)*-----END {_KEY}|" + _TAIL.replace("*+", "*").replace("++(?:", "+(?:") + ")")
MORE = (
    Rule("pem", 3, _PEM, hint=r"-----BEGIN [A-Z ]*PRIVATE KEY", plain=PEM_PLAIN),
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
SPAN = "struct<s:bigint,k:int,e:bigint>"
LEDGER = f"blob binary, kind string, version int, spans array<{SPAN}>"


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<s, k, e>>: start, order of the kind, end of every match that counts."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sized = F.transform(F.arrays_zip(
        F.transform(F.split(text, rule.pattern), lambda g: F.length(g).cast(LONG)).alias("g"),
        F.transform(found, lambda m: F.length(m).cast(LONG)).alias("m"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("n")),
        lambda z: F.struct(z["g"].alias("g"), z["m"].alias("m"), z["n"].alias("n")))
    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).cast(LONG).alias("at"), none.alias("out"), none.alias("buf"))

    def step(a: Column, z: Column) -> Column:
        end = a["at"] + z["g"] + z["m"]
        one = F.array(F.struct((a["at"] + z["g"]).alias("s"), F.lit(order).alias("k"), end.alias("e")))
        full = F.size(a["buf"]) >= BUFFER  # appended in two steps: a long list is not copied for each match
        return F.when(z["m"].isNull(), a).when(z["n"] < rule.least, F.struct(
            end.alias("at"), a["out"].alias("out"), a["buf"].alias("buf"))).otherwise(F.struct(
                end.alias("at"), F.when(full, F.concat(a["out"], a["buf"])).otherwise(a["out"]).alias("out"),
                F.when(full, one).otherwise(F.concat(a["buf"], one)).alias("buf")))

    walked = F.aggregate(sized, start, step, lambda a: F.concat(a["out"], a["buf"]))
    return F.when(text.rlike(rule.hint or rule.pattern), walked).otherwise(none)


def _seen(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Pairs scanned so far; a ledger that is not there yet has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(LEDGER).parquet(ledger_path)
    return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` does not hold, append it there,
    and return the whole ledger."""
    spark = docs.sparkSession
    versions = documents_core(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "blob", blob(F.col("text")))
    wanted = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                                 for r in rules])).alias("r")
    # one row stands for a blob: its smallest doc_id (null where all are null)
    reps = versions.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    pairs = reps.select("blob", "doc_id", wanted).select("blob", "doc_id", "r.kind", "r.version")
    unseen = pairs.join(_seen(spark, ledger_path).select("blob", "kind", "version"),
                        ["blob", "kind", "version"], "left_anti")
    todo = unseen.groupBy("blob", "doc_id").agg(F.collect_set("kind").alias("kinds"))
    texts = same_row(versions, todo, "inner", "doc_id", "blob")
    scanned = texts.select("blob", F.explode(F.array(*[
        F.when(F.array_contains("kinds", r.kind), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
            spans(F.col("text"), r, i).alias("spans"))) for i, r in enumerate(rules)])).alias("f"))
    new = scanned.where("f is not null").select("blob", "f.kind", "f.version", "f.spans").dropDuplicates(
        ["blob", "kind", "version"])  # a representative row may be repeated in full
    new.write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def located(paths: DataFrame, ledger_rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` (with a blob) and the spans of their blobs under the current rule versions."""
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    # the same pair may stand in the ledger twice (runs that overlapped, a retried append): its spans are equal
    by_blob = ledger_rows.where(current & (F.size("spans") > 0)).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    # written before it is joined: the rows of a hot blob can then be split
    by_blob = materialise(by_blob, "secret-spans").withColumnRenamed("blob", "b")
    out = paths.join(by_blob, F.col("blob") == F.col("b"), "left").drop("b")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")))


def findings(docs: DataFrame, ledger_rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path (row) with all spans of its blob under the current rule versions."""
    return located(documents_core(docs).select("doc_id", blob(F.col("text")).alias("blob")), ledger_rows, rules)


_PATHS = "doc_id bigint, blob binary, version bigint"


def commit(docs: DataFrame, store: str, version: int, rules: tuple[Rule, ...] = RULES) -> None:
    """Record one version of the corpus in ``store``: which blob stands at which
    path, and the spans of blobs no earlier version had. Committing a version
    again writes the same."""
    paths = documents_core(docs).select("doc_id", blob(F.col("text")).alias("blob")).distinct()
    paths.write.mode("overwrite").parquet(f"{store}/paths/version={int(version)}")
    scan(docs, f"{store}/ledger", rules)


def history(spark: SparkSession, store: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, version, spans of every path in every committed version that held a secret."""
    paths = spark.read.schema(_PATHS).option("basePath", f"{store}/paths").parquet(f"{store}/paths")
    found = located(paths, spark.read.schema(LEDGER).parquet(f"{store}/ledger"), rules)
    return found.where(F.size("spans") > 0).select("doc_id", "version", "spans")


def _joined(spans_: Column) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans, by path."""
    path = ledger_path or scratch_dir(docs.sparkSession, "secret-ledger")
    found = findings(docs, scan(docs, path))

    def count(kind: int) -> Column:  # a filter's lambda takes one argument: a second would be the index
        return F.size(F.filter("spans", lambda x: x["k"] == kind)).cast(LONG)

    n = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    base = F.filter("spans", lambda x: x["k"] < len(BASE))
    return found.select("doc_id", *n, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


MASK = "[SECRET]"


def redact(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """The documents, every found span replaced by a mask; n_chars follows the
    text. Spans come from the ledger by blob; overlapping spans become one."""
    spark = docs.sparkSession
    path = ledger_path or scratch_dir(spark, "secret-ledger")
    rows = scan(docs, path).where(F.size("spans") > 0).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("sp"))
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    d = docs.select(own, blob(docs["text"].cast("string")).alias("b"))
    hit = d.join(materialise(rows, "secret-spans").withColumnRenamed("blob", "b"), "b", "left")
    text = F.col("row.text")
    start = F.struct(F.lit(0).cast(LONG).alias("at"), F.array().cast("array<string>").alias("out"))
    # the part before a span that starts at or after the last end, then the mask
    cut = F.aggregate("sp", start, lambda a, x: F.struct(
        F.greatest(a["at"], x["e"]).alias("at"),
        F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(
            F.substring(text, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")), F.lit(MASK)))
        ).otherwise(a["out"]).alias("out")))
    joined = F.transform(F.array(cut), lambda c: F.concat(F.array_join(c["out"], ""), F.substring(
        text, (c["at"] + 1).cast("int"), F.length(text))))[0]
    new = F.when(F.col("sp").isNull(), text).otherwise(joined)
    hit = hit.select("row", new.alias("new"))
    cols = []
    for f in docs.schema.fields:
        c = F.col(f"row.`{f.name}`")
        if f.name == "text":
            c = F.col("new").cast(f.dataType)
        elif f.name == "n_chars":
            c = F.when(F.col("new").eqNullSafe(text), c).otherwise(F.length("new")).cast(f.dataType)
        cols.append(c.alias(f.name))
    return hit.select(*cols)
