"""MinHash near-duplicates, verified with odd sketches.

A document's set is its distinct five-word shingles, as 64-bit hashes. Two kinds
of MinHash samples are taken of it. MINHASHES smallest values under as many hash
functions, in bands of ROWS, make the bucket keys that find candidates. The
smallest shingle hashes themselves (all of a set up to SAMPLE, below a threshold
that halves for every doubling of the set beyond) are folded into the odd
sketch: a bitmap in which each sample toggles one bit. The XOR of two odd
sketches is the odd sketch of the samples in which the sets differ; from its
population count p that number is estimated as ``-(BITS / 2) ln(1 - 2 p /
BITS)``, most precisely where it is small, and with the numbers of samples gives
the similarity. A candidate pair whose estimate is more than SIGMAS standard
errors below the threshold goes no further; the others are confirmed on their
full sets.

Links are looked for in rounds, so that no group is expanded into its pairs:

1. Documents with equal sets are one class, named by one of its rows: no two
   classes share a name, whatever doc_ids are null or repeated. A component's
   name, its smallest doc_id, is taken only at the end.
2. In every bucket each class is paired with the bucket's most central one.
   Confirmed pairs make components.
3. Classes of one bucket that are in different components are compared block
   by block, by sketch, inside a task; only pairs that pass come out. (A pair
   is compared in the first bucket it shares.) Confirmed pairs complete the
   components.

A pair at the threshold exactly shares no bucket with probability
``(1 - 0.75^4)^48`` = 1.2e-8, and fails the sketch with 3e-7.

Scale: a row of some 800 bytes stands for a document after the first pass;
texts move again only for classes in surviving pairs. Buckets, classes and
components are aggregated with map-side combine before they are joined, and
joins can be split at a hot key by adaptive execution.

Defined cases: null, empty and blank texts have the empty set, link with
nothing, and are their own component; fewer than five words are one shingle;
a doc_id names one text (rows that share it and differ in text each get the
component of their own set); a null doc_id counts as larger than any other (its
component_id is null where nothing smaller is linked); of a component's rows with
the smallest doc_id, the texts of one are kept (those with the smallest row key);
repeated rows get the same result each; an empty table gives an empty result;
columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dovetail.llm.common import documents_core, materialise, once, row_key
from dovetail.llm.word_arrays import byte_portions, combined, hashed_words, mixed, starts

SHINGLE = 5
ROWS, BANDS = 4, 48
MINHASHES = ROWS * BANDS
BITS = 2048
SAMPLE = 1024
SIGMAS = 5
THRESHOLD = 75  # per cent
LAST = (1 << 63) - 1
# level: the sample has the hashes below 2^(64 - level); odd, size: sketch of it
# and its size; next_*: of the sample one level up, where a partner can be there
_SKETCH = ("did bigint, key bigint, n bigint, set1 bigint, set2 bigint, bands array<bigint>, level int, "
           "odd array<bigint>, size bigint, next_odd array<bigint>, next_size bigint")
LEFT, RIGHT = 256, 2048  # classes of a bucket compared at a time


def shingle_sets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts end to end (sorted within a text), and
    how many each text has."""
    h, n = hashed_words(texts, lower=True)
    first = np.cumsum(n) - n
    at, doc = starts(n, SHINGLE)
    f = combined(h, tuple(range(1, SHINGLE + 1)))
    parts, docs = [mixed(f[SHINGLE][at])], [doc]
    for k in range(1, SHINGLE):  # the whole sequence of a short text
        short = np.flatnonzero(n == k)
        parts.append(mixed(f[k][first[short]] + np.uint64(k)))
        docs.append(short)
    f, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((f, doc))
    f, doc = f[order], doc[order]
    new = np.r_[True, (f[1:] != f[:-1]) | (doc[1:] != doc[:-1])] if len(f) else np.zeros(0, bool)
    return f[new], np.bincount(doc[new], minlength=len(texts))


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(8))
    return (rng.integers(0, 1 << 32, MINHASHES, dtype=np.uint32),
            rng.integers(0, 1 << 31, MINHASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def minhashes(f: np.ndarray, n: np.ndarray) -> np.ndarray:
    """samples[text, i]: smallest i-th hash over the text's set (texts with n > 0 only)."""
    xor, times = _constants()
    x = (f >> np.uint64(32)).astype(np.uint32)
    first = (np.cumsum(n) - n)[n > 0]
    out = np.empty((len(first), MINHASHES), np.uint32)
    for i in range(MINHASHES):
        y = (x ^ xor[i]) * times[i]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        out[:, i] = np.minimum.reduceat(y, first)
    return out


def bands_of(f: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(two independent digests of each set; band keys) per text with n > 0."""
    first = (np.cumsum(n) - n)[n > 0]
    sets = np.stack([np.add.reduceat(f, first), np.bitwise_xor.reduceat(mixed(f * np.uint64(0xA24BAED4963EE407)), first)], 1)
    m = minhashes(f, n)
    bands = np.zeros((len(first), BANDS), np.uint64)
    for r in range(ROWS):
        bands = bands * np.uint64(0x9FB21C651E98DF25) + m[:, r::ROWS].astype(np.uint64) + np.uint64(1)
    return sets, mixed(mixed(bands) + np.arange(BANDS, dtype=np.uint64))


def levels(n: np.ndarray) -> np.ndarray:
    """Halvings of the sample a set of n takes: none up to SAMPLE."""
    return np.ceil(np.log2(np.maximum(n, 1) / SAMPLE)).clip(0).astype(np.int64)


def odd_sketches(f: np.ndarray, n: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(odd sketch, samples) of each text, at its level."""
    doc = np.repeat(np.arange(len(n)), n)
    low = f <= (np.uint64(0xFFFFFFFFFFFFFFFF) >> level.astype(np.uint64))[doc]
    bit = (mixed(f[low] * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype(np.int64) % BITS
    flips = np.bincount(doc[low] * BITS + bit, minlength=len(n) * BITS)
    odd = np.packbits((flips & 1).astype(np.uint8).reshape(-1, BITS), axis=1).view("<i8")
    return odd, np.bincount(doc[low], minlength=len(n))


def sketch_rows(docs: DataFrame) -> DataFrame:
    """One row per document (see _SKETCH); texts without words have no bands."""

    def make(batches):
        import pyarrow as pa

        def lists(x: np.ndarray, have: np.ndarray) -> pa.Array:
            """Rows of x for the texts that have one, null for the others."""
            offsets = np.r_[0, np.cumsum(np.where(have, x.shape[1], 0))].astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).view(np.int64).ravel()),
                                            mask=pa.array(~have))

        for batch in batches:
            for a, texts in byte_portions(batch.column("text"), 2 << 20):
                f, n = shingle_sets(texts)
                have = n > 0
                both, bands = np.zeros((len(n), 2), np.int64), np.zeros((0, BANDS), np.uint64)
                if have.any():
                    sets, bands = bands_of(f, n)
                    both[have] = sets.view(np.int64)
                level = levels(n)
                odd, size = odd_sketches(f, n, level)
                # a set of the next level can reach the threshold only with one near the top of this
                top = have & (100 * n >= THRESHOLD * (SAMPLE << level))
                next_odd, next_size = odd_sketches(f, n, level + 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("did")[a:a + len(n)], batch.column("key")[a:a + len(n)], pa.array(n.astype(np.int64)),
                    pa.array(both[:, 0]), pa.array(both[:, 1]), lists(bands, have), pa.array(level.astype(np.int32)),
                    lists(odd[have], have), pa.array(size.astype(np.int64)), lists(next_odd[top], top),
                    pa.array(next_size.astype(np.int64))],
                    names=["did", "key", "n", "set1", "set2", "bands", "level", "odd", "size", "next_odd", "next_size"])

    return docs.mapInArrow(make, _SKETCH)


def similarity(p, samples):
    """Estimate from the population count and the samples of both sides."""
    delta = -BITS / 2 * np.log(np.maximum(1 - 2 * p / BITS, 1e-3))
    return (samples - delta) / (samples + delta)


def least_estimate(samples, level, threshold: int):
    """What the estimate of a pair at the threshold is not below, but for
    SIGMAS standard errors: of the sampling, and of the sketch."""
    t = threshold / 100
    share = (1 - t) / (1 + t)  # of the samples in which such a pair differs
    slope = 2 / (1 + share) ** 2
    sampling = t * (1 - t) * (1 + t) / samples * (1 - 0.5 ** level)
    sketch = slope ** 2 * 2 * share ** 2 / BITS * np.exp(4 * share * samples / BITS)
    return t - SIGMAS * np.sqrt(sampling + sketch)


def _passes(threshold: int) -> Column:
    """The same test on columns of a pair: n, level, size, odd, next_* with 1 and 2."""
    level = F.greatest("level1", "level2")
    odd = [F.when(F.col(f"level{i}") == level, F.col(f"odd{i}")).otherwise(F.col(f"next_odd{i}")) for i in (1, 2)]
    size = [F.when(F.col(f"level{i}") == level, F.col(f"size{i}")).otherwise(F.col(f"next_size{i}")) for i in (1, 2)]
    p = F.aggregate(F.zip_with(*odd, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    samples = F.greatest(size[0] + size[1], F.lit(1))
    delta = -BITS / 2 * F.log(F.greatest(1 - 2 * p / BITS, F.lit(1e-3)))
    t = threshold / 100
    share = (1 - t) / (1 + t)
    error = F.sqrt(t * (1 - t) * (1 + t) / samples * (1 - F.pow(F.lit(0.5), level))
                   + (2 / (1 + share) ** 2) ** 2 * 2 * share ** 2 / BITS * F.exp(4 * share * samples / BITS))
    sizes_fit = 100 * F.least("n1", "n2") >= threshold * F.greatest("n1", "n2")
    return sizes_fit & F.coalesce((samples - delta) / (samples + delta) >= t - SIGMAS * error, F.lit(False))


SIDE = ("n", "level", "odd", "size", "next_odd", "next_size")


def _near(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Of distinct pairs (a, b) of classes, those whose sketches pass."""
    for i, c in ((1, "a"), (2, "b")):
        pairs = pairs.join(classes.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}{i}") for x in SIDE]), c)
    return pairs.where(_passes(threshold)).select("a", "b")


def _compare(threshold: int):
    """Pairs of one block of a bucket (left: some of its classes, right: some of
    those outside its largest component) that are in different components, share
    no earlier bucket, and whose sketches pass."""

    def compare(t):
        import pyarrow as pa
        t = t.combine_chunks()
        left = t.column("left").to_numpy(zero_copy_only=False)
        num = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "comp", "outside", "n", "level", "size", "next_size")}
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        # unsigned: numpy counts the bits of a number's absolute value
        odd = t.column("odd").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)
        nxt = np.zeros_like(odd)
        have = np.flatnonzero(t.column("next_odd").is_valid().to_numpy(zero_copy_only=False))
        if len(have):
            nxt[have] = t.column("next_odd").combine_chunks().drop_null().flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)
        here = t.column("bucket")[0].as_py()
        at = int(np.flatnonzero(bands[0] == here)[0])
        ls, out = np.flatnonzero(left), []
        for r in np.flatnonzero(~left).tolist():
            # both outside the largest component: once, from the smaller id
            ok = (num["comp"][ls] != num["comp"][r]) & (~num["outside"][ls] | (num["rep"][ls] < num["rep"][r]))
            ok &= 100 * np.minimum(num["n"][ls], num["n"][r]) >= threshold * np.maximum(num["n"][ls], num["n"][r])
            l = ls[ok]
            l = l[~(bands[l, :at] == bands[r, :at]).any(axis=1)]
            if not len(l):
                continue
            level = np.maximum(num["level"][l], num["level"][r])
            own_l, own_r = num["level"][l] == level, num["level"][r] == level
            p = np.bitwise_count(np.where(own_l[:, None], odd[l], nxt[l]) ^ np.where(own_r[:, None], odd[r], nxt[r])).sum(
                axis=1, dtype=np.int64)
            samples = np.maximum(np.where(own_l, num["size"][l], num["next_size"][l])
                                 + np.where(own_r, num["size"][r], num["next_size"][r]), 1)
            l = l[similarity(p, samples) >= least_estimate(samples, level, threshold)]
            out += [(min(a, b), max(a, b)) for a, b in zip(num["rep"][l].tolist(), [int(num["rep"][r])] * len(l))]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _across(placed: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs of classes in one bucket and different components that pass.
    placed: (bucket, rep, comp), for buckets with several components."""
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    top = sizes.groupBy("bucket").agg(F.max("m").alias("most"), F.sum("m").alias("all"))
    main = sizes.join(top, "bucket").where("m = most").groupBy("bucket").agg(
        F.min("comp").alias("main"), F.first("most").alias("most"), F.first("all").alias("all"))
    rows = placed.join(main, "bucket").join(classes.select("rep", "bands", *SIDE), "rep")
    rows = rows.select("bucket", "rep", "comp", (F.col("comp") != F.col("main")).alias("outside"), "bands", *SIDE,
                       F.ceil(F.col("all") / LEFT).cast("int").alias("nl"),
                       F.ceil((F.col("all") - F.col("most")) / RIGHT).cast("int").alias("nr"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    left = rows.select("*", F.lit(True).alias("left"), mine("nl").alias("i"), F.explode(every("nr")).alias("j"))
    right = rows.where("outside").select("*", F.lit(False).alias("left"), mine("nr").alias("j"), F.explode(every("nl")).alias("i"))
    blocks = left.unionByName(right).drop("nl", "nr")
    return blocks.groupBy("bucket", "i", "j").applyInArrow(_compare(threshold), "a bigint, b bigint")


def _confirmed(near: DataFrame, classes: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Of pairs (a, b) of classes, those whose full sets reach the threshold."""
    near = materialise(near, "near-pairs")
    # the texts of these classes, by the document that stands for each
    ends = near.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    owners = materialise(classes.select("rep", "did", "key").join(ends, "rep"), "near-ends")
    # (the list of classes grows with the input: no broadcast, whatever its size here)
    texts = docs.join(owners.hint("shuffle_hash"), ["did", "key"]).select("rep", "text")

    def sets(batches):
        import pyarrow as pa
        had = set()  # rows repeated in full bring the same set: one a task is enough
        for batch in batches:
            new = [i for i, x in enumerate(batch.column("rep").to_pylist()) if not (x in had or had.add(x))]
            batch = batch.take(pa.array(new, pa.int64()))
            for a, t in byte_portions(batch.column("text")):
                f, n = shingle_sets(t)
                yield pa.RecordBatch.from_arrays([batch.column("rep")[a:a + len(t)], pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(f.view(np.int64)))], names=["rep", "shingles"])

    full = materialise(texts.mapInArrow(sets, "rep bigint, shingles array<bigint>"), "near-sets")
    both = near.join(full.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a").join(
        full.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    both = once(both.select("a", "b", "sa", "sb"), i=F.size(F.array_intersect("sa", "sb")).cast("bigint"))
    # distinct: a row repeated in full may have brought its set in more than one task
    return both.where(100 * F.col("i") >= threshold * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): for every node on an edge the smallest node reachable.

    Each round every node takes the smallest label among its neighbours' and
    then that label's own label, until no label changes; rounds grow with the
    logarithm of a component's diameter in the usual case."""
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct()
    both = materialise(both, "links")
    now = materialise(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select(
        "node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = both.join(now.select(F.col("node").alias("y"), "comp"), "y").groupBy(F.col("x").alias("node")).agg(
            F.min("comp").alias("m"))
        step = now.join(near, "node").select("node", "comp", F.least("comp", "m").alias("m"))
        jump = now.select(F.col("node").alias("m"), F.col("comp").alias("j"))
        new = materialise(step.join(jump, "m").select("node", F.least("m", "j").alias("comp"), F.col("comp").alias("old")), "labels")
        now = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            return now


def _with_hubs(members: DataFrame) -> DataFrame:
    """(bucket, rep, hub). The hub of a bucket is its most central class: the
    one whose buckets hold most classes in all, so that it has the band keys
    most of a group share; ties go to the smallest id. One class is then the
    hub of most of its group's buckets, and most of the group is near it."""
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    placed = members.join(weight, "rep").select("bucket", "rep", "weight")
    top = placed.groupBy("bucket").agg(F.max("weight").alias("weight"))
    hub = placed.join(top, ["bucket", "weight"]).groupBy("bucket").agg(F.min("rep").alias("hub"))
    return members.select("bucket", "rep").join(hub, "bucket")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """did, key, n_shingles, component (smallest did reachable), kept (the row
    stands for its component) of every row."""
    d = documents_core(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("did"), row_key(F.col("text")).alias("key"), "text")
    rows = materialise(sketch_rows(d).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # classes of equal sets, named by a row, which brings bands and sketch; first: its smallest document
    named = materialise(rows.where("n > 0").groupBy("set1", "set2").agg(
        F.min("row").alias("rep"), F.min(F.struct("did", "key")).alias("first")), "class-names")
    classes = materialise(rows.withColumnRenamed("row", "rep").join(named.select("rep"), "rep").select(
        "rep", "did", "key", "bands", *SIDE), "classes")
    buckets = classes.select(F.explode("bands").alias("bucket"), "rep")
    sizes = buckets.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("size"))
    members = materialise(buckets.join(sizes.where("lo <> hi").select("bucket", "size"), "bucket"), "buckets")
    members = materialise(_with_hubs(members), "hubs")
    stars = members.where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    links = materialise(_confirmed(_near(stars, classes, threshold), classes, d, threshold), "links-1")
    comp = components(links)
    # second round: classes of a bucket that are still apart
    placed = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("comp", "rep").alias("comp"), "hub")
    apart = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    placed = materialise(placed.join(apart, "bucket"), "apart")
    across = _across(placed, classes, threshold).distinct()
    more = materialise(_confirmed(across, classes, d, threshold), "links-2")
    comp = components(links.unionByName(more)) if not more.isEmpty() else comp
    # the first document of every component with a link, for each of its classes
    linked = materialise(comp.withColumnRenamed("node", "rep").join(named.select("rep", "first"), "rep"), "linked")
    least = linked.groupBy("comp").agg(F.min("first").alias("least"))
    of_class = named.join(linked.select("rep", "comp").join(least, "comp").select("rep", "least"), "rep", "left").select(
        "set1", "set2", F.coalesce("least", "first").alias("least"))
    of_class = materialise(of_class, "class-components")
    # texts without words are in no class, and stand for themselves
    return rows.select("did", "key", "n", "set1", "set2").join(of_class, ["set1", "set2"], "left").select(
        "did", "key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least.did")).otherwise(F.col("did")).alias("component"),
        F.when(F.col("n") > 0, (F.col("did") == F.col("least.did")) & (F.col("key") == F.col("least.key"))).otherwise(
            F.lit(True)).alias("kept"))


def report(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the doc_id is the component's)
    of every row. Rows that share their component's doc_id are all kept here;
    :func:`keep_one` chooses one text."""
    found = near_duplicates(docs, threshold)
    null = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return found.select(null("did").alias("doc_id"), "n_shingles", null("component").alias("component_id"),
                        (F.col("did") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that stand for their component, with all their columns;
    of a row repeated in full, one stays."""
    kept = near_duplicates(docs, threshold).where("kept").select("did", "key").distinct()
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    core = docs.select(own, F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LAST)).alias("did"),
                       row_key(docs["text"].cast("string")).alias("key"))
    # the join has dealt and sorted rows by these keys: the window moves nothing
    first = F.row_number().over(Window.partitionBy("did", "key").orderBy("did"))
    return core.join(kept, ["did", "key"]).select("row", first.alias("k")).where("k = 1").select("row.*")
