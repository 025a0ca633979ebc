"""Substring de-duplication over prefix groups of 13-word windows.

The suffixes of all texts, as sequences of words, are dealt into groups that
fit a worker's memory by prefixes of variable length: a first word that starts
few enough suffixes makes (with other such words) a group; suffixes under a
word too common for that are told apart by two words, then 4, 8 and 13. Inside
a group, suffixes are grouped by their first 13 words, which decide all that is
removed: a label found in several documents is a repeat, and every place of it
but those of the smallest doc_id starts a repeated window. Suffixes are not
ordered beyond 13 words, so no trees are built and no maximal repeats come out.

A group is held as arrays: label (a 64-bit fingerprint of 13 words; equal
labels are taken as equal words), document and place.
In a group of g suffixes a false merge has probability g^2 / 2^65, below 10^-6.

Scale: what moves is 8 bytes per suffix and a few for its place, packed. Each
task first merges its own leaves: places whose window already starts in a
smaller document of the same portion are settled there, so a passage that a
third of all documents share costs each portion one leaf, not each document.
Prefix counts come from a pass over all texts, summed in Spark; the driver sees
a table whose size is set by the number of groups.

Defined cases: null, empty and short texts (under 13 words) lose nothing; a
null doc_id counts as larger than any other (and 2^63 - 1 as null); rows with equal doc_id are the
same document, so they do not remove each other's words; rows repeated in full
get the same result each; an empty table gives an empty result; columns beside
doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import documents_core, row_key
from dovetail.llm.word_arrays import byte_portions, combined, hashed_words, mixed, starts

WINDOW = 13
DEPTHS = (1, 2, 4, 8, WINDOW)
MOST = 2 << 20   # suffixes of a group
PORTION = 1 << 20  # suffixes a task merges at a time
LAST = (1 << 63) - 1
_BLOB = "grp int, dids binary, keys binary, counts binary, places binary, labels binary, settled binary"


def _keyed(docs: DataFrame) -> DataFrame:
    d = documents_core(docs)
    return d.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("did"), row_key(F.col("text")).alias("key"), "text")


def prefix_counts(d: DataFrame, bits: int) -> list[tuple[int, int, int]]:
    """(depth, bucket, suffixes) over all texts."""

    def count(batches):
        import pyarrow as pa
        total = {k: np.zeros(1 << bits, np.int64) for k in DEPTHS}
        for batch in batches:
            for _, texts in byte_portions(batch.column("text")):
                h, n = hashed_words(texts)
                at, _ = starts(n, WINDOW)
                for k, f in combined(h, DEPTHS).items():
                    total[k] += np.bincount((mixed(f[at]) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        for k, c in total.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)),
                                              pa.array(c[some])], names=["depth", "bucket", "n"])

    rows = d.select("text").mapInArrow(count, "depth int, bucket int, n bigint")
    return [tuple(r) for r in rows.groupBy("depth", "bucket").agg(F.sum("n")).collect()]  # 5 * 2^bits rows at most


def plan_groups(counts: list[tuple[int, int, int]], bits: int, most: int) -> np.ndarray:
    """group[d, bucket] of suffixes whose prefix of DEPTHS[d] words falls into
    the bucket; -1 where that prefix is too common and more words are needed."""
    c = np.zeros((len(DEPTHS), 1 << bits), np.int64)
    for depth, bucket, n in counts:
        c[DEPTHS.index(depth), bucket] = n
    group, used, share = np.full(c.shape, -1, np.int32), 0, 1.0
    total = max(int(c[0].sum()), 1)
    for d in range(len(DEPTHS)):
        light = c[d] <= most if d + 1 < len(DEPTHS) else np.ones(1 << bits, bool)
        # of a bucket's suffixes, the share whose shorter prefixes were too common
        size = np.where(light, c[d], 0) * share
        before = np.cumsum(size) - size
        group[d] = np.where(light, used + (before // most).astype(np.int64), -1)
        used = int(group[d].max(initial=used - 1)) + 1
        share = float(c[d][~light].sum()) / total
        if share == 0:
            break
    return group


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as four planes of bytes: high planes of small
    numbers are zeros, which the shuffle's compression removes."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _widen(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _steps(ids: np.ndarray) -> bytes:
    """Document ids as steps from one to the next, in eight planes of bytes:
    ids of one portion are close together, so nearly all planes are constant."""
    step = np.r_[ids[:1], np.diff(ids)].astype("<i8")
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes()


def _ids(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<i8").ravel())


def _gaps(place: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places as distances within a document (sorted by document, place)."""
    new = np.r_[True, doc[1:] != doc[:-1]]
    return np.where(new, place, place - np.r_[0, place[:-1]])


def _places(gaps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(gaps)
    first = np.cumsum(counts) - counts
    return total - np.repeat(total[first] - gaps[first], counts)


def _deal(portion: list, group: np.ndarray, bits: int):
    """Blobs of one portion: for each group its unsettled leaves, and the places
    already settled. portion: (dids, keys, hashes, words per text)."""
    dids, keys, h, n = (np.concatenate(x) for x in zip(*portion))
    at, doc = starts(n, WINDOW)
    first = np.cumsum(n) - n
    f = combined(h, DEPTHS)
    label, place = f[WINDOW][at], at - first[doc]
    grp = np.full(len(at), -1, np.int32)
    for d, k in enumerate(DEPTHS):
        open_ = np.flatnonzero(grp < 0)
        if len(open_):
            grp[open_] = group[d][(mixed(f[k][at[open_]]) >> np.uint64(64 - bits)).astype(np.int64)]
    # equal labels side by side; settled: the portion has the window in a smaller document
    order = np.argsort(label, kind="stable")
    head = np.r_[True, label[order[1:]] != label[order[:-1]]] if len(order) else np.zeros(0, bool)
    settled = np.zeros(len(at), bool)
    if len(order):
        where = np.flatnonzero(head)
        least = np.minimum.reduceat(dids[doc[order]], where)
        settled[order] = dids[doc[order]] > np.repeat(least, np.diff(np.r_[where, len(order)]))
    by = np.argsort(grp, kind="stable")  # within a group by document and place
    cuts = np.flatnonzero(np.r_[True, grp[by[1:]] != grp[by[:-1]]]) if len(by) else []
    for a, b in zip(cuts, [*cuts[1:], len(by)]):
        mine = by[a:b]
        some, first_, counts = np.unique(doc[mine], return_index=True, return_counts=True)
        del first_
        free = mine[~settled[mine]]
        yield (int(grp[mine[0]]), _steps(dids[some]), keys[some].astype("<i8").tobytes(), _narrow(counts),
               _narrow(_gaps(place[mine], doc[mine])), label[free].astype("<u8").tobytes(),
               np.packbits(settled[mine]).tobytes())


def deal(d: DataFrame, group: np.ndarray, bits: int) -> DataFrame:
    def make(batches):
        import pyarrow as pa
        schema = pa.schema([("grp", pa.int32())] + [(c, pa.binary()) for c in (
            "dids", "keys", "counts", "places", "labels", "settled")])
        portion, size = [], 0

        def out():
            rows = list(_deal(portion, group, bits))
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema) if rows else None

        for batch in batches:
            dids, keys = batch.column("did").to_numpy(), batch.column("key").to_numpy()
            for a, texts in byte_portions(batch.column("text")):
                h, n = hashed_words(texts)
                portion.append((dids[a:a + len(texts)], keys[a:a + len(texts)], h, n))
                size += len(h)
                if size >= PORTION:
                    if (b := out()) is not None:
                        yield b
                    portion, size = [], 0
        if portion and (b := out()) is not None:
            yield b

    return d.select("did", "key", "text").mapInArrow(make, _BLOB)


def _subtree(t):
    """Places in one group where a window starts that a smaller document has too."""
    import pyarrow as pa
    dids, keys, counts, places, labels, settled = [], [], [], [], [], []
    for r in t.select(["dids", "keys", "counts", "places", "labels", "settled"]).to_pylist():
        c = _widen(r["counts"])
        dids.append(_ids(r["dids"]))
        keys.append(np.frombuffer(r["keys"], "<i8"))
        counts.append(c)
        places.append(_places(_widen(r["places"]), c))
        settled.append(np.unpackbits(np.frombuffer(r["settled"], np.uint8), count=len(places[-1])).astype(bool))
        labels.append(np.frombuffer(r["labels"], "<u8"))
    dids, keys, counts, places, labels, hit = (np.concatenate(x) for x in (dids, keys, counts, places, labels, settled))
    doc = np.repeat(np.arange(len(dids)), counts)
    free = np.flatnonzero(~hit)
    order = np.argsort(labels, kind="stable")
    owner = dids[doc[free[order]]]
    where = np.flatnonzero(np.r_[True, labels[order[1:]] != labels[order[:-1]]]) if len(order) else np.zeros(0, np.int64)
    if len(order):
        least = np.minimum.reduceat(owner, where)
        hit[free[order]] = owner > np.repeat(least, np.diff(np.r_[where, len(order)]))
    some = np.flatnonzero(hit)
    marked, n = np.unique(doc[some], return_counts=True)
    ends = np.cumsum(n)
    place = places[some].astype("<u4")
    return pa.table({"did": pa.array(dids[marked]), "key": pa.array(keys[marked]),
                     "places": pa.array([place[e - m:e].tobytes() for e, m in zip(ends.tolist(), n.tolist())], pa.binary())})


def repeats(d: DataFrame, most: int = MOST) -> DataFrame:
    """did, key (tells texts of one doc_id apart), places (array of packed
    32-bit places): where windows start that a smaller document has too. ``d`` as from :func:`_keyed`."""
    chars = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    suffixes = chars // 6 + 1  # only the number of groups depends on this
    most = int(min(most, max(1 << 14, suffixes // 64)))
    bits = int(min(22, max(10, np.ceil(np.log2(16 * suffixes / most + 1)))))
    group = plan_groups(prefix_counts(d, bits), bits, most)
    found = deal(d, group, bits).groupBy("grp").applyInArrow(_subtree, "did bigint, key bigint, places binary")
    return found.groupBy("did", "key").agg(F.collect_list("places").alias("places"))


def covered(places: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Words (of n) inside a window that starts at one of the places."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, np.minimum(places + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left (kept words joined
    by one space) of every row."""
    d = _keyed(docs)
    marks = repeats(d)
    joined = d.join(marks, ["did", "key"], "left").select("doc_id", "text", "places")

    def cut(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            n_words, n_removed, kept = [], [], []
            for t, ps in zip(texts, batch.column("places").to_pylist()):
                ws = t.split() if t else []
                gone = 0
                if ps and ws:
                    # marks come by doc_id and 64-bit key of the text: rows that share them have this text
                    at = np.concatenate([np.frombuffer(p, "<u4") for p in ps]).astype(np.int64)
                    out = covered(at, len(ws))
                    gone = int(out.sum())
                    ws_left = [w for w, o in zip(ws, out.tolist()) if not o] if gone else ws
                else:
                    ws_left = ws
                n_words.append(len(ws))
                n_removed.append(gone)
                kept.append(b" ".join(ws_left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
