"""Vector best-fit packing of tokenised documents into training sequences.

A document is its token ids and an end id. One longer than a sequence is cut
into full pieces, the first of which may be shorter. A sequence (bin) has three
capacities: tokens, documents and attention cost (the sum of squared piece
lengths). Pieces go largest first, each to the bin that scores best among those
with room under every capacity: by residual norm (the smallest weighted norm of
what would be left) or by dot product (the largest weighted product of demand
and residual). The default document and attention capacities are those a
sequence of its length cannot exceed, so only tokens bind and the number of
sequences is as small as best-fit makes it.

Scale: texts never move. One pass tokenises, cuts and checksums; what is left
of a piece is a small row, written once. Packing groups of a fixed number of
pieces, dealt by a hash of the piece, are independent: a group of n pieces
leaves at most one more part-filled sequence than packing all of them would.

Defined cases: a null or empty text is the end id alone; added special strings
inside a text become their ids, the library's default; repeated rows are packed
as often as they come; ties go to the bin opened first; a null doc_id is kept;
an empty table gives an empty result; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import documents_core, materialise
from dovetail.llm.pretokens import PATTERN, portions, special_strings
from dovetail.llm.rank_merge import byte_symbols, tokenizer_path

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row_key bigint"


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. ``weights``: of tokens, documents, attention in the score."""
    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens ** 2], np.int64)


#: A stretch without white space of this length goes to the slower library.
LONG_RUN = re.compile(r"\S{2000}")


class Encoder:
    """Ids of texts as the tokenizers library gives them for a byte-level BPE file.

    The file's vocabulary, read as byte ranks, makes the same tokenizer for
    tiktoken, several times as fast. Texts with very long stretches without
    white space, on which that is slow, go to the library itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.special = special_strings(path)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if LONG_RUN.search(text) or (self.special and self.special.search(text)):
            return self.lib.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def __call__(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by ``end``, and their lengths."""
        each = [np.array([*self.ids(t), end], np.uint32) for t in texts]
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    head = length % most or most
    return [(0, head)] + [(s, most) for s in range(head, length, most)]


def pieces(docs: DataFrame, tokens: int = 1024, tokenizer: str | None = None, end: int = 2) -> DataFrame:
    """One row per piece, without its ids; row_key is a hash of the ids before it."""

    def make(batches):
        import pyarrow as pa
        enc = encoder(tokenizer or tokenizer_path())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            doc_ids = batch.column("doc_id")
            for a, b in portions(texts, 2 << 20):
                ids, lengths = enc(texts[a:b], end)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                rows, at = [], 0
                for i, n in enumerate(lengths.tolist()):
                    for k, (s, m) in enumerate(cut(n, tokens)):
                        rows.append((a + i, k, s, m, zlib.crc32(raw[4 * (at + s):4 * (at + s + m)])))
                    at += n
                src, k, s, m, crc = (np.array(x, np.int64) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    doc_ids.take(pa.array(src)), pa.array(k, pa.int32()), pa.array(s), pa.array(m), pa.array(crc),
                    pa.array(crc * 0x9E3779B1 % (1 << 31))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "row_key"])

    return documents_core(docs).mapInArrow(make, PIECES)


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece (of lengths up to the token capacity).

    Pieces are taken largest first. Bins that not even the smallest piece fits
    are closed, so the scan for each piece stays short."""
    full = cap.vector()
    w = np.array(cap.weights) / full
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    room = np.empty((1024, 3), np.int64)
    ids = np.empty(1024, np.int64)
    n_open = made = 0
    least = int(lengths.min()) if len(lengths) else 0
    smallest = np.array([least, 1, least * least])
    used: list[int] = []
    for i in order.tolist():
        x = int(lengths[i])
        need = np.array([x, 1, x * x])
        left = room[:n_open] - need
        ok = np.flatnonzero((left >= 0).all(axis=1))
        if len(ok):
            if cap.score == "dot":
                j = ok[np.argmax((room[ok] * w) @ (need * w))]
            else:
                j = ok[np.argmin((np.square(left[ok] * w)).sum(axis=1))]
        else:
            if (need > full).any():
                raise ValueError(f"a piece of {x} tokens exceeds the capacity of an empty sequence")
            if n_open == len(room):
                room, ids = np.concatenate([room, np.empty_like(room)]), np.concatenate([ids, np.empty_like(ids)])
            j = n_open
            room[j], ids[j] = full, made
            used.append(0)
            n_open, made = n_open + 1, made + 1
        b = int(ids[j])
        bins[i], offset[i] = b, used[b]
        used[b] += x
        room[j] -= need
        if (room[j] < smallest).any():  # nothing can join it: the last open bin takes its place
            n_open -= 1
            room[j], ids[j] = room[n_open], ids[n_open]
    return bins, offset


GROUP = 8192


def pack(docs: DataFrame, cap: Capacity = Capacity(), tokenizer: str | None = None, end: int = 2,
         group: int = GROUP) -> DataFrame:
    """One row per piece with its sequence and place."""
    rows = materialise(pieces(docs, cap.tokens, tokenizer, end), "pieces")
    n = rows.count()
    groups = max(1, -(-n // group))
    # dealt by a hash of the piece; repeated rows differ in nothing, so the
    # place of the row in its task deals them round
    key = F.pmod(F.xxhash64("doc_id", "piece", "row_key", F.monotonically_increasing_id()), F.lit(groups))

    def fill(t):
        import pyarrow as pa
        t = t.combine_chunks().sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        g = t.column("grp")[0].as_py()
        bins, offset = best_fit(t.column("length").to_numpy(), cap)
        return t.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array(bins * groups + g)).append_column("offset", pa.array(offset))

    return rows.withColumn("grp", key).groupBy("grp").applyInArrow(
        fill, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
