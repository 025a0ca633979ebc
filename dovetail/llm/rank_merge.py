"""Token counts by rank-synchronous array merging.

A batch's distinct pre-tokens are held as one ragged numpy array of symbols. In
every round each sequence finds the lowest rank among its adjacent pairs, and
all places of that pair are merged in all sequences at once; sequences without
a known pair leave the array. What survives is counted. A merge can only make
pairs of higher rank than its own, so the rounds end with the tokens that
merging one pair at a time gives.

Counts of a text are the sums over its units (see ``pretokens``), looked up in
a bounded memo per worker. One pass over the rows; nothing is shuffled, the
longest state is one batch of texts.

Defined cases: a null or empty text has no bytes and no tokens; added special
strings inside a text count as one token each, the library's default; repeated
rows repeat their result; a null doc_id is kept; an empty table gives an empty
result; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from dovetail.llm.common import documents_core
from dovetail.llm.pretokens import PRETOKEN, Memo, portions, special_strings, units

LIMIT = 1024
NONE = np.iinfo(np.int32).max


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next free character from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class RankMerger:
    """Merge tables of a byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        self.cut = regex.compile(PRETOKEN).findall

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all pieces laid end to end, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        sym = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        return self._rounds(sym, lengths)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE if it is not in the table), and what it becomes."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NONE), self.made[at]

    def _rounds(self, sym: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(lengths)
        done_sym: list[np.ndarray] = []
        done_seq: list[np.ndarray] = []
        seq = np.repeat(np.arange(n, dtype=np.int32), lengths)  # whose symbol it is
        rank, made = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int64)  # of the pair that starts there
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inner], made[inner] = self._pairs(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            if (over := least == NONE).any():
                out = np.repeat(over, sizes)
                done_sym.append(sym[out])
                done_seq.append(seq[out])
                go = ~out
                sym, seq, rank, made = sym[go], seq[go], rank[go], made[go]
                least, sizes = least[~over], sizes[~over]
                if not len(sym):
                    break
            # a pair of equal symbols can overlap itself: every other place of a run, from its left end
            idx = np.flatnonzero(rank == np.repeat(least, sizes))
            run = np.r_[True, np.diff(idx) != 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(idx)), 0))
            idx = idx[(np.arange(len(idx)) - first) % 2 == 0]
            sym[idx] = made[idx]
            stay = np.ones(len(sym), bool)
            stay[idx + 1] = False
            sym, seq, rank, made = sym[stay], seq[stay], rank[stay], made[stay]
            # only pairs beside a merged place have changed
            at = idx - np.arange(len(idx))
            at = np.concatenate([at[at > 0] - 1, at])
            last = np.r_[seq[:-1] != seq[1:], True][at]
            rank[at[last]] = NONE
            at = at[~last]
            rank[at], made[at] = self._pairs(sym[at], sym[at + 1])
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        sym, seq = np.concatenate(done_sym), np.concatenate(done_seq)
        order = np.argsort(seq, kind="stable")
        return sym[order], np.bincount(seq, minlength=n)

    def _cut(self, u: str) -> list[str]:
        """Pre-tokens of a unit; letters after at most one space are one."""
        return [u] if (u[1:] if u[0] == " " else u).isalpha() else self.cut(u)

    def unit_counts(self, us: list[str]) -> list[int]:
        """Tokens of each unit."""
        cut = [self._cut(u) for u in us]
        distinct = list(dict.fromkeys(p for ps in cut for p in ps))
        _, n = self.merge([p.encode("utf-8") for p in distinct])
        count = dict(zip(distinct, n.tolist()))
        return [count[ps[0]] if len(ps) == 1 else sum(map(count.__getitem__, ps)) for ps in cut]

    def unit_ids(self, us: list[str]) -> list[np.ndarray]:
        """Token ids of each unit."""
        cut = [self._cut(u) for u in us]
        distinct = list(dict.fromkeys(p for ps in cut for p in ps))
        sym, n = self.merge([p.encode("utf-8") for p in distinct])
        ids = dict(zip(distinct, np.split(sym.astype(np.uint32), np.cumsum(n)[:-1])))
        return [np.concatenate([ids[p] for p in ps]) if len(ps) != 1 else ids[ps[0]] for ps in cut]


class Counter:
    """Token counts of texts."""

    def __init__(self, path: str):
        self.special = special_strings(path)
        self.memo = Memo(RankMerger(path).unit_counts)

    def __call__(self, texts: list[str]) -> list[int]:
        extra, lists = [], []
        for t in texts:
            parts = self.special.split(t) if self.special else [t]
            extra.append(len(parts) // 2)  # special strings stand at the odd places
            lists.append([u for p in parts[::2] for u in units(p)])
        known = self.memo.look(lists).__getitem__
        return [e + sum(map(known, us)) for e, us in zip(extra, lists)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text. ``tokenizer``: a
    byte-level BPE file; by default the worker finds the public 50k one."""

    def count(batches):
        import pyarrow as pa
        counts = counter(tokenizer or tokenizer_path())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = [c for a, b in portions(texts) for c in counts(texts[a:b])]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                pa.array(n, pa.int64()), pa.array([c > limit for c in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents_core(docs).mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
