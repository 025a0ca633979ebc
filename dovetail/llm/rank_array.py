"""BPE encoding with a contiguous rank array, and decoding.

A word is held as two arrays side by side: the parts it is cut into and, for
each part, the rank of the pair it makes with the next one. The smallest rank
is looked for by a plain scan, the boundary behind it deleted, and the ranks of
the two pairs that changed are looked up again, until no pair has a rank. On a
short word a scan of a few numbers in a row beats any ordered structure. A word
of more than ``SHORT`` bytes would take time with the square of its length; it
is merged through a heap of (rank, place) over linked parts, with equal results.

Texts are cut into units that the tokenizer treats alone (see ``pretokens``);
each distinct unit is encoded and decoded once per worker, within a bounded
memo. One pass over the rows, nothing is shuffled; a worker holds one portion of
texts.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; added special strings inside a text are one token each, the library's
default, and come back as they were; repeated rows repeat their result; a null
doc_id is kept; an empty table gives an empty result; columns beside doc_id and
text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

from pyspark.sql import DataFrame

from dovetail.llm.common import documents_core
from dovetail.llm.pretokens import PRETOKEN, Memo, portions, special_strings, units
from dovetail.llm.rank_merge import byte_symbols, tokenizer_path

SHORT = 256
NONE = 1 << 30


class Codec:
    """Encoder and decoder of a byte-level BPE file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            doc = json.load(f)
        vocab = doc["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.of_byte = [vocab[c] for c in symbols]
        self.bytes_of = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items() if byte_of.keys() >= set(t)}
        self.special = special_strings(path)
        self.special_id = {t["content"]: t["id"] for t in doc["added_tokens"]}
        self.bytes_of |= {i: t.encode("utf-8") for t, i in self.special_id.items()}
        self.size = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in doc["model"]["merges"]]
        self.rank = {vocab[a] * self.size + vocab[b]: r for r, (a, b) in enumerate(pairs)}.get  # of a pair
        self.made = [vocab[a + b] for a, b in pairs]  # by a rank
        self.cut = regex.compile(PRETOKEN).findall
        self.memo = Memo(self._units)

    def word(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        parts = [self.of_byte[b] for b in piece]
        if len(parts) < 2:
            return parts
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        """``ranks[i]`` belongs to the boundary behind ``parts[i]``."""
        rank, size, made = self.rank, self.size, self.made
        ranks = [rank(a * size + b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)  # the leftmost of equal ranks
            parts[i] = new = made[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] * size + new, NONE)
            if i < len(ranks):
                ranks[i] = rank(new * size + parts[i + 1], NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        rank, size, n = self.rank, self.size, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] * size + parts[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:  # one of the two has been merged since
                continue
            parts[i], parts[j], after[i] = self.made[least], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := rank(parts[left] * size + parts[right], NONE)) != NONE:
                    heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [p for p in parts if p >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _units(self, us: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Of each unit: number of tokens, their ids as text, decoded bytes."""
        cut = [(u,) if (u[1:] if u[0] == " " else u).isalpha() else self.cut(u) for u in us]
        # one pre-token stands in many units, beside other punctuation
        coded = {}
        for p in set().union(*cut):
            ids = self.word(p.encode("utf-8"))
            coded[p] = len(ids), ",".join(map(str, ids)).encode(), self.decode(ids)
        out = []
        for ps in cut:
            if len(ps) == 1:
                out.append(coded[ps[0]])
            else:
                n, ids, text = zip(*map(coded.__getitem__, ps))
                out.append((sum(n), b",".join(ids), b"".join(text)))
        return out

    def __call__(self, texts: list[str]) -> list[list[tuple[int, bytes, bytes]]]:
        """The encoded units of each text, special strings among them."""
        lists, marks = [], []
        for t in texts:
            parts = self.special.split(t) if self.special else [t]
            us = [units(p) if i % 2 == 0 else [] for i, p in enumerate(parts)]
            marks.append((parts[1::2], us))
            lists.append([u for x in us for u in x])
        known = self.memo.look(lists)
        out = []
        for special, us in marks:
            row = []
            for i, x in enumerate(us):
                if i % 2:
                    k = self.special_id[special[i // 2]]
                    row.append((1, str(k).encode(), self.bytes_of[k]))
                else:
                    row.extend(map(known.__getitem__, x))
            out.append(row)
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>) and decoded (string) of every text.
    ``tokenizer``: a byte-level BPE file; by default the public 50k one."""

    def rows(parts):
        ids = [int(x) for p in parts for x in p[1].split(b",")]
        return ids, b"".join(p[2] for p in parts).decode("utf-8", "replace")

    import pyarrow as pa
    return _each(docs, tokenizer, rows, "ids array<int>, decoded string", [("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids joined by commas, and of the decoded text."""

    def rows(parts):
        # decoded bytes as the library gives them: what is not UTF-8 is replaced
        text = b"".join([p[2] for p in parts]).decode("utf-8", "replace").encode("utf-8")
        return (sum([p[0] for p in parts]), hashlib.sha256(b",".join([p[1] for p in parts])).hexdigest(),
                hashlib.sha256(text).hexdigest())

    import pyarrow as pa
    return _each(docs, tokenizer, rows, "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                 [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _each(docs: DataFrame, tokenizer: str | None, rows, schema: str, fields: list) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        encoded = codec(tokenizer or tokenizer_path())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in portions(texts):
                got = list(zip(*map(rows, encoded(texts[a:b]))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *[pa.array(c, t) for c, (_, t) in zip(got, fields)]],
                    names=["doc_id", *[n for n, _ in fields]])

    return documents_core(docs).mapInArrow(run, f"doc_id bigint, {schema}")
