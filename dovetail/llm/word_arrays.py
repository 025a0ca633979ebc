"""Words of many texts as one array of 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the rolling combination of word hashes.
STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed_words(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space) end to end, and
    words per text. ``lower``: A-Z are lower-cased first. A null has none."""
    from xxhash import xxh3_64_intdigest
    lists = [(t.lower() if lower else t).split() if t else [] for t in texts]
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    total = int(n.sum())
    return np.fromiter((xxh3_64_intdigest(w) for ws in lists for w in ws), np.uint64, total), n


def combined(hashes: np.ndarray, depths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Fingerprint of the ``d`` words from each place on, for every d. Places
    closer than d to the end of the array have none (arrays are shorter)."""
    out, f = {}, np.zeros(len(hashes), np.uint64)
    for k in range(max(depths)):
        m = len(hashes) - k
        if m <= 0:
            break
        f = f[:m] * STEP + hashes[k:]
        if k + 1 in depths:
            out[k + 1] = f
    return {d: out.get(d, np.zeros(0, np.uint64)) for d in depths}


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of a fingerprint spread over all others (for buckets)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def starts(n_words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the joined array) where a whole window starts inside one
    text, and the text of each."""
    first = np.cumsum(n_words) - n_words
    have = np.maximum(n_words - window + 1, 0)
    text = np.repeat(np.arange(len(n_words)), have)
    inside = np.arange(int(have.sum())) - np.repeat(np.cumsum(have) - have, have)
    return first[text] + inside, text


def byte_portions(column, most: int = 4 << 20):
    """(first row, texts as bytes) of an Arrow string column, in portions."""
    import pyarrow as pa
    texts = column.cast(pa.large_binary()).to_pylist()
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield at, texts[at:i]
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, texts[at:]
