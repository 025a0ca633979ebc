"""Cutting texts into units that a byte-level BPE tokenizer treats alone.

A pre-token never runs from a character that is not white space into one that
is. So a text can be cut in front of any white-space run and each part
tokenized by itself: texts become lists of few distinct units, and only
distinct units are worked on.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

#: The Unicode White_Space characters.
WS = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Fixed value: the published pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for a library whose white space is another set of characters.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}]+"
            r"|[" + WS + r"]+(?![^" + WS + r"])|[" + WS + r"]+")
_RUN_THEN_SPACE = re.compile(f"[{WS}] ")
_UNIT = re.compile(f"[{WS}]*[^{WS}]+|[{WS}]+")


def units(text: str) -> list[str]:
    """Units of a text, in order; their concatenation is the text."""
    if _RUN_THEN_SPACE.search(text):
        return _UNIT.findall(text)
    # each space follows a character that is not white space: cut in front of it
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + x for x in rest]


def special_strings(tokenizer_json: str) -> re.Pattern | None:
    """Pattern of the added special tokens, which the library finds before anything else."""
    with open(tokenizer_json, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    return re.compile("(" + "|".join(sorted(map(re.escape, added), key=len, reverse=True)) + ")") if added else None


class Memo:
    """Results by unit, resolved many at a time; emptied when it grows past
    ``room`` entries, so a worker's memory is bounded whatever the vocabulary."""

    def __init__(self, resolve: Callable[[list[str]], list], room: int = 400_000, longest: int = 128):
        self.resolve, self.room, self.longest, self.known = resolve, room, longest, {}

    def look(self, lists: list[list[str]]) -> dict:
        """Results for all units of the lists."""
        wanted = set().union(*lists) if lists else set()
        if len(self.known) > self.room:
            self.known.clear()
        new = [u for u in wanted if u not in self.known]
        if not new:
            return self.known
        got = dict(zip(new, self.resolve(new)))
        long = {u: v for u, v in got.items() if len(u) > self.longest}
        self.known.update((u, v) for u, v in got.items() if len(u) <= self.longest)
        return self.known | long if long else self.known


def portions(texts: list[str], chars: int = 4 << 20):
    """Index ranges of texts of about ``chars`` characters, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
