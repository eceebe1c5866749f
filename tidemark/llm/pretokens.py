"""Splitting text into the pre-tokens of a byte-level BPE vocabulary file."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import regex

#: Fixed value: the split pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPLIT = regex.compile(PATTERN)
_WHOLE = 2_000_000


def byte_of_character() -> dict[str, int]:
    """Vocabulary files write a byte as itself where it is printable Latin-1, else as the next character from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def special_tokens(path: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}


class Splitter:
    """Pre-tokens of a text, with the special strings in it set apart as the library does by default."""

    def __init__(self, specials: dict[str, int]):
        longest_first = sorted(specials, key=len, reverse=True)
        self.specials = specials
        self.marks = regex.compile("|".join(map(regex.escape, longest_first))) if specials else None

    def lists(self, text: str) -> Iterator[tuple[list[str], str | None]]:
        """(pre-tokens, special string that follows or None), a bounded list at a time."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            yield from self._plain(text[at : mark.start()])
            yield [], mark.group()
            at = mark.end()
        yield from self._plain(text[at:] if at else text)

    @staticmethod
    def _plain(text: str) -> Iterator[tuple[list[str], None]]:
        if len(text) <= _WHOLE:
            yield _SPLIT.findall(text), None
            return
        found = (m.group() for m in _SPLIT.finditer(text))
        while part := list(itertools.islice(found, 200_000)):
            yield part, None
