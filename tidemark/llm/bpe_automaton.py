"""Byte-level BPE as a deterministic automaton over tokens.

The automaton starts as one state that every byte leads back to.  The merges are then
applied to it in order of rank.  The gadget of merge (u, v) -> w

* splits off the state entered by u and takes its arc v away ("cut" at this rank),
* enters the arc w wherever u could be followed by v, leading to a copy of the state
  that v leads to.

After the last merge a state is known by the token that enters it, and a sequence of
tokens is a path exactly if it is the BPE encoding of the bytes it spells.  Copied
states share the arcs of their originals: a state made at rank r has those arcs of
the original that were not cut before r, and an arc for w made at r is there if the arc
for u was not cut up to r.  `arc` reads this from the tables of the gadgets, and the
answers fill the transition table as words are met.

The prefix of a word has one encoding, so at most one state is reached at each position.
Encoding therefore walks the word with one open state per position, longest arcs first,
and never visits a position twice.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_text, once
from tidemark.llm.pretokens import Splitter, byte_of_character, special_tokens

_START = -1
_NEVER = 1 << 60
#: Encoded words remembered per Python process; when full the memory starts anew.
REMEMBERED_WORDS = 300_000


class MergeAutomaton:
    """Compiled from a vocabulary file of byte-level BPE."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        byte = byte_of_character()
        spell = lambda token: bytes(byte[c] for c in token)
        self.specials = special_tokens(path)
        size = 1 + max([*model["vocab"].values(), *self.specials.values()])
        self.labels = [b""] * size
        for token, number in model["vocab"].items():
            if token not in self.specials:
                self.labels[number] = spell(token)
        for token, number in self.specials.items():
            self.labels[number] = token.encode()
        # Tables of the gadgets: rank of the merge that made a token, its two parts, and the cut arcs.
        self.made = [-1] * size
        self.first, self.second = list(range(size)), list(range(size))
        self.cut: dict[tuple[int, int], int] = {}
        self.table: dict[int, bool] = {}
        sound = [len(label) == 1 for label in self.labels]
        for rank, (u, v) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a, b, w = model["vocab"][u], model["vocab"][v], model["vocab"][u + v]
            self.cut[a, b] = rank
            if self.made[w] < 0:
                self.made[w], self.first[w], self.second[w] = rank, a, b
                sound[w] = sound[a] and sound[b] and self._uncut(a, b, rank)
        #: Tokens that encode their own bytes; an arc for any other is never entered.
        self.numbers = {label: n for n, label in enumerate(self.labels) if sound[n]}
        self.reach: dict[bytes, int] = {}
        for label in self.numbers:
            for width in (1, 2):
                start = label[:width]
                self.reach[start] = max(self.reach.get(start, 0), len(label))

    def _uncut(self, state: int, token: int, before: int) -> bool:
        """Whether the arc `token` of `state` survives all merges of rank below `before`."""
        while True:
            if self.cut.get((state, token), _NEVER) < before:
                return False
            if self.made[state] > self.made[token]:
                before, state = self.made[state], self.second[state]
            elif self.made[token] >= 0:
                before, token = self.made[token] + 1, self.first[token]
            else:
                return True

    def arc(self, state: int, token: int) -> bool:
        if state < 0:
            return True
        key = state << 20 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > 2_000_000:
                self.table.clear()
            known = self.table[key] = self._uncut(state, token, _NEVER)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """Token numbers of one pre-token."""
        whole = self.numbers.get(word)
        if whole is not None:
            return [whole]
        numbers, reach, end = self.numbers, self.reach, len(word)
        path: list[tuple[int, int]] = []  # (position, token that led from it)
        closed: set[int] = set()
        at, state, width = 0, _START, min(reach[word[:2]] if word[:2] in reach else 1, end)
        while at < end:
            while width:
                token = numbers.get(word[at : at + width])
                if token is not None and at + width not in closed and self.arc(state, token):
                    break
                width -= 1
            if width:
                path.append((at, token))
                at, state = at + width, token
                width = min(reach.get(word[at : at + 2], 1), end - at)
            else:  # no way on from here: take the last arc back and try a shorter one
                closed.add(at)
                last, token = path.pop()
                width, at = at - last - 1, last
                state = path[-1][1] if path else _START
        return [token for _, token in path]


class Codec:
    """Whole texts: special strings, pre-split words and the memory of encoded words."""

    def __init__(self, path: str):
        self.automaton = MergeAutomaton(path)
        self.splitter = Splitter(self.automaton.specials)
        self.memory: dict[str, bytes] = {}

    def _encoded(self, words: list[str]) -> bytes:
        memory = self.memory
        if len(memory) > REMEMBERED_WORDS:
            memory.clear()
        for word in set(words).difference(memory):
            memory[word] = np.array(self.automaton.encode_word(word.encode()), "<u4").tobytes()
        return b"".join(map(memory.__getitem__, words))

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit integers, some at a time."""
        for words, special in self.splitter.lists(text):
            if words:
                yield self._encoded(words)
            if special is not None:
                yield np.array([self.automaton.specials[special]], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """Labels of the ids, joined."""
        return b"".join(map(self.automaton.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_and_decode(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip.

    With `with_ids` also ids, little-endian unsigned 32-bit integers.

    `tokenizer_path` is a vocabulary file that every executor can open.  The ids are
    those of the library without added special tokens; special strings in a text are
    special tokens.  Null text counts as empty, with no ids.  Repeated rows each get a
    row; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = once(f"codec {tokenizer_path}", lambda: Codec(tokenizer_path))
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids, decoded, count, parts = hashlib.sha256(), hashlib.sha256(), 0, []
                for part in codec.encode(text):
                    ids.update(part)
                    decoded.update(codec.decode(part))
                    count += len(part) // 4
                    if with_ids:
                        parts.append(part)
                digest = decoded.hexdigest()
                rows.append((count, ids.hexdigest(), digest, digest == hashlib.sha256(text.encode()).hexdigest(), b"".join(parts)))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "ids"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out if with_ids else out.drop(columns="ids")

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return keyed_text(docs).mapInPandas(run, schema + ", ids binary" * with_ids)
