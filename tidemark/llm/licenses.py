"""License detection by ordered signature rules.

Rules are hand-written regular expressions over the lower-case words of a text joined by
single spaces (`license_signatures`), each with a tier: identifiers come first, bare
mentions and hints last.  A block of rules is tried only on texts with one of its keywords.
Detections are intervals of words; one is suppressed if an interval of its own or an
earlier tier contains it (of equal ones the first label by name stays).  Finding and
suppressing take time in proportion to the text, but for sorting the detections.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_text, once
from tidemark.llm.license_signatures import FRAGMENTS, SIGNATURES, TIERS

#: The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Signature:
    label: str
    tier: int
    weight: float
    pattern: re.Pattern[str]
    keywords: frozenset[str]


def signatures() -> list[Signature]:
    """All rules, by tier."""
    fragment = re.compile(r"\{([a-z]+)\}")
    rules, label, keywords = [], "", frozenset()
    for line in SIGNATURES.strip().splitlines():
        if line.startswith("="):
            label, words = line[1:].strip().split(" : ")
            keywords = frozenset(words.split())
        else:
            tier, body = line.split(" ", 1)
            body = fragment.sub(lambda m: FRAGMENTS[m[1]], body)
            rules.append(Signature(label, int(tier), TIERS[int(tier)], re.compile(rf"(?<![^ ])(?:{body})(?![^ ])"), keywords))
    return sorted(rules, key=lambda r: r.tier)


def word_numbers(joined: str) -> Callable[[int], int]:
    """The number of the word at, or ending at, a place of words joined by spaces."""
    gaps = [m.start() for m in re.finditer(" ", joined)]
    return lambda place: bisect_left(gaps, place)


class Scanner:
    def __init__(self):
        self.rules = signatures()
        self.keywords = frozenset().union(*(r.keywords for r in self.rules))
        self.base = [(re.compile(rf"(?<![^ ]){phrase}(?![^ ])"), label) for phrase, label in BASE_PHRASES]

    def detections(self, joined: str, words: Sequence[str] | None = None) -> list[tuple[int, int, str, float]]:
        """(first word, end word, label, weight) kept after suppression, of words joined by spaces."""
        present = self.keywords.intersection(joined.split(" ") if words is None else words)
        found = []
        for rule in self.rules:
            if not present.isdisjoint(rule.keywords):
                found += [(m.start(), -m.end(), rule.tier, rule.label, rule.weight) for m in rule.pattern.finditer(joined)]
        # Containment is transitive, so an interval goes exactly if one of its own or an earlier
        # tier that starts no later ends no earlier: one sweep that keeps the furthest end of each tier.
        furthest, kept = dict.fromkeys(TIERS, -1), []
        for start, end, tier, label, weight in sorted(found):
            if max(furthest[t] for t in TIERS if t <= tier) < -end:
                kept.append((start, -end, label, weight))
            furthest[tier] = max(furthest[tier], -end)
        word = word_numbers(joined) if kept else None
        return [(word(a), word(b) + 1, label, weight) for a, b, label, weight in kept]

    def scan(self, text: str) -> dict:
        words = _WORD.findall(text.encode().lower())
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "detections": ""}
        words = [w.decode() for w in words]
        # Every base phrase holds a keyword as a word.
        if self.keywords.isdisjoint(words):
            return out
        joined = " ".join(words)
        number = word_numbers(joined)
        places, base = [], set()
        for pattern, label in self.base:
            starts = [m.start() for m in pattern.finditer(joined)]
            places += [number(s) for s in starts]
            base |= {label} if starts else set()
        found = self.detections(joined, words)
        unsure = 0.0 if base else 1.0
        for _, _, _, weight in found:
            unsure *= 1 - weight
        return out | {
            "n_base": len(places),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {label for _, _, label, _ in found})),
            "score": 1 - unsure,
            "detections": ",".join(f"{label}:{a}:{b}" for a, b, label, _ in found),
        }


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    Words count from 0; `detections` lists label:first:end, the end exclusive.  `score` is 1
    where a base phrase stands, else 1 minus the product of (1 - weight) over the
    detections.  Null text counts as empty: no words, no labels, score 0.  Repeated rows
    and null ids each keep a row; other columns are ignored; an empty table gives an
    empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = once("license scanner", Scanner)
        for batch in batches:
            out = pd.DataFrame([scanner.scan(t) for t in batch["text"]], columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])
            for c in ("n_words", "n_base", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return keyed_text(docs).mapInPandas(
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, detections string",
    )
