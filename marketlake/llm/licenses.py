"""Operator 11, license scans: ordered signature rules over normalised words, gated by keywords.

A text's words are read lower-cased (A-Z) and parted by single spaces. A rule (``license_rules``) is searched only where
the text holds one of its keywords; all its matches count. Overlaps are resolved by priority and containment: detections
are taken in the order of the rules, longer ones first, and one whose words lie within those of a detection taken before
is suppressed (``kept`` is false). Every detection is reported, kept or not, with its words and its code points.

Work and memory are linear in the text but for the matches themselves: a text of any length is one value of one task.

Definite results: null and empty texts have no words and no detections; a null key stays null; repeated rows are scanned
each on its own; an empty table gives an empty one; other columns are ignored. Of two rules that find the same words the
first stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.license_rules import TRUST, Rule, rules
from marketlake.llm.tables import slim

FIELDS = [("label", pa.string()), ("kind", pa.string()), ("rule", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()),
          ("start", pa.int64()), ("end", pa.int64()), ("trust", pa.float64()), ("kept", pa.bool_())]
FOUND = pa.list_(pa.struct(FIELDS))
SCHEMA = ("doc_id long, n_words long, detections array<struct<label string, kind string, rule int, first_word long, "
          "n_words long, start long, end long, trust double, kept boolean>>")

#: Bytes of words in lower case; all else below 128 parts words.
_LOWER = bytes(c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Gate:
    """The keywords of all rules in one automaton: a single pass over a text tells which rules need a search."""

    def __init__(self, ordered: tuple[Rule, ...]):
        self.rules, by_key = ordered, {}
        for i, rule in enumerate(ordered):
            for key in rule.keys:
                by_key.setdefault(key.decode("latin-1"), []).append(i)
        self.keys = ahocorasick.Automaton()
        for key, own in by_key.items():
            self.keys.add_word(key, (key, own))
        self.keys.make_automaton()

    def passed(self, words: bytes) -> list[int]:
        held = dict(value for _, value in self.keys.iter(words.decode("latin-1")))
        return sorted({i for own in held.values() for i in own})


def matches(words: bytes, ordered: tuple[Rule, ...], numbers: Iterable[int]) -> list[tuple[int, int, int]]:
    """(rule, begin, end) for the rules of these numbers; the normalised text begins and ends with a space."""
    return [(i, m.start(), m.end()) for i in numbers for m in re.compile(ordered[i].pattern).finditer(words)]


def resolved(found: list[tuple[int, int, int]]) -> list[bool]:
    """Which detections stay. The taken ones that no other taken one contains form a staircase: both ends rise."""
    begins, ends, keep = [], [], [False] * len(found)
    for i in sorted(range(len(found)), key=lambda i: (found[i][0], found[i][1] - found[i][2], found[i][1])):
        _, begin, end = found[i]
        at = bisect_right(begins, begin)
        if at and ends[at - 1] >= end:
            continue
        keep[i] = True
        first = at - (1 if at and begins[at - 1] == begin else 0)
        last = bisect_right(ends, end)  # what lies within the new one needs no step of its own
        begins[first:max(first, last)], ends[first:max(first, last)] = [begin], [end]
    return keep


def places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of UTF-8 bytes begins and ends, in code points."""
    solid = np.frombuffer(_LOWER, np.uint8)[raw] != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return chars[edges[0::2]], chars[edges[1::2]]


def scanned(text: str | None, gate: Gate) -> tuple[int, list[dict]]:
    """Number of words, and the detections in the order of their first words."""
    raw = (text or "").encode()
    parts = raw.translate(_LOWER).split()
    words = b" " + b" ".join(parts) + b" "
    found = sorted(matches(words, gate.rules, gate.passed(words)), key=lambda m: (m[1], m[0]))
    if not found:
        return len(parts), []
    starts, ends = places(np.frombuffer(raw, np.uint8))
    out, at, word = [], 0, -1
    for (i, begin, end), kept in zip(found, resolved(found)):
        word, at = word + words.count(b" ", at, begin), begin
        n = words.count(b" ", begin, end) + 1
        rule = gate.rules[i]
        out.append({"label": rule.label, "kind": rule.kind, "rule": i, "first_word": word, "n_words": n, "start": int(starts[word]),
                    "end": int(ends[word + n - 1]), "trust": TRUST[rule.kind], "kept": kept})
    return len(parts), out


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, and detections (label, kind of rule, rule number, first word and
    number of words, code points from start to before end, trust, kept)."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = Gate(rules())
        for batch in batches:
            scans = [scanned(t.as_py(), gate) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in scans], pa.int64()),
                                              pa.array([d for _, d in scans], FOUND)], ["doc_id", "n_words", "detections"])

    return slim(docs, text, key).mapInArrow(rows, SCHEMA)


def summarised(scans: DataFrame) -> DataFrame:
    """The digest columns of a scan: the plain phrases' places and labels, all labels that stay, and the best trust."""
    phrases = F.filter("detections", lambda d: d["kind"] == "phrase")
    counted = F.filter("detections", lambda d: d["kept"] | (d["kind"] == "phrase"))
    starts = F.transform(phrases, lambda d: d["first_word"])

    def joined(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    return scans.select("doc_id", "n_words", F.size(phrases).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), joined(phrases).alias("base_labels"), joined(counted).alias("labels"),
                        F.coalesce(F.array_max(F.transform(counted, lambda d: d["trust"])), F.lit(0.0)).alias("score"))
