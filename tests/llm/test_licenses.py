"""Operator 11 against plain loops over words, its gate and its suppression against brute force."""

from __future__ import annotations

import random
import re

import pytest
from conftest import frame
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import license_rules, licenses

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
PIECES = ["Licensed under the Apache License, Version 2.0", "released UNDER the\nMIT--License", "CC BY-NC", "cc-by-nc-sa 4.0", "license", "mit",
          "https://creativecommons.org/licenses/by-nc/4.0/", "SPDX-License-Identifier: GPL-2.0-only OR MIT", "under the", "é", "_", "\u0085", "2",
          "GNU Lesser General Public License v2.1 or later", "word", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]


def base(text):
    """By the words of the contract: (n_words, n_base, first_word, last_word, base_labels)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for label, phrase in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


@pytest.fixture(scope="module")
def gate():
    return licenses.Gate(license_rules.rules())


def mixed(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(PIECES) + rng.choice([" ", "\n", ", ", "-", " / "]) for _ in range(n))


def test_phrases_follow_the_contract(spark):
    docs = [(i, mixed(i, i % 23)) for i in range(120)] + [(200, None), (201, ""), (202, "under the mit licenses"), (203, "cc\x00by\x7fnc CC_BY.NC"), (204, "ccc by nc")]
    out = licenses.summarised(licenses.scan(frame(spark, docs))).collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in out} == {d: base(t) for d, t in docs}
    for r in out:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"].split(",") == sorted(set(r["labels"].split(","))) and (r["score"] > 0) == bool(r["labels"])


@pytest.mark.parametrize(("text", "labels"), [
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported License", {"cc-by-sa-3.0"}),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", {"apache-2.0", "mit"}),
    ("GNU Lesser General Public License v2.1 or later", {"lgpl-2.1-or-later"}),
    ("the GNU Affero General Public License", {"agpl"}),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
    ("see http://www.apache.org/licenses/LICENSE-2.0", {"apache-2.0"}),
    ("dual: Apache License, Version 2.0; also under the BSD 3-Clause License", {"apache-2.0", "bsd-3-clause"}),
    ("mit dem Lizenzgeber, a license by the submit licenses", set()),
])
def test_known_texts(gate, text, labels):
    _, found = licenses.scanned(text, gate)
    assert {d["label"] for d in found if d["kept"]} == labels


def test_the_gate_loses_nothing(gate):
    for seed in range(60):
        words = b" " + b" ".join(mixed(seed, 30).encode().translate(licenses._LOWER).split()) + b" "
        assert licenses.matches(words, gate.rules, gate.passed(words)) == licenses.matches(words, gate.rules, range(len(gate.rules)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30), st.integers(1, 12)), max_size=30))
def test_containment_as_by_pairs(found):
    found = [(rule, begin, begin + size) for rule, begin, size in found]
    taken, keep = [], [False] * len(found)
    for i in sorted(range(len(found)), key=lambda i: (found[i][0], found[i][1] - found[i][2], found[i][1])):
        if not any(b <= found[i][1] and found[i][2] <= e for b, e in taken):
            taken.append(found[i][1:])
            keep[i] = True
    assert licenses.resolved(found) == keep


def test_spans_are_places_of_the_source(gate):
    text = "é😀 foo\u0085 — released under the MIT License ... under  the MIT License, ünder"
    _, found = licenses.scanned(text, gate)
    assert [(text[d["start"] : d["end"]], d["first_word"]) for d in found if d["kind"] == "phrase"] == [("under  the MIT License", 7)]
    long = "word " * 200_000 + "CC-BY-NC 4.0 " * 3000
    n, found = licenses.scanned(long, gate)
    phrases = [d for d in found if d["kind"] == "phrase"]
    assert n == 200_000 + 15_000 and len(phrases) == 3000 and all(long[d["start"] : d["end"]] == "CC-BY-NC" for d in phrases)


def test_odd_rows_and_no_rows(messy, nothing):
    assert len(licenses.summarised(licenses.scan(messy)).collect()) == messy.count()
    assert licenses.summarised(licenses.scan(nothing)).collect() == []


def test_there_are_hundreds_of_rules_and_each_compiles(gate):
    assert len(gate.rules) > 300 and all(re.compile(r.pattern) and r.keys for r in gate.rules)
