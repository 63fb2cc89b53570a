"""Operator 13 against all pairs of words in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from conftest import frame
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import spelling

SYLLABLES = ["ba", "ne", "li", "tü", "sa", "mor", "é", "ÿ", "ing", "the", "ß"]


def vocabulary(docs, every=31):
    found = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def edited(word):
    """Deletions of one letter, and places where one is left open: words share one of them if they are one edit apart."""
    return {(word[:i], word[i + 1 :]) for i in range(len(word))}


def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return bool(edited(a) & edited(b))
    return b in {x + y for x, y in edited(a)} or a in {x + y for x, y in edited(b)}


def brute(found):
    out = {}
    for word, n in found.items():
        others = [w for w in found if near(word, w)]
        best = min(others, key=lambda w: (-found[w], w), default=None)
        form = best if best is not None and found[best] >= 10 * n else None
        out[word] = [form, None, n, len(others), found[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    base = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(3, 6))) for _ in range(60)]
    weights = [1 / (k + 1) ** 1.6 for k in range(len(base))]
    docs = []
    for i in range(150):
        said = []
        for word in rng.choices(base, weights, k=60):
            for _ in range(rng.choice([0] * 14 + [1, 1, 2])):
                at = rng.randrange(len(word) + 1)
                word = rng.choice([word[:at] + rng.choice("aebéx") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("aebq") + word[at + 1 :]])
            said.append(word.upper() if rng.random() < 0.1 else word)
        docs.append((i, rng.choice([" ", ", ", "-", "\n"]).join(said)))
    long = "x" * 400
    docs += [(200, None), (201, ""), (202, "kürzer ab"), (None, " ".join(base[:3])), (None, " ".join(base[:3])),
             (203, f"{long} {long} {long}y {long}y {long[:-1]}z {long[:-1]}z"), (204, "abcdefgh " * 500 + "abcdefg abcdefg")]
    return docs


def test_words_follow_the_contract(spark, texts):
    assert {r["word"]: r["n"] for r in spelling.words(frame(spark, texts)).collect()} == vocabulary(texts)
    assert {r["word"]: r["n"] for r in spelling.words(frame(spark, texts), every=2).collect()} == vocabulary(texts, 2)


@pytest.mark.parametrize(("least", "block"), [(1 << 14, 1 << 16), (40, 30), (3, 5)])
def test_variants_as_by_all_pairs(spark, texts, least, block):
    found = vocabulary(texts, 5)
    expected = brute(found)
    assert sum(r[0] is not None for r in expected.values()) > 20
    table = spark.createDataFrame(list(found.items()), "word string, n long")
    assert result(spelling.variants(table, least=least, block=block)) == expected


def test_chains_end_at_their_root(spark):
    found = {"abcdefgh": 1000, "abcdefg": 100, "abcdefx": 10, "abcdexx": 1, "zbcdefg": 100, "qwertzui": 2}
    out = result(spelling.variants(spark.createDataFrame(list(found.items()), "word string, n long")))
    assert out == brute(found) and {out[w][1] for w in ("abcdexx", "abcdefx", "abcdefg")} == {"abcdefgh"}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abqrá", min_size=1, max_size=6), max_size=40), st.integers(0, 3))
def test_one_task_finds_every_pair(found, turn):
    kept = sorted(found) + ["ab" * 40, "ab" * 39 + "a", "ab" * 39 + "aq", "a" * 300, "a" * 301, "a" * 299 + "q"]
    table = pa.table({"word": kept, "n": pa.array([2] * len(kept), pa.int64()), "state": pa.array([0] * len(kept), pa.int8())})
    order = [*range(turn, 32), *range(turn)]
    out = spelling.near_pairs(table, table, order, 0, block=7)
    pairs = [tuple(sorted(p)) for p in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    assert sorted(pairs) == sorted((a, b) for a in kept for b in kept if a < b and near(a, b))


@given(st.text("ab", max_size=7), st.text("ab", max_size=7))
def test_one_edit(a, b):
    assert spelling.one_edit(a, b) == near(a, b)


def test_odd_rows_and_no_rows(spark, messy, nothing):
    spelling.variants(spelling.words(messy)).collect()
    assert spelling.variants(spelling.words(nothing)).collect() == []
