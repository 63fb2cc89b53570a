import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng: random.Random, n: int, vocabulary: list[str]) -> str:
    out = []
    for i in range(n):
        out.append(rng.choice(vocabulary))
        out.append("\n" if rng.random() < 0.07 else "  " if rng.random() < 0.05 else " ")
    return "".join(out).strip(" ")


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): fresh texts, copies, near copies of several degrees, shared lines, odd rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["ba", "ne", "Ko", "li", "tü", "sa", "mor", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    rows = [(i, prose(rng, rng.choice([1, 3, 4, 5, 6, 30, 90, 200]), vocabulary)) for i in range(60)]
    for i in range(60, 150):
        text = rows[rng.randrange(len(rows))][1].split(" ")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5, 15])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    shared = [prose(rng, 12, vocabulary).replace("\n", " ") for _ in range(4)]
    rows += [(i, prose(rng, 40, vocabulary) + "\n" + rng.choice(shared).upper() + "\n" + prose(rng, 9, vocabulary)) for i in range(150, 190)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "word"), (None, "a row without a key has five words or more")]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    """Rows of every odd kind, some twice, and extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (3, ""), (4, "  \n "),
            (None, "one two three four five six seven"), (None, None), (5, long), (6, long), (7, "ONE two three  four five six seven"),
            (8, "x" * 50_000), (9, "😀 𝒳 é\u0000 ﬁ"), (1, "another text under the same key as before")]
    clash = ["rep", "hi", "lo", "n", "start", "end", "row", "cut", "word", "size", "held_out", "shard", "slot", "text_hash", "shingles",
             "_b", "_n", "_rank", "length", "head", "bits", "root", "kept", "gone", "score", "sig", "piece", "spans", "k", "h"]
    return frame(spark, rows).select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")
