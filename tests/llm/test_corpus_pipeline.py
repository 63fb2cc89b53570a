"""The corpus pipeline's stages against brute force, on rows planted for each of them."""

from __future__ import annotations

import random

import brute
import corpus_pipeline
import pytest
from conftest import SCHEMA, frame, prose

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(700)]
    rows = [(i, prose(rng, 80, vocabulary)) for i in range(40)]
    items = [(i, prose(rng, 20, vocabulary)) for i in range(5)]
    rows += [(50 + i, prose(rng, 30, vocabulary) + " " + items[i][1] + " " + prose(rng, 30, vocabulary)) for i in range(5)]
    one_line = [r[1].replace("\n", " ") for r in rows[:4]]
    rows += [(60 + i, t) for i, t in enumerate(one_line)]
    for i, t in enumerate(one_line):  # near copies in words, on one line: similar lines as well
        tokens = t.split()
        tokens[3] = "changed"
        rows.append((70 + i, " ".join(tokens)))
    rows += [(80, None), (81, "123 456"), (82, ""), (83, rows[5][1]), (84, rows[5][1].upper()), (85, "a few words")]
    path = tmp_path_factory.mktemp("planted")
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def without_lines(docs, removed):
    out = []
    for d, t in docs:
        spans = sorted((a, b) for x, a, b, *_ in removed if x == d)
        for a, b in reversed(spans):
            t = t[:a] + t[b:]
        if not spans or brute.words(t):
            out.append((d, t))
    return out


def test_stages(spark, planted):
    path, items = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, df: spark.createDataFrame(stages[name](spark, df, path).collect(), SCHEMA)

    known = step("language ID", docs)
    assert {d for d, _ in texts(docs)} - {d for d, _ in texts(known)} == {80, 81, 82}
    fresh = step("line dedup", known)
    assert texts(fresh) == sorted(without_lines(texts(known), brute.similar_lines(texts(known))))
    assert all(r["n_chars"] == len(r["text"]) for r in fresh.collect())
    kept = step("near dedup", known)  # on its own input: copies are still there
    want = brute.near_components(texts(known), 80)
    assert texts(kept) == sorted((d, t) for d, t in texts(known) if want[d][1] == d)
    clean = step("decontamination", known)
    hits = {d for d, _ in brute.contaminated(texts(known), items)}
    assert hits == set(range(50, 55)) and texts(clean) == sorted(x for x in texts(known) if x[0] not in hits)


def test_run_equals_its_stages_in_a_row(spark, planted):
    path, items = planted
    docs = [(d, t) for d, t in texts(spark.read.parquet(f"{path}/documents.parquet")) if t and any(c.isalpha() for c in t)]
    docs = without_lines(docs, brute.similar_lines(docs))
    want = brute.near_components(docs, 80)
    docs = [(d, t) for d, t in docs if want[d][1] == d]
    hits = {d for d, _ in brute.contaminated(docs, items)}
    out = entry.queries()["pipeline"](spark, path).collect()
    assert {r["doc_id"] for r in out} == {d for d, _ in docs if d not in hits}
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_repeated_and_odd_rows(spark, messy, planted, nothing):
    path, _ = planted
    for name, stage in corpus_pipeline.STAGES:
        for docs in (messy, nothing):
            out = stage(spark, docs, path)
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            if name == "near dedup" and docs is messy:
                assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None and r["text"] and r["text"].startswith("one")) == [1]


@pytest.mark.parametrize("n", range(1, 11))
def test_one_query_for_each_operator(n):
    assert len([q for q in entry.queries() if q.startswith(f"op{n}_")]) == 1
