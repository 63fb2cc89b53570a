"""Isotonic fits against pool-adjacent-violators on one list."""

import random

import pytest

from marketlake.operators import isotonic


def _pooled(points):
    """(x, value) by plain pooling of adjacent violators; points: x -> (w, s)."""
    blocks = []
    for x, (w, s) in sorted(points.items()):
        blocks.append([[x], w, s])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            xs, w, s = blocks.pop()
            blocks[-1] = [blocks[-1][0] + xs, blocks[-1][1] + w, blocks[-1][2] + s]
    return {x: s / w for xs, w, s in blocks for x in xs}


@pytest.mark.parametrize(("seed", "rows"), [(1, 1000), (2, 7), (3, 1), (4, 40)])
def test_fit_and_apply_as_by_plain_pooling(spark, seed, rows):
    rng = random.Random(seed)
    data = []
    for _ in range(600):
        x = rng.choice([rng.random(), round(rng.random(), 1)])
        data.append((x, int(rng.random() < x * x * 0.8 + (0.3 if 0.2 < x < 0.3 else 0)), rng.choice([1, 1, 2])))
    points = {}
    for x, y, w in data:
        a, b = points.get(x, (0, 0))
        points[x] = (a + w, b + w * y)
    want = _pooled(points)
    df = spark.createDataFrame(data + [(None, 1, 1), (0.5, None, 1)], "p double, y int, weight int").repartition(3)
    blocks = isotonic.fit(df, "p", "y", "weight", rows=rows)
    found = sorted((r["upto"], r["value"], r["weight"]) for r in blocks.collect())
    assert [v for _, v, _ in found] == sorted(v for _, v, _ in found) and sum(w for _, _, w in found) == sum(w for _, _, w in data)
    out = isotonic.apply(df, blocks, "p", "fitted", rows=rows).collect()
    assert len(out) == 602
    for r in out:
        assert r["fitted"] is None if r["p"] is None else r["fitted"] == pytest.approx(want.get(r["p"], r["fitted"]))
    beyond = isotonic.apply(spark.createDataFrame([(-1.0,), (9.0,)], "p double"), blocks, "p", "fitted").collect()
    assert {r["p"]: r["fitted"] for r in beyond} == {-1.0: pytest.approx(found[0][1]), 9.0: pytest.approx(found[-1][1])}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "p double, y int")
    blocks = isotonic.fit(empty, "p", "y")
    assert blocks.collect() == [] and isotonic.apply(empty, blocks, "p", "f").collect() == []


def test_corners_of_whole_numbers_beyond_doubles():
    big = 2**53
    assert isotonic.corners([(0.0, 0.0, 0.0), (1.0, float(big), 0.0), (2.0, float(2 * big), float(big))]) == [(0.0, 0, 0), (1.0, big, 0), (2.0, 2 * big, big)]
