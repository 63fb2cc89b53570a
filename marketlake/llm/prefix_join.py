"""All pairs of similar sets, exactly, for crowded regions: a prefix-filter join on rare shingles.

Sets whose similarity is J >= t share a shingle among the rarest of each (Chaudhuri et al., 2006): of n shingles in a
common order, among the first n - ceil(t * n) + 1, and the places at which they share their first one bound their
overlap (Xiao et al., 2008). Any common order is right; here rare shingles come first, by counts in ``BUCKETS`` groups
of hashes, so a template that thousands share joins little. Only those first shingles are written.

No count of partners is limited. Pairs within one group are not listed: of each shingle, the rows of its commonest
group only meet the rows of other groups, so that a large group of copies never meets itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import dropped, written

BUCKETS = 18  # counts for 2^18 values of the upper bits
_SHIFT = np.uint64(64 - BUCKETS)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of the rows, and how many each has."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=np.uint64), np.array([len(x) // 8 for x in raw], dtype=np.int64)


def _weights(sets: DataFrame) -> np.ndarray:
    """How many shingles have each value of the upper bits."""
    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKETS, dtype=np.int64)
        for batch in batches:
            values, _ = _values(batch.column("shingles"))
            total += np.bincount((values >> _SHIFT).astype(np.int64), minlength=1 << BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "c"])

    weights = np.zeros(1 << BUCKETS, dtype=np.int64)
    # at most 2^18 rows
    for bucket, c in sets.select("shingles").mapInArrow(counts, "bucket int, c long").groupBy("bucket").agg(F.sum("c")).collect():
        weights[bucket] = c
    return weights


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """``sets``: id, group (long), shingles (distinct 64-bit hashes, binary). The distinct pairs a < b of ids of
    different groups, among them all that have 100 * intersection >= percent * union."""
    weights = _weights(sets)

    def firsts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, n = _values(batch.column("shingles"))
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((values, weights[(values >> _SHIFT).astype(np.int64)], row))
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            keep = place <= (n - (percent * n + 99) // 100)[row]
            own = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[order][keep].view(np.int64)), batch.column("id").take(own), batch.column("group").take(own),
                 pa.array(n[row[keep]]), pa.array(place[keep])], ["s", "id", "group", "n", "place"])

    prefixes = written(sets.select("id", "group", "shingles").mapInArrow(firsts, "s long, id long, group long, n long, place long"), "prefixes")
    common = written(prefixes.groupBy("s", "group").agg(F.count("*").alias("c")).groupBy("s")
                     .agg(F.max_by("group", F.struct("c", "group")).alias("most"), F.count("*").alias("groups"))
                     .where("groups > 1").select("s", "most"), "common")
    left = written(prefixes.join(common, "s"), "left")
    dropped(prefixes)
    right = written(left.where("group != most"), "right")
    x, y = left.alias("x"), right.alias("y")
    overlap = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    may = ((F.col("x.s") == F.col("y.s")) & (F.col("x.group") != F.col("y.group"))
           & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
           & ((100 + percent) * overlap >= percent * (F.col("x.n") + F.col("y.n"))))
    return x.join(y, may).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
