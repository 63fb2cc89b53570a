"""Operator 1, benchmark decontamination by SimHash over item-sized windows.

A benchmark item of n words is compared with every window of n words of a document. Both are multisets of 5-word
shingles; the similarity is the weighted Jaccard one (sum of minima by sum of maxima). Windows get 64-bit SimHash
fingerprints. A multi-index finds all fingerprints within the radius of an item's: the bits are cut into blocks, and
two fingerprints within ``radius`` are within radius // blocks in one block at least, so each item is filed under all
block values that near. Exact similarity on the shingles decides.

Fingerprinting every window of every size would cost a document once for each size. A window that can reach the
similarity holds at least 2t / (1 + t) of its shingles in items of its size; a bitmap of these shingles (its size is
bounded, whatever the benchmark's) rules out all other windows beforehand, and never a matching one.

Definite results: null and empty texts match nothing, on either side; an item or text of fewer than five words is one
shingle, so such an item matches only a text of exactly its words; rows with a null key match nothing; repeated rows
count once; of several windows that match an item the most similar, then first, is told. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import binary, blocks, mix, shingles
from marketlake.llm.tables import slim, written

WORDS = 5
SIMILARITY = 0.8
RADIUS = 23  # at a similarity of 0.8 bits differ with probability 0.15: 9.7 of 64, and 4.6 deviations more
BLOCKS = 8
MOST_BITS = 27  # of the bitmap: 16 MB at most
_U = np.uint64


def simhash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The fingerprint of each multiset values[start:end]: a bit is set if more than half of the values have it."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(values) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[ends] - total[starts]
    return np.packbits(2 * ones > (ends - starts)[:, None], axis=1).view(np.uint64).reshape(-1)


def sized(values: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """A shingle's hash as one of a text of ``size`` words."""
    return mix(values ^ (np.asarray(size, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)))


def least_common(size: int, similarity: float) -> int:
    """So many shingles of a window must be an item's: m common ones of k make m / (2 k - m)."""
    k = max(1, size - WORDS + 1)
    return max(1, int(np.ceil(2 * k * similarity / (1 + similarity) - 1e-9)))


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, size (words), fp, shingles (binary, sorted)."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = block.words()
            values, at = shingles(words, WORDS)
            size = np.diff(words.at)
            full = np.flatnonzero(size)
            own = [np.sort(values[at[k] : at[k + 1]]).tobytes() for k in full]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(pa.array(full)), pa.array(size[full]),
                 pa.array(simhash(values, at[:-1][full], at[1:][full]).view(np.int64)), pa.array(own, pa.binary())],
                ["item_id", "size", "fp", "shingles"])

    return benchmark.mapInArrow(rows, "item_id long, size long, fp long, shingles binary")


def bitmaps(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles occur in an item, and which in an item of some size (both hashed), as bitmaps of equal size."""
    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, raw in zip(batch.column("size").to_pylist(), batch.column("shingles").to_pylist()):
                values = np.frombuffer(raw, np.uint64)
                for kind, x in enumerate((values, sized(values, size))):
                    at = (x >> _U(64 - bits)).astype(np.int64)
                    one = _U(1) << (at % 64).astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), kind, np.int32)), pa.array(at // 64), pa.array(one.view(np.int64))],
                        ["kind", "at", "bit"])

    count = found.agg(F.sum(F.octet_length("shingles") / 8)).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(64 * count + 1)), 16, MOST_BITS))
    rows = (found.select("size", "shingles").mapInArrow(marks, "kind int, at long, bit long")
            .groupBy("kind", "at").agg(F.bit_or("bit").alias("bits")).toArrow())  # 2 * 2**bits / 64 rows at most
    out = np.zeros((2, (1 << bits) // 64), dtype=np.int64)
    out[rows["kind"].to_numpy(), rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return tuple(out.view(np.uint64))


def _in(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> _U(65 - len(bitmap).bit_length() - 6)
    return (bitmap[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) == 1


def windows(docs: DataFrame, sizes: list[int], plain: np.ndarray, by_size: np.ndarray, similarity: float) -> DataFrame:
    """Every item-sized window with enough shingles of items of its size: doc_id, start, end (code points), size, fp,
    shingles."""
    needs = {n: least_common(n, similarity) for n in sizes}
    least = min(needs.values(), default=1)
    names = ["doc_id", "start", "end", "size", "fp", "shingles"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = block.words()
            values, at = shingles(words, WORDS)
            hits = np.zeros(len(values) + 1, dtype=np.int64)
            np.cumsum(_in(plain, values), out=hits[1:])
            for k in np.flatnonzero(hits[at[1:]] - hits[at[:-1]] >= least):
                own, first, n = values[at[k] : at[k + 1]], words.at[k], words.at[k + 1] - words.at[k]
                for size, need in needs.items():
                    wide = max(1, size - WORDS + 1)
                    if size > n or (n < WORDS and size != n):
                        continue
                    if size < WORDS and n != size:
                        continue
                    seen = np.zeros(len(own) + 1, dtype=np.int64)
                    np.cumsum(_in(by_size, sized(own, size)), out=seen[1:])
                    begin = np.flatnonzero(seen[wide:] - seen[:-wide] >= need)
                    if not len(begin):
                        continue
                    base = block.chars_before(block.at[k])
                    inside = np.sort(np.lib.stride_tricks.sliding_window_view(own, wide)[begin], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [block.column("doc_id").take(pa.array(np.full(len(begin), k))),
                         pa.array(block.chars_before(words.start[first + begin]) - base),
                         pa.array(block.chars_before(words.end[first + begin + size - 1]) - base),
                         pa.array(np.full(len(begin), size, np.int64)),
                         pa.array(simhash(own, begin, begin + wide).view(np.int64)), binary(inside)], names)

    return docs.mapInArrow(rows, "doc_id long, start long, end long, size long, fp long, shingles binary")


def _blocks() -> list[tuple[int, int]]:
    """First bit and width of each block."""
    ends = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _value(fp, block: tuple[int, int]):
    return F.shiftrightunsigned(fp, block[0]).bitwiseAND(F.lit((1 << block[1]) - 1).cast("long"))


def within_radius(left: DataFrame, right: DataFrame, radius: int) -> DataFrame:
    """Pairs of ``left`` (size, fp, ...) and ``right`` (size, item_fp, ...) of one size whose fingerprints differ in
    at most ``radius`` bits, each once."""
    flips = radius // BLOCKS
    assert all(width <= 16 for _, width in _blocks())
    near = {w: [x for x in range(1 << w) if x.bit_count() <= flips] for w in {w for _, w in _blocks()}}

    def filed(i: int, block: tuple[int, int]):
        own = _value(F.col("item_fp"), block)
        masks = F.array(*[F.lit(x).cast("long") for x in near[block[1]]])
        return F.transform(masks, lambda x: F.struct(F.lit(i).alias("block"), x.bitwiseXOR(own).alias("value")))

    every = F.flatten(F.array(*[filed(i, b) for i, b in enumerate(_blocks())]))
    # written, so that Spark knows its size before it chooses how to join
    index = written(right.select("*", F.explode(every).alias("_f")).select("*", "_f.*").drop("_f"), "index")
    asked = F.array(*[F.struct(F.lit(i).alias("block"), _value(F.col("fp"), b).alias("value")) for i, b in enumerate(_blocks())])
    probes = left.select("*", F.explode(asked).alias("_f")).select("*", "_f.*").drop("_f")
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    # a pair may meet in several blocks: it counts in the first of them
    earlier = F.lit(False)
    for i, b in enumerate(_blocks()[:-1]):
        earlier = earlier | ((F.col("block") > i) & (F.bit_count(_value(differ, b)) <= flips))
    return (probes.join(index, ["size", "block", "value"]).where((F.bit_count(differ) <= radius) & ~earlier)
            .withColumn("hamming", F.bit_count(differ)).drop("block", "value"))


def similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose multisets are similar enough, with ``similarity``."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, (x, y) in enumerate(zip(batch.column("shingles"), batch.column("item_shingles"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                (u, m), (v, n) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
                _, a, b = np.intersect1d(u, v, assume_unique=True, return_indices=True)
                common = np.minimum(m[a], n[b]).sum()
                out[i] = common / (len(x) + len(y) - common)
            keep = pa.array(out >= similarity)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).filter(keep) for c in kept), pa.array(out).filter(keep)],
                                             [*kept, "similarity"])

    kept = ["doc_id", "item_id", "start", "end", "hamming"]
    return pairs.select(*kept, "shingles", "item_shingles").mapInArrow(
        rows, "doc_id long, item_id long, start long, end long, hamming int, similarity double")


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                 key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item that it contains: doc_id, item_id, start, end (code points of the most
    similar window), similarity, hamming."""
    found = written(items(slim(benchmark, item_text, item).where("doc_id is not null").distinct()), "items")
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # as many as words in the longest item
    plain, by_size = bitmaps(found)
    texts = slim(docs, text, key).where("doc_id is not null")
    seen = written(windows(texts, sizes, plain, by_size, similarity).withColumn("id", F.monotonically_increasing_id()), "windows")
    near = within_radius(seen.select("id", "size", "fp"), found.select("size", "item_id", F.col("fp").alias("item_fp")), radius)
    pairs = (near.select("id", "item_id", "hamming").join(seen.drop("size", "fp"), "id")
             .join(found.select("item_id", F.col("shingles").alias("item_shingles")), "item_id"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "end", "hamming"))
    return (similar(pairs, similarity).groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", (-F.col("b.s")).alias("start"), "b.end", "b.similarity", "b.hamming"))
