"""Operator 3, near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct 5-word shingles (64-bit hashes). Documents with equal sets are one class. Each
class enters every tree of the forest at the place of its signature, a sequence of minima in that tree's own order.
A tree is a sorted table: neighbours share the longest prefixes, so a crowded region is told apart by deeper values
and a thin one by its first, without a fixed depth or a bucket that could overflow. From its place each class looks
ahead and takes the nearest classes whose packed sketches also agree; every pair so found is confirmed on the full
sets. Components come from distributed union-find. A second pass looks much further ahead, but only in regions that
still hold several components, and only at classes of others: what a large group of copies or a shared passage crowded
out in the first pass is found there, and the group's own pairs are not listed again. Regions in which more classes share
a tree's whole key than were taken, and that still hold several components, are finished exactly: all pairs between
components there, by a prefix-filter join on rare shingles, without a limit.

A tree is range-partitioned and sorted on the whole signature and the key, so a large group spreads over many tasks.

Definite results: a null text is empty, a text without words links with nothing; a null key gets a null component and
is not kept; repeated rows are one document. A key is taken to be unique: rows that repeat it with another text are
classed by their own text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import binary, blocks, minhash, range_hash, shingles, unpacked
from marketlake.llm.components import components
from marketlake.llm.prefix_join import prefix_pairs
from marketlake.llm.tables import dropped, slim, written

WORDS = 5
TREES = 16
DEPTH = 6  # minima in a tree's key; ties beyond it are in the order of the class's key
AHEAD = 24  # how far a class looks ahead in a tree, and
TAKEN = 3  # how many that agree it takes there; then, where a region holds several components,
FAR_AHEAD = 128  # how far it looks past its own component,
FAR_TAKEN = 24  # and how many it takes
DEVIATIONS = 5  # sketches may agree so many standard deviations less than at the similarity wanted
_OTHER = 0xD1342543DE82EF95
_PAIRS = np.uint64(0x5555555555555555)


def sets(docs: DataFrame, trees: int = 0, depth: int = DEPTH, keep: bool = False) -> DataFrame:
    """doc_id, n_shingles, hi, lo (a digest of the set), sig (``trees * depth`` minima), and with ``keep`` the sorted
    set itself."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            values, at = shingles(block.words(), WORDS)
            parts = [np.unique(values[a:b]) for a, b in zip(at, at[1:])]
            size = np.array([len(x) for x in parts], dtype=np.int64)
            ends = np.cumsum(size)
            flat = np.concatenate(parts)
            full = np.flatnonzero(size)
            sig = np.zeros((len(block), trees * depth), dtype=np.uint32)
            if trees and len(full):
                sig[full] = minhash(flat, (ends - size)[full], trees * depth)
            out = [block.column("doc_id"), pa.array(size),
                   pa.array(range_hash(flat, ends - size, ends).view(np.int64)),
                   pa.array(range_hash(flat, ends - size, ends, _OTHER).view(np.int64))]
            if trees:
                out.append(binary(sig))
            if keep:
                out.append(pa.array([x.tobytes() for x in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_shingles long, hi long, lo long" + ", sig binary" * bool(trees) + ", set binary" * keep
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.mapInArrow(rows, schema)


def packed_bits(sig: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, in 64-bit words: a sketch that tells unlike sets apart."""
    n, functions = sig.shape
    wide = np.zeros((n, -(-functions // 32) * 32), dtype=np.uint64)
    wide[:, :functions] = sig & np.uint32(3)
    return (wide.reshape(n, -1, 32) << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)


def agreement(a: np.ndarray, b: np.ndarray, functions: int) -> np.ndarray:
    """How many of the two-bit values are equal."""
    x = a ^ b
    return functions - np.bitwise_count((x | (x >> np.uint64(1))) & _PAIRS).sum(axis=1, dtype=np.int64)


def neighbours(ordered: DataFrame, functions: int, ratio: float, deviations: float, ahead: int, taken: int, edges: bool) -> DataFrame:
    """Pairs (a, b, head) of classes within ``ahead`` rows of each other in the sorted partitions of ``ordered`` (head, any
    rest, rep, n, bits) that have the same head and about the same sketch (bits), and different groups if there is a
    column ``group``. With ``edges``, also each partition's first and last rows, for pairs across partitions."""
    # J >= ratio means that 2-bit values agree with probability 1/4 + 3/4 J or more
    expect = 0.25 + 0.75 * ratio
    least = functions * (expect - deviations * (expect * (1 - expect) / functions) ** 0.5)
    names = ordered.columns
    fields = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, took, first = None, np.zeros(0, dtype=np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            if edges and first < ahead:
                yield edge(part.slice(0, ahead - first))
                first += part.num_rows
            old = 0 if held is None else held.num_rows
            both = part if held is None else pa.concat_tables([held, part])
            took = np.append(took, np.zeros(part.num_rows, np.int64))
            yield match(both.combine_chunks().to_batches()[0], old, took)
            held, took = both.slice(max(0, both.num_rows - ahead)), took[max(0, both.num_rows - ahead):]
        if edges and held is not None:
            yield edge(held)

    def match(batch: pa.RecordBatch, old: int, took: np.ndarray) -> pa.RecordBatch:
        """Pairs whose second row is not one of the ``old`` first; ``took``: pairs of each row so far."""
        head, n = batch.column("head").to_numpy(), batch.column("n").to_numpy()
        bits, group = batch.column("bits"), batch.column("group").to_numpy() if "group" in names else None
        if pa.types.is_int64(bits.type):
            bits = bits.to_numpy().view(np.uint64).reshape(-1, 1)
        else:
            bits = unpacked(bits, np.uint64)
        left, right = [], []
        for step in range(1, min(ahead, len(n) - 1) + 1):
            a = np.arange(max(0, old - step), len(n) - step)
            a = a[(head[a] == head[a + step]) & (took[a] < taken)]
            if not len(a):
                continue  # a row further on may still have the same head as one that has pairs enough here
            b = a + step
            a, b = (x[np.minimum(n[a], n[b]) >= ratio * np.maximum(n[a], n[b]) - 1e-6] for x in (a, b))
            if group is not None:
                a, b = (x[group[a] != group[b]] for x in (a, b))
            a, b = (x[agreement(bits[a], bits[b], functions) >= least] for x in (a, b))
            took[a] += 1
            left.append(a)
            right.append(b)
        a, b = (pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (left, right))
        rep = batch.column("rep")
        none = [batch.column(c).take(a) if c == "head" else pa.nulls(len(a), batch.column(c).type) for c in names]
        return pa.RecordBatch.from_arrays([rep.take(a), rep.take(b), *none], ["a", "b", *names])

    def edge(part: pa.Table) -> pa.RecordBatch:
        own = part.select(names).combine_chunks().to_batches()[0]
        none = pa.nulls(own.num_rows, own.column("rep").type)
        return pa.RecordBatch.from_arrays([none, none, *own.columns], ["a", "b", *names])

    return ordered.mapInArrow(
        rows, f"a {fields['rep']}, b {fields['rep']}, " + ", ".join(f"{c} {fields[c]}" for c in names))


def adjacent(rows: DataFrame, functions: int, ratio: float, order: list[str], deviations: float, ahead: int = AHEAD,
             taken: int = TAKEN) -> tuple[DataFrame, DataFrame]:
    """Sort ``rows`` (head, any rest, rep, n, bits) over many tasks and return the distinct pairs of :func:`neighbours`,
    and the heads in which a class has taken all it may.

    Ranges are cut on the whole order, rep included, so rows with one head spread over as many tasks as they need."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = written(neighbours(ordered, functions, ratio, deviations, ahead, taken, True), "near")
    # where partitions meet: 2 * ahead rows of each
    seams = found.where("a is null").coalesce(1).sortWithinPartitions(*order)
    across = neighbours(seams.select(*rows.columns), functions, ratio, deviations, ahead, taken, False)
    both = found.where("a is not null").select("a", "b", "head").unionByName(written(across.select("a", "b", "head"), "across"))
    full = both.groupBy("a", "head").agg(F.count("*").alias("c")).where(f"c >= {taken}").select("head").distinct()
    return both.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), full


def forest(classes: DataFrame, trees: int, depth: int) -> DataFrame:
    """A row for each class (rep, n, sig and others, all long) and tree. Its head is the tree and the first minimum:
    neighbours share that at least."""
    others = [c for c in classes.columns if c != "sig"]

    def planted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = unpacked(batch.column("sig"), np.uint32)
            bits = binary(packed_bits(sig))
            for t in range(trees):
                key = sig[:, t * depth : (t + 1) * depth]
                head = (t << 32) + key[:, 0].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head), binary(key[:, 1:].astype(">u4")), *(batch.column(c) for c in others), bits],
                    ["head", "rest", *others, "bits"])

    return classes.select(*others, "sig").mapInArrow(
        planted, "head long, rest binary, " + ", ".join(f"{c} long" for c in others) + ", bits binary")


def candidates(classes: DataFrame, ratio: float, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Pairs a < b of classes (rep, n, sig) that lie close together in some tree of the forest."""
    return adjacent(forest(classes, trees, depth), trees * depth, ratio, ["head", "rest", "rep"], DEVIATIONS)[0]


def far_candidates(classes: DataFrame, ratio: float, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Pairs of classes of different groups (``group``) in regions that hold more than one."""
    rows = written(forest(classes, trees, depth), "forest")
    mixed = written(rows.groupBy("head").agg(F.min("group").alias("g"), F.max("group").alias("h")).where("g != h").select("head"), "mixed")
    return adjacent(rows.join(mixed.hint("merge"), "head", "left_semi"), trees * depth, ratio, ["head", "rest", "rep"], DEVIATIONS,
                    FAR_AHEAD, FAR_TAKEN)[0]


def crowded(classes: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """rep, group of classes that share a tree's whole key with classes of other groups (``group``), where there are
    more than each surely took in the first pass."""
    rows = written(forest(classes, trees, depth).select("head", "rest", "rep", "group"), "regions")
    mixed = written(rows.groupBy("head", "rest").agg(F.count("*").alias("c"), F.min("group").alias("g"), F.max("group").alias("h"))
                    .where(f"c > {TAKEN + 1} and g != h").select("head", "rest"), "mixed")
    found = written(rows.join(mixed.hint("merge"), ["head", "rest"], "left_semi").select("rep", "group").distinct(), "rest")
    dropped(rows)
    return found


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those pairs of documents whose sets have 100 * intersection >= percent * union."""
    need = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # by merging at every size: a broadcast would only be right while the pairs are few
    full = written(sets(docs.join(need.hint("merge"), "doc_id", "left_semi"), keep=True).where("n_shingles > 0")
                   .select("doc_id", "set"), "sets")

    paired = (pairs.join(full.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a")
              .join(full.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b"))
    return overlapping(paired, percent)


def overlapping(paired: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, x, y) whose sets x and y (sorted hashes) have 100 * intersection >= percent * union, as (u, v)."""
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                common = int(np.count_nonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p))
                keep[i] = 100 * common >= percent * (len(p) + len(q) - common)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in "ab"], ["u", "v"])

    kind = paired.schema["a"].dataType.simpleString()
    return paired.select("a", "b", "x", "y").mapInArrow(verify, f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text",
                    trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least key reachable over links), kept."""
    texts = slim(docs, text, key)
    rows = written(sets(texts, trees, depth), "signatures")
    classes = written(rows.where("n_shingles > 0 and doc_id is not null").groupBy("hi", "lo")
                      .agg(F.min(F.struct("doc_id", "sig")).alias("m"), F.first("n_shingles").alias("n"))
                      .select("hi", "lo", F.col("m.doc_id").alias("rep"), "n", F.col("m.sig").alias("sig")), "classes")
    pairs = written(candidates(classes, percent / 100, trees, depth), "pairs")
    links = written(confirmed(pairs, texts, percent), "links")

    def grouped(roots: DataFrame) -> DataFrame:
        group = roots.select(F.col("node").alias("rep"), F.col("root").alias("group"))
        return classes.select("rep", "n", "sig").join(group, "rep", "left").withColumn("group", F.coalesce("group", "rep"))

    far = written(far_candidates(grouped(components(links)), percent / 100, trees, depth).join(pairs, ["a", "b"], "left_anti"), "far")
    links = links.unionByName(written(confirmed(far, texts, percent), "links"))
    roots = components(links)
    rest = crowded(grouped(roots), trees, depth)
    if not rest.isEmpty():
        full = sets(texts.join(rest.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi"), keep=True)
        own = (full.where("n_shingles > 0").select(F.col("doc_id").alias("rep"), F.col("set").alias("shingles")).dropDuplicates(["rep"])
               .join(rest, "rep").select(F.col("rep").alias("id"), "group", "shingles"))
        more = prefix_pairs(own, percent).join(pairs, ["a", "b"], "left_anti").join(far, ["a", "b"], "left_anti")
        roots = components(links.unionByName(written(confirmed(written(more, "pairs"), texts, percent), "links")))
    named = written(classes.select("hi", "lo", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                    .select("hi", "lo", F.coalesce("root", "rep").alias("component")), "named")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
