"""Operator 9, best-fit-decreasing packing of token sequences, with a segment tree over remaining capacities.

Pieces of one length are interchangeable, so the whole corpus is packed from the count of pieces of each length:
``plan`` walks the lengths downwards, asks the segment tree for the tightest capacity that some open bin still has,
and places a run of equal pieces there at once. That is what best-fit decreasing does document by document, but its
state (a tree over 0..capacity and intervals of bins) depends on the capacity, not on the corpus. Every piece then
finds its bin by its length and its rank among pieces of that length, so no task holds more than its own rows.

Definite results: a null or empty text is the end token alone; repeated rows are packed as rows of their own; a null
key is carried along; other columns are ignored. Texts are tokenised whole.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.ranks import numbered
from marketlake.llm.tables import slim, written

END = 2
ROWS = 256  # texts that a worker holds as Python strings at a time
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """How many open bins have each remaining capacity; finds the least capacity that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += n
            node //= 2

    def tightest(self, size: int) -> int | None:
        """The least capacity >= size of an open bin. Up from the leaf until a right sibling holds bins, then down."""
        node = self.leaves + size
        if self.count[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan(pieces: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing of ``pieces`` (length -> how many) as rules (length, first rank, first bin, offset).

    The pieces of a length, numbered from 0, from a rule's first rank up to the next rule's go one each into the bins
    from its first bin on, at its offset."""
    tree, free, rules, bins = CapacityTree(capacity), defaultdict(list), [], 0
    for size in sorted(pieces, reverse=True):
        left, rank = pieces[size], 0
        while left:
            room = tree.tightest(size)
            if room is None:  # none fits: open as many as the rest needs
                room, n = capacity, -(-left // (capacity // size))
                spans, bins = [(bins, n)], bins + n
            else:
                spans = free.pop(room)
                tree.add(room, -sum(n for _, n in spans))
            each = room // size  # the tightest bin stays the tightest until no such piece fits
            for first, n in spans:
                full = min(n, left // each)
                for layer in range(each if full else 0):
                    rules.append((size, rank, first, capacity - room + layer * size))
                    rank += full
                left -= full * each
                part = left if full < n and left < each else 0
                for layer in range(part):
                    rules.append((size, rank, first + full, capacity - room + layer * size))
                    rank += 1
                left -= part
                for begin, count, rest in ((first, full, room - each * size),
                                           (first + full, bool(part), room - part * size),
                                           (first + full + bool(part), n - full - bool(part), room)):
                    if count and rest:
                        free[rest].append((begin, int(count)))
                        tree.add(rest, int(count))
    return rules


def added_tokens(tokenizer_file: str) -> dict[str, int]:
    """The tokens that a tokenizer's JSON adds to its vocabulary: they are found in texts before anything else."""
    with open(tokenizer_file, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


def encoder(ranks_file: str, pattern: str, added: dict[str, int] | None = None, tokenizer_file: str | None = None):
    """Encodes texts by the byte-level BPE vocabulary whose ranks ``ranks_file`` lists. Texts are split at ``added``
    tokens, which get their ids; without them nothing is special. Texts that its pattern can't take apart (a run of a
    million blanks) are encoded by ``tokenizer_file``, the same vocabulary as a tokenizer: slower, and without a limit."""
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    made = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added or {})
    fast = partial(made.encode, allowed_special="all") if added else made.encode_ordinary
    slow = []

    def encode(text: str) -> list[int]:
        try:
            return fast(text)
        except ValueError:  # its pattern's stack is full
            if tokenizer_file is None:
                raise
        if not slow:
            import tokenizers

            slow.append(tokenizers.Tokenizer.from_file(tokenizer_file))
            slow[0].encode_special_tokens = not added
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def cut(docs: DataFrame, ranks_file: str, pattern: str, capacity: int = 1024, end: int = END,
        keep_ids: bool = False, added: dict[str, int] | None = None, tokenizer_file: str | None = None) -> DataFrame:
    """Token pieces of at most ``capacity``: a longer text's first piece takes what is over, the others are full.

    ``keep_ids`` adds ``ids`` (binary, little-endian unsigned 32-bit)."""
    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file, pattern, added, tokenizer_file)
        for batch in (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS)):
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array(encode(text or "") + [end], dtype="<u4")
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    raw = ids[a:b].tobytes()
                    out.append((key, k, a, b - a, zlib.crc32(raw), raw)[: 5 + keep_ids])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(zip(*out) if out else [[]] * (5 + keep_ids), types)], names)

    schema = PIECES + ", ids binary" * keep_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + keep_ids]
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.mapInArrow(pieces, schema)


def pack(docs: DataFrame, ranks_file: str | None = None, pattern: str | None = None, capacity: int = 1024,
         end: int = END, key: str = "doc_id", text: str = "text", keep_ids: bool = False,
         added: dict[str, int] | None = None, tokenizer_file: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    if ranks_file is None:
        import public_tokenizers

        ranks_file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
        tokenizer_file = public_tokenizers.path("byte_bpe_50k.json")
    pieces = written(cut(slim(docs, text, key), ranks_file, pattern, capacity, end, keep_ids, added, tokenizer_file), "pieces")
    # at most `capacity` rows
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # their number depends on the capacity alone: at most one run of bins is cut in two at each step
    rules = np.array(sorted(plan(lengths, capacity)) or np.zeros((0, 4)), dtype=np.int64).reshape(-1, 4)
    order = ["doc_id", "piece", "ids_crc32"]
    ranked = numbered(pieces, "length", order, order, "_rank")
    names = pieces.columns

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = {int(s): np.searchsorted(rules[:, 0], [s, s + 1]) for s in np.unique(rules[:, 0])}
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            rule = np.zeros(len(rank), dtype=np.int64)
            for s in np.unique(length):
                a, b = begins[int(s)]
                mine = length == s
                rule[mine] = a + np.searchsorted(rules[a:b, 1], rank[mine], side="right") - 1
            found = rules[rule]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found[:, 2] + rank - found[:, 1]), pa.array(found[:, 3])],
                [*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(
        place, PIECES + ", ids binary" * keep_ids + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (from ``pack(..., keep_ids=True)``): sequence_id, length, ids, doc_ids.

    A sequence has at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p"))
            .select("sequence_id", "length", F.expr("aggregate(p.ids, X'', (a, x) -> concat(a, x))").alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))
