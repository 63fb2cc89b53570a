"""Operator 7, repeated passages: units of lines are normalised and hashed, digests grouped over the corpus, and every
occurrence but the earliest is marked for removal, with its place in the original text.

A unit is a line, cut after words that BOUNDARY picks by their first and last byte and their size: the cuts depend on the
words alone, so a passage falls into the same units wherever it stands in a line, however long the line is and in
whatever script. A unit's digest (128 bits) is taken over its words, so case of A-Z and the amount of white space don't
count. The earliest occurrence is the one with the least (doc_id, start). Short units coincide by chance; so of the
others only runs of neighbouring units of LETTERS letters or more together are marked, and lone common phrases stay.
Letters are counted in code points (digits, and all but ASCII's signs), so unspaced scripts count as any other.

What this can't find: a passage shorter than LETTERS, and the words of a passage that share their unit with words around it.

Definite results: null and empty texts have no units; rows with a null key take no part; repeated rows count once, and
rows that repeat a key with another text are told apart by ``text_hash``. Texts of any length are read whole; an empty table
gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.blocks import Block, Words, blocks, range_hash
from marketlake.llm.tables import slim, written

LEAST_WORDS = 5
LETTERS = 150
BOUNDARY = (31, 17, 7, 8)  # a unit ends after a word with 31 * first byte + 17 * last byte + 7 * bytes divisible by 8
_OTHER = 0xD1342543DE82EF95


def line_runs(block: Block, words: Words) -> tuple[np.ndarray, ...]:
    """Lines that have words: text, first word, end word, first byte, end byte (with the line's newline)."""
    text = words.text_of()
    feeds = np.flatnonzero(block.data == 10)
    line = np.searchsorted(feeds, words.start)
    turn = np.ones(len(text), dtype=bool)
    turn[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    head = np.flatnonzero(turn)
    tail = np.append(head[1:], len(text)) if len(head) else head
    text, line = text[head], line[head]
    start, end = np.append(-1, feeds)[line] + 1, np.append(feeds + 1, len(block.data))[line]
    return text, head, tail, np.maximum(start, block.at[text]), np.minimum(end, block.at[text + 1])


def digests(words: Words, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each run of words."""
    return range_hash(words.hash, head, tail), range_hash(words.hash, head, tail, _OTHER)


def unit_runs(block: Block, words: Words) -> tuple[np.ndarray, ...]:
    """Units: text, number within the text, first word, end word, first byte, end byte (units tile their line, the last one
    has its newline), letters."""
    text, lower = words.text_of(), block.lower
    line_text, line_head, _, line_start, line_end = line_runs(block, words)
    first, last, size = lower[words.start].astype(np.int64), lower[words.end - 1].astype(np.int64), words.end - words.start
    a, b, c, every = BOUNDARY
    turn = np.zeros(len(text) + 1, dtype=bool)
    turn[1:] = (a * first + b * last + c * size) % every == 0
    turn = turn[:-1]
    turn[line_head] = True
    head = np.flatnonzero(turn)
    tail = np.append(head[1:], len(text)) if len(head) else head
    line = np.searchsorted(line_head, head, side="right") - 1
    opens = line_head[line] == head
    start = np.where(opens, line_start[line], words.start[head])
    closes = np.append(opens[1:], True) if len(head) else opens
    end = np.where(closes, line_end[line], np.append(start[1:], 0))
    own = text[head]
    number = np.arange(len(head)) - np.searchsorted(own, own)
    letter = ((lower - np.uint8(97)) < 26) | ((lower - np.uint8(48)) < 10) | (lower >= 0xC0)
    upto = np.concatenate([[0], np.cumsum(letter)])
    return own, number, head, tail, start, end, upto[end] - upto[start]


def hashed(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, text, text_hash. Every unit, with offsets in code points."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = block.words()
            text, number, head, tail, start, end, letters = unit_runs(block, words)
            hi, lo = (x.view(np.int64) for x in digests(words, head, tail))
            base = block.chars_before(block.at[text])
            start, end = block.chars_before(start) - base, block.chars_before(end) - base
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(own), block.column("text_hash").take(own), pa.array(number.astype(np.int32)), pa.array(start), pa.array(end),
                 pa.array((tail - head).astype(np.int32)), pa.array(letters.astype(np.int32)), pa.array(hi), pa.array(lo)],
                ["doc_id", "text_hash", "i", "start", "end", "n_words", "letters", "hi", "lo"])

    return docs.mapInArrow(rows, "doc_id long, text_hash long, i int, start long, end long, n_words int, letters int, hi long, lo long")


def repeated(docs: DataFrame, letters: int = LETTERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit to remove: doc_id, text_hash, start, end (code points, end exclusive, a line's last unit with its
    newline), n_words, and first_doc_id, first_start: the occurrence that stays. ``letters``: of the least run to remove."""
    texts = slim(docs, text, key).where("doc_id is not null").withColumn("text_hash", F.xxhash64("text"))
    units = written(hashed(texts), "units")
    # minima are combined before the shuffle; as a table of its own, so that a very common unit's rows can be split
    first = written(units.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "start", "text_hash")).alias("f"), F.count("*").alias("n"))
                    .where("n > 1").select("hi", "lo", F.col("f.doc_id").alias("first_doc_id"),
                                           F.col("f.start").alias("first_start"), F.col("f.text_hash").alias("_h")), "first")
    rest = ~((F.col("doc_id") == F.col("first_doc_id")) & (F.col("start") == F.col("first_start"))
             & F.col("text_hash").eqNullSafe(F.col("_h")))
    again = units.join(first, ["hi", "lo"]).where(rest).dropDuplicates(["doc_id", "text_hash", "i"])
    order = Window.partitionBy("doc_id", "text_hash").orderBy("i")  # one document's units
    runs = again.withColumn("_run", F.col("i") - F.row_number().over(order))
    long = F.sum("letters").over(Window.partitionBy("doc_id", "text_hash", "_run")) >= letters
    return (runs.withColumn("_long", long).where("_long")
            .select("doc_id", "text_hash", "start", "end", F.col("n_words").cast("long").alias("n_words"), "first_doc_id", "first_start"))
