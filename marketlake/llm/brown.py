"""Operator 8, scores by a class-based bigram model (Brown et al., 1992) with classes from exchange clustering.

A text's words, and an end after them, have P = product of P(class | class before) * P(word | class); a text begins as
after an end. Classes start from frequency ranks and are improved by exchange: in each round every unit's move to each
class is valued by the exact change of the class bigram likelihood, from counts over all training documents, and the
best moves are made (of alternate halves of the units, since their values presume that the others stay).

Units of the clustering are the ``UNITS`` most frequent words, and beyond these the words' endings (the last three
bytes, in ``ENDINGS`` groups), so a word that training never saw has a class as well. Every word keeps its own
emission probability: its count, over all training documents, is looked up in a table that grows with the vocabulary.
Only tables whose size the parameters bound are sent to all tasks; rarer words meet their counts in a join.

P(class | before) backs off to the class's share; P(word | class) has half a count added for each word of the class
and for an unseen one. Both sum to one, so ``score`` is comparable with the base score and gives a perplexity.

Definite results: a null text is empty (the end alone); a row with a null key is never learned from and not held out;
repeated rows are scored each; without training documents all scores are of unseen words. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import Block, Words, blocks, mix
from marketlake.llm.tables import dropped, written

UNITS = 4096  # words that are clustered as themselves
ENDINGS = 1024
CLASSES = 64
ROUNDS = 10
KNOWN = 1 << 18  # words whose counts every task has; the counts of others are joined
HELD = 1 << 21  # words that a task counts before it hands them on
PAIRS = 1 << 20  # unit pairs in a row of the table of bigrams
CHUNK = 64  # units whose counts travel together
SHARE = 2.0  # weight of a class's overall share in its transition probabilities
_U = np.uint64


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from learning: by crc32 of its key as text."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def endings(block: Block, words: Words) -> np.ndarray:
    """Each word's group by its last three bytes."""
    out = np.zeros(len(words.start), dtype=np.uint64)
    low = block.lower
    for back in (1, 2, 3):
        at = words.end - back
        out = out * _U(257) + np.where(at >= words.start, low[np.maximum(at, 0)].astype(np.uint64) + _U(1), _U(0))
    return (mix(out) % _U(ENDINGS)).astype(np.int32)


def summed(keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with their counts added up, and the first of each other value."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return (keys[head], np.add.reduceat(counts[order], head) if len(head) else counts, *(x[order][head] for x in more))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash), ending, n over all texts. A task adds up what it reads before anything is shuffled."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, merged = 0, 0
        for block in blocks(batches):
            words = block.words()
            held.append(summed(words.hash, np.ones(len(words.hash), dtype=np.int64), endings(block, words)))
            size += len(held[-1][0])
            if size > max(HELD // 4, 2 * merged):
                held = [summed(*map(np.concatenate, zip(*held)))]
                size = merged = len(held[0][0])
                if merged > HELD:
                    yield batch(*held.pop())
                    size = merged = 0
        if held:
            yield batch(*summed(*map(np.concatenate, zip(*held))))

    def batch(word: np.ndarray, n: np.ndarray, ending: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(ending), pa.array(n)], ["word", "ending", "n"])

    return (texts.select("text").mapInArrow(rows, "word long, ending int, n long")
            .groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")))


def looked_up(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def units_of(block: Block, words: Words, frequent: np.ndarray) -> np.ndarray:
    """Each word's unit: its place among the frequent words (sorted hashes), or after these its ending's group."""
    at = looked_up(frequent, words.hash)
    return np.where(at >= 0, at, len(frequent) + endings(block, words))


def with_ends(values: np.ndarray, words: Words, end: int) -> np.ndarray:
    """The values of all words with ``end`` after each text's."""
    texts = len(words.at) - 1
    out = np.full(len(values) + texts, end, dtype=np.int64)
    out[np.arange(len(values)) + words.text_of()] = values
    return out


def unit_bigrams(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """How often unit b follows unit a, added up per task only, in blocks: pairs (a * units + b, 32 bits) and counts (32
    bits) as two binary values. The last unit number is the end's."""
    end = len(frequent) + ENDINGS
    share = texts.sparkSession.sparkContext.broadcast(frequent)  # UNITS hashes at most

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, merged = [], 0, 0
        for block in blocks(batches):
            words = block.words()
            seq = with_ends(units_of(block, words, share.value), words, end)
            before = np.append(end, seq[:-1])
            held.append(summed(before * (end + 1) + seq, np.ones(len(seq), dtype=np.int64)))
            size += len(held[-1][0])
            if size > max(HELD // 4, 2 * merged):
                held = [summed(*map(np.concatenate, zip(*held)))]
                size = merged = len(held[0][0])
                if merged > HELD:
                    yield from cut(*held.pop())
                    size = merged = 0
        if held:
            yield from cut(*summed(*map(np.concatenate, zip(*held))))

    def cut(pair: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(pair), PAIRS):
            values = [x[k : k + PAIRS].astype(np.uint32).tobytes() for x in (pair, n)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in values], ["pairs", "counts"])

    return texts.select("text").mapInArrow(rows, "pairs binary, counts binary")


def neighbours_by_class(bigrams: DataFrame, label: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit: how often each class stands before it, and after it, and how often it follows itself.

    What a task hands on, and what comes back, has units * (2 * classes + 1) numbers, whatever the corpus."""
    units, width = len(label), 2 * classes + 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(units * width, dtype=np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs"), batch.column("counts")):
                pair, n = (np.frombuffer(x.as_buffer(), np.uint32) for x in (pairs, counts))
                a, b = np.divmod(pair.astype(np.int64), units)
                own = a == b
                for at, weight in ((b * width + label[a], n), (a * width + classes + label[b], n), (a[own] * width + 2 * classes, n[own])):
                    total += np.bincount(at, weights=weight, minlength=len(total)).astype(np.int64)
        rows = total.reshape(units, width)
        parts = [rows[k : k + CHUNK].tobytes() for k in range(0, units, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary())], ["chunk", "part"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group.column("part"))
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    found = bigrams.mapInArrow(count, "chunk int, part binary").groupBy("chunk").applyInArrow(add, "chunk int, part binary").toArrow()
    out = np.zeros((units, width))
    for chunk, part in zip(found.column("chunk").to_pylist(), found.column("part").to_pylist()):
        own = np.frombuffer(part, np.int64).reshape(-1, width)
        out[chunk * CHUNK : chunk * CHUNK + len(own)] = own
    return out[:, :classes], out[:, classes:-1], out[:, -1]


def exchanged(label: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, movable: np.ndarray) -> tuple[np.ndarray, int]:
    """One round: each movable unit in the class that raises the class bigram likelihood most, the others staying.

    The likelihood is sum f(N[a, b]) - sum f(N[a, .]) - sum f(N[., b]) plus a constant, with f(x) = x log x."""
    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    classes = left.shape[1]
    table = np.zeros((classes, classes))
    np.add.at(table, label, right)  # row: class of the first word
    out, moves = label.copy(), 0
    for u in np.flatnonzero(movable):
        c, before, after, self_ = label[u], left[u], right[u], own[u]
        if not before.any() and not after.any():
            continue
        rest = table.copy()  # without this unit
        rest[:, c] -= before
        rest[c, :] -= after
        rest[c, c] += self_
        inward, outward = before.copy(), after.copy()  # its neighbours other than itself
        inward[c] -= self_
        outward[c] -= self_
        row, column = rest.sum(axis=1), rest.sum(axis=0)
        # joining d: column d gains inward, row d gains outward, and the cell (d, d) both and the unit's own pairs
        gain = (f(rest + inward[:, None]) - f(rest)).sum(axis=0) + (f(rest + outward[None, :]) - f(rest)).sum(axis=1)
        diagonal = np.diagonal(rest)
        gain += (f(diagonal + inward + outward + self_) - f(diagonal + inward) - f(diagonal + outward) + f(diagonal))
        gain -= f(row + outward.sum() + self_) - f(row) + f(column + inward.sum() + self_) - f(column)
        # rows' and columns' sums other than d's also grow by its neighbours, in every case alike
        gain[-1] = -np.inf  # the end's class is its own
        best = int(gain.argmax())
        if gain[best] > gain[c] + 1e-9:
            out[u] = best
            moves += 1
            rest[:, best] += inward
            rest[best, :] += outward
            rest[best, best] += self_
            table = rest  # the next unit is valued with this one moved
    return out, moves


def cluster(bigrams: DataFrame, sizes: np.ndarray, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """A class for each unit (the last, the end, alone in the last class), and the counts of class bigrams."""
    label = np.empty(len(sizes), dtype=np.int64)
    label[np.argsort(-sizes[:-1], kind="stable")] = np.arange(len(sizes) - 1) % classes
    label = np.append(label[: len(sizes) - 1], classes)
    half = mix(np.arange(len(sizes), dtype=np.uint64)) & _U(1)
    idle = 0
    for turn in range(rounds):
        left, right, own = neighbours_by_class(bigrams, label, classes + 1)
        movable = half == turn % 2
        movable[-1] = False
        label, moves = exchanged(label, left, right, own, movable)
        idle = 0 if moves else idle + 1
        if idle == 2:
            break
    _, right, _ = neighbours_by_class(bigrams, label, classes + 1)
    table = np.zeros((classes + 1, classes + 1))
    np.add.at(table, label, right)
    return label, table


@dataclass
class Model:
    """Everything that the parameters bound."""

    frequent: np.ndarray  # sorted hashes of the words that are units
    label: np.ndarray  # class of each unit
    step: np.ndarray  # log10 P(class | class before)
    spread: np.ndarray  # log10 of what a word's count is divided by, for each class
    known: np.ndarray  # sorted hashes of the most frequent words
    known_n: np.ndarray
    total: int  # training tokens, ends included
    vocabulary: int
    ends: int

    @property
    def floor(self) -> float:
        """log10 of what a count is divided by in the base score."""
        return float(np.log10(self.total + 0.5 * (self.vocabulary + 1)))


def learn(texts: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model for training texts (column ``text``), and the table of all word counts (word, ending, n)."""
    counts = written(word_counts(texts), "words")
    ends = texts.count()
    stats = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).select("word", "n").toArrow()  # bounded by KNOWN
    word, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    frequent = np.sort(word[:UNITS])
    spark = texts.sparkSession
    units = spark.createDataFrame(zip(frequent.view(np.int64).tolist(), range(len(frequent))), "word long, unit int")  # UNITS rows at most
    by_unit = (counts.join(F.broadcast(units), "word", "left")
               .groupBy(F.coalesce("unit", F.lit(len(frequent)) + F.col("ending")).alias("unit"))
               .agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow())
    size, distinct = np.zeros(len(frequent) + ENDINGS + 1), np.zeros(len(frequent) + ENDINGS + 1)
    size[by_unit["unit"].to_numpy()] = by_unit["n"].to_numpy()
    distinct[by_unit["unit"].to_numpy()] = by_unit["v"].to_numpy()
    bigrams = written(unit_bigrams(texts, frequent), "bigrams")
    label, table = cluster(bigrams, size, classes, rounds)
    dropped(bigrams)
    share = (table.sum(axis=0) + 1) / (table.sum() + classes + 1)
    step = np.log10((table + SHARE * share[None, :]) / (table.sum(axis=1, keepdims=True) + SHARE))
    spread = np.log10(np.bincount(label, weights=size, minlength=classes + 1)
                      + 0.5 * (np.bincount(label, weights=distinct, minlength=classes + 1) + 1))
    spread[-1] = 0.0
    order = np.argsort(word)
    return Model(frequent, label, step, spread, word[order], n[order], int(stats["n"]) + ends, stats["v"] + (ends > 0), ends), counts


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``docs``: doc_id, text, held_out. The scores of all rows."""
    share = docs.sparkSession.sparkContext.broadcast(vars(model))  # its size depends on the parameters alone
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "n"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**share.value)
        for block in blocks(batches):
            words = block.words()
            text, texts = words.text_of(), len(block)
            label = m.label[units_of(block, words, m.frequent)]
            seq = with_ends(label, words, len(m.spread) - 1)
            owner = with_ends(text, words, 0)
            owner[words.at[1:] + np.arange(texts)] = np.arange(texts)
            before = np.append(len(m.spread) - 1, seq[:-1])
            path = np.bincount(owner, weights=m.step[before, seq] - m.spread[seq], minlength=texts)
            at = looked_up(m.known, words.hash)
            seen = at >= 0
            part = np.bincount(text[seen], weights=np.log10(m.known_n[at[seen]] + 0.5), minlength=texts) if seen.any() else np.zeros(texts)
            tokens = np.diff(words.at) + 1
            known = np.bincount(text[seen], minlength=texts) + (m.ends > 0)
            row = block.column("row")
            none = pa.nulls(texts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [row, block.column("doc_id"), block.column("held_out"), pa.array(tokens), pa.array(known),
                 pa.array(part + np.log10(m.ends + 0.5) - tokens * m.floor), pa.array(part + path), none, none], names)
            if seen.all():
                continue
            # words that aren't among the known: once for each text, for the join with their counts
            rare = ~seen
            order = np.lexsort((words.hash[rare], text[rare]))
            t, w = text[rare][order], words.hash[rare][order]
            head = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (w[1:] != w[:-1])))
            n = np.diff(np.append(head, len(t)))
            empty = [pa.nulls(len(head), kind) for kind in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([row.take(pa.array(t[head])), *empty, pa.array(w[head].view(np.int64)), pa.array(n)], names)

    # a row's number holds from here on, since the table is written once
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    found = written(numbered.select("row", "doc_id", "text", "held_out").mapInArrow(
        rows, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word long, n long"), "scored")
    rare = (found.where("word is not null").select("row", "word", F.col("n").alias("m"))
            .join(counts.select("word", "n"), "word", "left")
            .groupBy("row").agg(F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
                                F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("seen")))
    more = F.coalesce("more", F.lit(0.0))
    return (found.where("word is null").drop("word", "n").join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
                    F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
                    (F.col("score") + more).alias("score"))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))


def score(docs: DataFrame, folds: int = 5, fold: int = 1, classes: int = CLASSES, rounds: int = ROUNDS, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Learn from the documents outside the held-out fold; one row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, perplexity."""
    key_, text_ = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    rows = docs.select(key_.cast("long").alias("doc_id"), text_.alias("text"), held_out(key_, folds, fold).alias("held_out"))
    model, counts = learn(rows.where("doc_id is not null and not held_out").select("text"), classes, rounds)
    return scored(rows, model, counts)
