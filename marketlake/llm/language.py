"""Operator 10, language identification: script ranges narrow the candidates, Viterbi labels spans of words.

Every word gets a score per language: the sum of log-probabilities of the byte trigrams around its letters, from
counts over all training documents. A language whose training texts don't use the word's scripts is no candidate for
it. Viterbi with a penalty for each switch then labels the words, so mixed text falls into spans; the document's
language is the one that covers most letters, and its score the share of letters that it covers.

Definite results: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing was
learned. Ties go to the alphabetically first language. A null key is never learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import Block, Words, blocks

UNDETERMINED = "und"
BITS = 15  # trigrams are counted in 2**BITS buckets
SWITCH = 12.0  # a switch of language costs as much as a likelihood ratio of e**12
TOGETHER = 4 << 20  # bytes of text that go through Viterbi together
RARE = 0.001  # a script with less than this share of a language's letters isn't one of its scripts

#: UTF-8 lead bytes (first, last) of the letters of each script.
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xCA)],
    "Greek": [(0xCD, 0xCF)],
    "Cyrillic": [(0xD0, 0xD3)],
    "Armenian, Hebrew": [(0xD4, 0xD7)],
    "Arabic, Syriac": [(0xD8, 0xDD)],
    "South and South-East Asian": [(0xE0, 0xE1)],
    "Kana": [(0xE3, 0xE3)],
    "Han": [(0xE4, 0xE9)],
    "Hangul, others": [(0xEA, 0xEF)],
    "Beyond the basic plane": [(0xF0, 0xF4)],
}
_script = np.zeros(256, dtype=np.uint16)  # a bit for each script; 0 for bytes that begin no letter
for _k, _ranges in enumerate(SCRIPTS.values()):
    for _a, _b in _ranges:
        _script[_a : _b + 1] = 1 << _k


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from learning: by crc32 of its key as text."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def trigrams(block: Block) -> np.ndarray:
    """The bucket of the trigram around each byte; outside a text there is a space."""
    low = block.lower.astype(np.uint32)
    low[low - np.uint32(9) < 5] = 32
    before, after = np.full_like(low, 32), np.full_like(low, 32)
    before[1:], after[:-1] = low[:-1], low[1:]
    inner = block.at[(block.at > 0) & (block.at < len(low))]
    before[inner] = 32
    after[inner - 1] = 32
    return (((before << 16) | (low << 8) | after) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def learn(docs: DataFrame) -> Model:
    """``docs``: lang, text. Counts trigrams and scripts of all of them; what comes back has
    (languages * (2**BITS + scripts)) rows at most."""
    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for block in blocks(batches):
            if not len(block.data):
                continue
            langs = np.array(block.column("lang").to_pylist(), dtype=object)
            bucket, script = trigrams(block), _script[block.data]
            letter = script > 0
            owner = np.repeat(np.arange(len(block)), np.diff(block.at))
            for lang in set(langs):
                mine = letter & (langs == lang)[owner]
                total = seen.setdefault(lang, np.zeros((1 << BITS) + len(SCRIPTS), dtype=np.int64))
                total[: 1 << BITS] += np.bincount(bucket[mine], minlength=1 << BITS)
                for k in range(len(SCRIPTS)):
                    total[(1 << BITS) + k] += np.count_nonzero(script[mine] == 1 << k)
        for lang, total in seen.items():
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(total[hit])],
                ["lang", "bucket", "n"])

    found = (docs.select("lang", "text").where("lang is not null and text is not null")
             .mapInArrow(counts, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(found["lang"].to_pylist()))
    table = np.zeros(((1 << BITS) + len(SCRIPTS), len(langs)))
    place = {x: i for i, x in enumerate(langs)}
    table[found["bucket"].to_numpy(), np.array([place[x] for x in found["lang"].to_pylist()], dtype=int)] = found["n"].to_numpy()
    grams, scripts = table[: 1 << BITS], table[1 << BITS :]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * (1 << BITS)))
    used = scripts >= np.maximum(1, RARE * scripts.sum(axis=0))
    return Model(langs, logs.astype(np.float32), (used * (1 << np.arange(len(SCRIPTS)))[:, None]).sum(axis=0).astype(np.uint16))


@dataclass
class Model:
    langs: list[str]
    logs: np.ndarray  # (buckets, languages)
    scripts: np.ndarray  # the scripts of each language, as bits

    def label(self, group: list[Block], switch: float = SWITCH) -> list[tuple[Words, np.ndarray, np.ndarray]]:
        """For each block: its words, each word's number of letters, and its language (an index).

        The blocks' texts go through Viterbi together: its steps are as many as the longest text has words."""
        words = [block.words() for block in group]
        scored = [self.scores(*x) for x in zip(group, words)]
        ends = np.cumsum([0, *(len(w.start) for w in words)])
        labels = np.zeros(ends[-1], dtype=np.int64)
        if len(labels) and self.langs:
            at = np.concatenate([w.at[:-1] + e for w, e in zip(words, ends)] + [ends[-1:]])
            viterbi(np.concatenate([s for s, _ in scored]), at, switch, labels)
        return [(w, letters, labels[a:b]) for w, (_, letters), a, b in zip(words, scored, ends, ends[1:])]

    def labelled(self, parts: Iterable[Block], switch: float) -> Iterator[tuple[Block, Words, np.ndarray, np.ndarray]]:
        for group in together(parts):
            for block, found in zip(group, self.label(group, switch)):
                yield (block, *found)

    def scores(self, block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
        if not len(words.start):
            return np.zeros((0, len(self.langs))), np.zeros(0, dtype=np.int64)
        script = _script[block.data]
        letter = np.flatnonzero(script)
        count = np.zeros(len(script) + 1, dtype=np.int64)
        np.cumsum(script > 0, out=count[1:])
        total = np.zeros((len(letter) + 1, len(self.langs)))
        np.cumsum(self.logs[trigrams(block)[letter]], axis=0, dtype=np.float64, out=total[1:])
        a, b = count[words.start], count[words.end]
        scores = total[b] - total[a]
        seen = np.bitwise_or.reduceat(script, words.start)  # a byte between two words is a space: no script
        allowed = (seen[:, None] & ~self.scripts[None, :]) == 0
        allowed[~allowed.any(axis=1)] = True
        scores[~allowed] -= 1000.0
        return scores, b - a


def viterbi(scores: np.ndarray, at: np.ndarray, switch: float, labels: np.ndarray) -> None:
    """The best labels of each text's words (rows of ``scores``), one switch costing ``switch``.

    A text keeps one label throughout if no stretch of words gains more than one switch by any others; that is found
    without a step per word. The other texts go through the recursion together, word by word."""
    count = np.diff(at)
    full = np.flatnonzero(count)
    total = np.add.reduceat(scores, at[:-1][full], axis=0)
    owner = np.repeat(np.arange(len(full)), count[full])
    one = total.argmax(axis=1)
    labels[:] = one[owner]
    if scores.shape[1] == 1:
        return
    mine = scores[np.arange(len(scores)), labels]
    rest = scores.copy()
    rest[np.arange(len(scores)), labels] = -np.inf
    gain = rest.max(axis=1) - mine
    run = np.cumsum(gain)
    begin = at[:-1][full]
    run -= (run[begin] - gain[begin])[owner]
    # the least sum so far within the text: texts are set apart by more than any sum, each below those before
    apart = (2 * np.abs(run).max() + 1) * owner
    least = np.minimum.accumulate(run - gain - apart) + apart
    mixed = np.flatnonzero(np.maximum.reduceat(run - least, begin) > switch)
    if not len(mixed):
        return
    mixed = mixed[np.argsort(-count[full][mixed], kind="stable")]
    first, n = begin[mixed], count[full][mixed]
    stay = np.zeros(scores.shape, dtype=bool)
    best = np.zeros(len(scores), dtype=np.int64)
    value = scores[first].copy()
    last = value.copy()
    for t in range(1, n[0]):
        k = int(np.searchsorted(-n, -t, side="left"))  # texts with more than t words
        v, word = value[:k], first[:k] + t
        top = v.argmax(axis=1)
        change = v[np.arange(k), top] - switch
        same = v >= change[:, None]
        stay[word], best[word] = same, top
        value[:k] = np.where(same, v, change[:, None]) + scores[word]
    last = value.argmax(axis=1)
    for t in range(n[0] - 1, -1, -1):
        k = int(np.searchsorted(-n, -t, side="left"))
        word = first[:k] + t
        labels[word] = last[:k]
        last[:k] = np.where(stay[word, last[:k]], last[:k], best[word])


def has_letter(block: Block) -> np.ndarray:
    """Whether each text has a letter (Unicode category L)."""
    ascii_letter = ((block.data | 32) >= 97) & ((block.data | 32) <= 122)
    total = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum(ascii_letter, out=total[1:])
    out = total[block.at[1:]] > total[block.at[:-1]]
    for k in np.flatnonzero(~out):
        out[k] = any(c.isalpha() for c in block.data[block.at[k] : block.at[k + 1]].tobytes().decode())
    return out


def together(parts: Iterable[Block], size: int = TOGETHER) -> Iterator[list[Block]]:
    """Blocks in groups of about so many bytes."""
    group, held = [], 0
    for block in parts:
        group.append(block)
        held += len(block.data)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def decided(block: Block, words: Words, letters: np.ndarray, labels: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each text's language (an index; past the last for ``und``) and score."""
    cover = np.zeros((len(block), len(model.langs) + 1))
    np.add.at(cover, (words.text_of(), labels), letters)
    total = cover.sum(axis=1)
    known = has_letter(block) & bool(model.langs)
    # a text's letters may all be of scripts that this module doesn't list: then nothing speaks for any language
    share = np.where(total > 0, cover.max(axis=1) / np.maximum(total, 1), 1.0 / cover.shape[1])
    return np.where(known, cover.argmax(axis=1), len(model.langs)), np.where(known, share, 0.0)


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs``: doc_id, text, held_out. Adds lang_pred, score, and spans: the labelled runs of words, as
    (lang, first byte, end byte) of the text."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = [*model.langs, UNDETERMINED]
        for block, words, letters, labels in model.labelled(blocks(batches), switch):
            pred, score = decided(block, words, letters, labels, model)
            owner = words.text_of()
            turn = np.ones(len(owner), dtype=bool)
            turn[1:] = (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1])
            head = np.flatnonzero(turn & (pred < len(model.langs))[owner])
            begin = np.append(np.flatnonzero(turn), len(owner))
            tail = begin[np.searchsorted(begin, head, side="right")] - 1 if len(head) else head
            base = block.at[owner[head]]
            spans = pa.StructArray.from_arrays(
                [pa.array([langs[i] for i in labels[head]], pa.string()), pa.array(words.start[head] - base),
                 pa.array(words.end[tail] - base)], ["lang", "start", "end"])
            at = np.searchsorted(owner[head], np.arange(len(block) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array([langs[i] for i in pred], pa.string()),
                 pa.array(score), pa.ListArray.from_arrays(pa.array(at), spans)],
                ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return docs.mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double, "
                                 "spans array<struct<lang: string, start: long, end: long>>")


def accepted(docs: DataFrame, folds: int = 3, fold: int = 1, switch: float = SWITCH, key: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a language (isn't ``und``)."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, letters, labels in model.labelled(blocks(batches, text), switch):
            pred, _ = decided(block, words, letters, labels, model)
            yield block.rows.filter(pa.array(pred < len(model.langs)))

    key_ = F.col(f"`{key}`")
    model = learn(docs.where(key_.isNotNull() & ~held_out(key_, folds, fold))
                  .select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")))
    return docs.mapInArrow(rows, docs.schema)


def identify(docs: DataFrame, folds: int = 3, fold: int = 1, switch: float = SWITCH, key: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents outside the held-out fold, then predict every document from its text alone."""
    key_, text_ = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    train = (docs.where(key_.isNotNull() & ~held_out(key_, folds, fold))
             .select(F.col(f"`{lang}`").cast("string").alias("lang"), text_.alias("text")))
    rows = docs.select(key_.cast("long").alias("doc_id"), text_.alias("text"), held_out(key_, folds, fold).alias("held_out"))
    return predict(rows, learn(train), switch)
