"""Operator 13, spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's frequency vector is its length and the counts of its letters in 32 groups (a code point's low five bits), the
commonest groups first; counts stop at 255. One inserted, deleted or replaced letter changes the vector by at most one
surplus and one deficit. The trie arranges the words by successive counts; from its root a depth-first search takes every
word along its own counts and spends a budget of one surplus and one deficit on the way; the words of the leaves that it
reaches are verified letter by letter. Of two words the one that lacks the first differing count does the search, so every
pair is met once: spending begins with a surplus, and after a longer word's no deficit is left.

The trie is distributed. Its upper levels are tables: in every round open nodes get the next levels, searches are handed
on to the children that exist, and a node with at most LEAST words is closed. A closed node's words and the searches that
reached it meet in one task, which builds the lower levels as sorted arrays and goes on from there; nodes with more
searches, and leaves with more words, than a task should hold are dealt out in blocks, so no task's input grows with the
table. Nothing but the 32 letter totals and a yes or no per round comes to the driver.

Definite results: null and empty texts have no words; a null key counts as an empty one; repeated rows count as often as
they come; long words and long texts are read whole; an empty table gives an empty one. Of near words of equal n the first
in code-point order is the form. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import dropped, slim, written

GROUPS = 32
LEVELS = GROUPS + 1
FIRST, STEP = 4, 2  # levels of the first round, and of every other one
LEAST = 1 << 14  # words of a closed node
BLOCK = 1 << 16  # searches of a task
PAIRS = 1 << 15  # pairs that a task verifies at a time, but for a leaf of more words
WIDE = 64  # longer words are compared one by one
RATIO = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (state, what the trie's count has more than the search's own, state after). 0: nothing spent; 1: a deficit is left;
#: 2: the trie's words are one longer, their surplus is left; 3: all spent.
SPENDING = [(0, 0, 0), (0, 1, 1), (1, 0, 1), (1, -1, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3)]
LENGTHS = [(0, 0, 0), (0, 1, 2)]


def words(docs: DataFrame, every: int = 31, least: int = 7, twice: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """word, n: the words of ``least`` letters and ``twice`` occurrences or more. Words are runs of Latin letters, A-Z as a-z.
    Where ``every`` divides the crc32 of "key:run", the run loses its letter number crc32 modulo its length."""
    # a shorter run can't become a long enough word, so only the others are taken out
    run = F.explode(F.regexp_extract_all("text", F.lit(rf"([A-Za-zÀ-ÿ]{{{least},}})"), 1))
    runs = slim(docs, text, key).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), run.alias("run"))
    hashed = (runs.select("key", F.translate("run", UPPER, LOWER).alias("run"))
              .select("run", F.crc32(F.concat_ws(":", "key", "run")).alias("h"), F.length("run").alias("size")))
    at = F.pmod("h", "size").cast("int")
    garbled = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("size")))
    return (hashed.select(F.when(F.col("h") % every == 0, garbled).otherwise(F.col("run")).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= least) & (F.col("n") >= twice)))


# ------------------------------------------------------------------ frequency vectors

class Letters:
    """Words of an Arrow column as code points: ``flat``, where each begins, its length."""

    def __init__(self, column: pa.Array):
        self.words = column.to_pylist()
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer("".join(self.words).encode("utf-32-le"), dtype="<u4")

    def totals(self) -> np.ndarray:
        return np.bincount(self.flat & (GROUPS - 1), minlength=GROUPS)

    def vectors(self, order: list[int]) -> np.ndarray:
        """(words, LEVELS) uint8: length, then the groups' counts in their order."""
        row = np.repeat(np.arange(len(self.words)), self.length)
        counts = np.bincount(row * GROUPS + (self.flat & (GROUPS - 1)), minlength=len(self.words) * GROUPS).reshape(-1, GROUPS)
        return np.minimum(np.column_stack([self.length, counts[:, order]]), 255).astype(np.uint8)

    def padded(self) -> np.ndarray:
        """(words, WIDE + 2): the first letters, zeros after the end."""
        out = np.zeros((len(self.words), WIDE + 2), dtype=np.uint32)
        row, column = np.repeat(np.arange(len(self.words)), self.length), np.arange(len(self.flat)) - np.repeat(self.at[:-1], self.length)
        short = column < WIDE + 1
        out[row[short], column[short]] = self.flat[short]
        return out


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


def _verified(asked: Letters, kept: Letters, one: np.ndarray, two: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs (numbers in asked and kept) are one edit apart; left, right: the padded letters of both sides."""
    la, lb = asked.length[one], kept.length[two]
    short = (la <= WIDE) & (lb <= WIDE)
    out = np.zeros(len(one), dtype=bool)
    for i in np.flatnonzero(~short):
        out[i] = one_edit(asked.words[one[i]], kept.words[two[i]])
    own = np.flatnonzero(short)
    a, b = left[one[own]], right[two[own]]
    differ = a != b
    out[own] = (la[own] == lb[own]) & (differ.sum(axis=1) == 1)
    longer = np.flatnonzero(lb[own] == la[own] + 1)
    a, b, first = a[longer], b[longer], differ[longer].argmax(axis=1)
    behind = np.arange(WIDE + 1) >= first[:, None]
    out[own[longer]] = ~((a[:, :-1] != b[:, 1:]) & behind).any(axis=1)
    return out


# ------------------------------------------------------------------ the trie's lower levels, in one task

class Trie:
    """Words under one node, sorted by vector: for each level the children's keys (parent * 256 + count) and first rows."""

    def __init__(self, vectors: np.ndarray, depth: int):
        self.order = np.argsort(np.ascontiguousarray(vectors).view(f"S{LEVELS}").ravel(), kind="stable")
        self.vectors, self.depth = vectors[self.order], depth
        fresh = np.zeros(len(vectors), dtype=bool)
        fresh[:1] = True
        parent, self.keys, self.first = np.zeros(len(vectors), dtype=np.int64), [], []
        for level in range(depth, LEVELS):
            count = self.vectors[:, level]
            fresh[1:] |= count[1:] != count[:-1]
            first = np.flatnonzero(fresh)
            self.keys.append(parent[first] * 256 + count[first])
            self.first.append(np.append(first, len(vectors)))
            parent = np.cumsum(fresh) - 1

    def reached(self, searches: np.ndarray, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (search, row) within the budget, PAIRS at a time; a node with one word is compared whole at once."""
        search, node = np.arange(len(searches)), np.zeros(len(searches), dtype=np.int64)
        for level, (keys, first) in enumerate(zip(self.keys, self.first), self.depth):
            own, parts = searches[search, level].astype(np.int64), []
            for before, more, after in SPENDING if level else LENGTHS:
                at = np.flatnonzero(state == before)
                count = own[at] + more
                inside = (count >= 0) & (count < 256)
                at, key = at[inside], node[at[inside]] * 256 + count[inside]
                child = np.searchsorted(keys, key)
                there = keys[np.minimum(child, len(keys) - 1)] == key
                parts.append((search[at[there]], child[there], np.full(int(there.sum()), after, dtype=np.int8)))
            search, node, state = (np.concatenate(x) for x in zip(*parts))
            size = first[node + 1] - first[node]
            ended = (size == 1) | (level == LEVELS - 1)
            yield from self._rows(searches, search[ended], first[node[ended]], size[ended])
            search, node, state = search[~ended], node[~ended], state[~ended]
            if not len(search):
                break

    def _rows(self, searches: np.ndarray, search: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total = np.cumsum(size)
        begin = 0
        while begin < len(search):
            end = max(begin + 1, int(np.searchsorted(total, total[begin] - size[begin] + PAIRS, side="right")))
            n = size[begin:end]
            row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[begin:end], n)
            yield self._within(searches, np.repeat(search[begin:end], n), row)
            begin = end

    def _within(self, searches: np.ndarray, search: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose whole vectors keep to the budget, and to its direction."""
        more = self.vectors[row].astype(np.int16) - searches[search]
        up, down = np.maximum(more[:, 1:], 0).sum(axis=1), np.maximum(-more[:, 1:], 0).sum(axis=1)
        lead = more[np.arange(len(more)), (more != 0).argmax(axis=1)]
        good = (up <= 1) & (down <= 1) & (lead >= 0) & (more[:, 0] <= 1)
        return search[good], row[good]


def near_pairs(kept: pa.Table, asked: pa.Table, order: list[int], depth: int, block: int = 1 << 12) -> pa.Table:
    """Pairs of words one edit apart, of the words ``kept`` under a node and the searches ``asked`` that came there."""
    resident = Letters(kept.column("word"))
    out = [np.zeros((2, 0), dtype=np.int64)]
    if len(resident.words) and len(asked):
        trie, right = Trie(resident.vectors(order), depth), resident.padded()
        for begin in range(0, len(asked), block):
            part = asked.slice(begin, block)
            visitor = Letters(part.column("word"))
            searches, left = visitor.vectors(order), visitor.padded()
            for a, row in trie.reached(searches, part.column("state").to_numpy().astype(np.int8)):
                b = trie.order[row]
                good = _verified(visitor, resident, a, b, left, right)
                # equal vectors (letters of one group) meet from both sides: one of the two counts
                for i in np.flatnonzero(good & (searches[a] == trie.vectors[row]).all(axis=1)):
                    good[i] = visitor.words[a[i]] < resident.words[b[i]]
                out.append(np.array([begin + a[good], b[good]]))
    a, b = np.concatenate(out, axis=1)
    return pa.table({"a": asked.column("word").take(a), "na": asked.column("n").take(a), "b": kept.column("word").take(b), "nb": kept.column("n").take(b)})


# ------------------------------------------------------------------ the trie's upper levels, as tables

def _ordered(vocabulary: DataFrame) -> list[int]:
    """The letter groups, commonest first (ties by number): 32 totals come to the driver."""
    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(GROUPS, dtype=np.int64)
        for batch in batches:
            own += Letters(batch.column(0)).totals()
        yield pa.RecordBatch.from_arrays([pa.array(range(GROUPS), pa.int32()), pa.array(own)], ["g", "c"])

    found = vocabulary.select("word").mapInArrow(totals, "g int, c long").groupBy("g").agg(F.sum("c").alias("c")).collect()
    total = {r["g"]: r["c"] for r in found}
    return sorted(range(GROUPS), key=lambda g: (-total.get(g, 0), g))


def _nodes(prefixes: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(prefixes.shape[1]), len(prefixes), [None, pa.py_buffer(np.ascontiguousarray(prefixes).tobytes())]).cast(pa.binary())


def _placed(vocabulary: DataFrame, order: list[int], depth: int) -> DataFrame:
    """word, n, node: the trie's node at this depth that holds the word."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = _nodes(Letters(batch.column(0)).vectors(order)[:, :depth])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nodes], ["word", "n", "node"])

    return vocabulary.select("word", "n").mapInArrow(rows, "word string, n long, node binary")


def _stepped(searches: DataFrame, order: list[int], depth: int, to: int) -> DataFrame:
    """Searches (word, n, node, state) at ``depth``, taken on to all nodes at depth ``to`` that their budgets allow."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = Letters(batch.column(0)).vectors(order)
            size = len(vectors)
            node = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(size, depth)
            search, state = np.arange(size), batch.column(3).to_numpy().astype(np.int8)
            for level in range(depth, to):
                parts = []
                for before, more, after in SPENDING if level else LENGTHS:
                    at = np.flatnonzero(state == before)
                    count = vectors[search[at], level].astype(np.int64) + more
                    inside = (count >= 0) & (count < 256)
                    at, count = at[inside], count[inside].astype(np.uint8)
                    parts.append((search[at], np.column_stack([node[at], count]), np.full(len(at), after, dtype=np.int8)))
                search, node, state = (np.concatenate(x) for x in zip(*parts))
            took = pa.array(search)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(took), batch.column(1).take(took), _nodes(node), pa.array(state)],
                                             ["word", "n", "node", "state"])

    return searches.select("word", "n", "node", "state").mapInArrow(rows, "word string, n long, node binary, state byte")


def _meeting(order: list[int], depth: int):
    return lambda kept, asked: near_pairs(kept, asked, order, depth)


def pairs(vocabulary: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """a, na, b, nb: every two words of ``vocabulary`` (word, n; words distinct) one edit apart, once."""
    order = _ordered(vocabulary)
    own, searches = vocabulary, vocabulary.select("word", "n", F.lit(b"").alias("node"), F.lit(0).cast("byte").alias("state"))
    depth, found, done = 0, None, []
    while True:
        to = FIRST if not depth else min(depth + STEP, LEVELS - 1)
        placed = _placed(own, order, to)
        nodes = written(placed.groupBy("node").agg(F.count("*").alias("held")), "nodes")
        children = written(_stepped(searches, order, depth, to).join(nodes, "node"), "searches")
        closed = F.col("held") <= least if to < LEVELS - 1 else F.lit(True)
        # a node's words in blocks of `least`, its searches in blocks of `block`: every block meets every other
        grid = written(children.where(closed).groupBy("node").agg(F.count("*").alias("asked"), F.first("held").alias("held"))
                       .select("node", F.ceil(F.col("held") / least).alias("rows"), F.ceil(F.col("asked") / block).alias("columns")), "grid")
        kept = (placed.join(grid, "node").withColumn("row", F.pmod(F.xxhash64("word"), F.col("rows")))
                .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)))
                .select("node", "row", "column", "word", "n"))
        asked = (children.join(grid, "node").withColumn("column", F.pmod(F.xxhash64("word"), F.col("columns")))
                 .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
                 .select("node", "row", "column", "word", "n", "state"))
        met = (kept.groupBy("node", "row", "column").cogroup(asked.groupBy("node", "row", "column"))
               .applyInArrow(_meeting(order, to), "a string, na long, b string, nb long"))
        met = written(met, "pairs")
        found = met if found is None else found.unionByName(met)
        if to < LEVELS - 1 and not nodes.where(~closed).isEmpty():
            own = written(placed.join(nodes.where(~closed), "node").select("word", "n"), "words")
            searches = written(children.where(~closed).select("word", "n", "node", "state"), "searches")
            done += [own, searches]
        else:
            own = None
        for table in (nodes, children, grid):
            dropped(table)
        if own is None:
            break
        depth = to
    for table in done:
        dropped(table)
    return found


# ------------------------------------------------------------------ forms and roots

def _rooted(forms: DataFrame) -> DataFrame:
    """word, root for words with a form: the chains word -> form, followed to their ends by doubling. Every step has ten
    times the occurrences, so there are no circles, and chains are as short as the logarithm of the greatest n."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        dropped(now)
        now = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return now


def variants(vocabulary: DataFrame, ratio: int = RATIO, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """One row per word of ``vocabulary`` (word, n): form (its near word of largest n, if that is ``ratio`` times its own or
    more), root (the last form of forms, or the word itself), n, n_near (number of near words), form_n."""
    table = written(vocabulary.select("word", "n"), "vocabulary")
    met = pairs(table, least, block)
    both = met.select(F.col("a").alias("word"), F.col("na").alias("n"), F.struct((-F.col("nb")).alias("k"), F.col("b").alias("w")).alias("o")).unionByName(
        met.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.struct((-F.col("na")).alias("k"), F.col("a").alias("w")).alias("o")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min("o").alias("o"))
    far = -F.col("o")["k"]
    fits = far >= ratio * F.col("n")
    best = written(best.select("word", "n_near", F.when(fits, F.col("o")["w"]).alias("form"), F.when(fits, far).alias("form_n")), "best")
    dropped(met)
    roots = _rooted(best.where("form is not null"))
    return (table.join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
