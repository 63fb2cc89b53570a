"""Plain, quadratic versions of the operators, for small fixtures."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

SPACE = re.compile("[\x20\x09-\x0d]+")


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text: str) -> list[str]:
    return [w for w in SPACE.split(low(text)) if w]


def shingle_list(tokens: list[str], n: int = 5) -> list[tuple]:
    return [tuple(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))] if tokens else []


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def near_components(docs: list[tuple], percent: int) -> dict:
    """doc_id -> (set size, least doc_id reachable)."""
    sets = {d: frozenset(shingle_list(words(t))) for d, t in docs if d is not None}
    groups, ids = Groups(), sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {d: (len(sets[d]), groups.find(d)) for d in ids}


def text_lines(text: str):
    """Lines with their offsets, the newline included."""
    at = 0
    for line in (text or "").split("\n"):
        end = min(at + len(line) + 1, len(text or ""))
        yield at, end, words(line)
        at += len(line) + 1


def repeated_units(docs: list[tuple], letters: int, boundary: tuple) -> set:
    """(doc_id, start, end, words, first_doc_id, first_start) of every later occurrence in a run of enough letters."""
    a, b, c, every = boundary
    first, out = {}, set()
    for d, t in sorted(x for x in docs if x[0] is not None and x[1]):
        units, at = [], 0
        for line in t.split("\n"):
            line_end = min(at + len(line) + 1, len(t))
            found, own = [(at + m.start(), low(m.group())) for m in re.finditer(r"[^\x20\x09-\x0D]+", line)], []
            for k, (start, word) in enumerate(found):
                raw = word.encode()
                own.append((start, word))
                if k + 1 == len(found) or (a * raw[0] + b * raw[-1] + c * len(raw)) % every == 0:
                    units.append([at if own[0] == found[0] else own[0][0], found[k + 1][0] if k + 1 < len(found) else line_end, tuple(w for _, w in own)])
                    own = []
            at += len(line) + 1
        run = []
        for start, end, tokens in [*units, (0, 0, None)]:
            kept = first.setdefault(tokens, (d, start)) if tokens else (d, start)
            if kept != (d, start):
                run.append((d, start, end, len(tokens), *kept))
            else:
                size = sum(len(re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", "", low(t[x[1] : x[2]]))) for x in run)
                out |= set(run) if size >= letters else set()
                run = []
    return out


def similar_lines(docs: list[tuple], percent: int = 80, least: int = 5) -> set:
    """(doc_id, start, end, kept_doc_id, kept_start) of every line to remove."""
    where = defaultdict(list)
    for d, t in sorted({x for x in docs if x[0] is not None and x[1]}):
        for start, end, tokens in text_lines(t):
            if len(tokens) >= least:
                where[" ".join(tokens)].append((d, start, end))
    lines = list(where)
    sets = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in lines]
    groups = Groups()
    for i in range(len(lines)):
        groups.find(i)
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                groups.join(i, j)
    members = defaultdict(list)
    for i, x in enumerate(lines):
        members[groups.find(i)] += where[x]
    return {(*x, *min(m)[:2]) for m in members.values() for x in sorted(m)[1:]}


def contaminated(docs: list[tuple], items: list[tuple], least: float = 0.8) -> dict:
    """(doc_id, item_id) -> similarity of the best window."""
    out = {}
    for d, t in docs:
        tokens = words(t)
        for i, text in items:
            own = words(text)
            if d is None or i is None or not own or not tokens:
                continue
            if len(own) < 5:
                best = float(tokens == own)
            else:
                want, best = Counter(shingle_list(own)), 0.0
                parts = shingle_list(tokens)
                k = len(own) - 4
                for p in range(len(tokens) - len(own) + 1):
                    both = sum((Counter(parts[p : p + k]) & want).values())
                    best = max(best, both / (2 * k - both))
            if best >= least:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


def jump(key: int, shards: int) -> int:
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def best_fit_decreasing(sizes: list[int], capacity: int) -> Counter:
    """Piece by piece: how full each bin gets (a multiset of the remaining capacities)."""
    free = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, room in enumerate(free) if room >= size]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= size
        else:
            free.append(capacity - size)
    return Counter(free)


def fold(key, folds: int) -> int:
    return zlib.crc32(str(key).encode()) % folds
