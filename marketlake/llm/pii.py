"""Operator 5, personal data in texts, also in disguise, with offsets into the original text.

Base identifiers (email, ip, card, phone) are found in the text as it is. A transducer then rewrites disguises while it
keeps for every written character the stretch of source characters that it came from: homoglyphs and full-width forms
become ASCII, invisible characters go, "[at]", "(dot)" and "name at host dot org" become "@" and ".", runs of spelled
digits (in the four languages of ``DIGITS``) become digits. Identifiers found there that need a rewritten character
are mapped back to source offsets and added, unless a base span of their kind covers them; base spans always stay.

Definite results: a null text is empty, without spans; repeated rows give repeated rows; a null key is carried along;
offsets are code points, end exclusive. Texts are read whole, each in time linear in its length.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import slim

KINDS = ("email", "ip", "card", "phone")
ROWS = 256  # texts that a worker holds as Python strings at a time

#: Letters of other scripts that look like ASCII ones, and what they look like.
HOMOGLYPHS = dict(zip(
    "аеорсухіѕјһԁԛԝ" "АВЕКМНОРСТХІЅЈ" "αοιν" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ı" "‐‑‒–−" "․。｡" "﹫" "∙" "‚",
    "aeopcyxisjhdqw" "ABEKMHOPCTXISJ" "aoiv" "ABEZHIKMNOPTYX" "i" "-----" "..." "@" "." ",", strict=True))
#: Spaces other than the ASCII one, and characters that show nothing.
SPACES = "    　"
INVISIBLE = "­​‌‍⁠﻿"
#: The digits from 0 as words.
DIGITS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_digit = {word: str(value) for words in DIGITS.values() for value, word in enumerate(words.split())} | {"oh": "0"}


def _tree(words: Iterable[str]) -> str:
    """A pattern for the longest of some words: by first letter, so that a text's words are soon told apart from them."""
    heads = {}
    for word in words:
        heads.setdefault(word[:1], []).append(word[1:])
    parts = [re.escape(c) + _tree(rest) for c, rest in sorted(heads.items()) if c]
    if not parts:
        return ""
    return ("(?:" + "|".join(parts) + ")" + "?" * ("" in heads)) if len(parts) > 1 or "" in heads else parts[0]


_words = _tree(_digit)

_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is taken whole wherever it begins, so possessive repeats find the same matches without retries.
_ip = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[ -]?[0-9])++")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_odd = re.compile(f"[{''.join(HOMOGLYPHS)}{SPACES}{INVISIBLE}！-～٠-٩۰-۹०-९]")
_bracketed = re.compile(r"[ \t]*[\[({<][ \t]*(at|dot|punkt|point|punto|@|\.)[ \t]*[\])}>][ \t]*", re.IGNORECASE)
_bare = re.compile(r"(?<=[A-Za-z0-9])[ \t]+(?:at|@)[ \t]+(?=[A-Za-z0-9-]++(?:[ \t]*\.[ \t]*[A-Za-z0-9-]++)*+[ \t]+dot[ \t]+[A-Za-z0-9])", re.IGNORECASE)
_host = re.compile(r"@[A-Za-z0-9-]++(?:(?:\.|[ \t]+dot[ \t]+)[A-Za-z0-9-]++)++", re.IGNORECASE)
_dot = re.compile(r"[ \t]+dot[ \t]+", re.IGNORECASE)
_unit = rf"(?:(?<![^\W\d_])(?:{_words})(?![^\W\d_])|[0-9]++)"
_spelled = re.compile(rf"(?<!\w)(?:plus[ \t]+)?{_unit}(?:[ \t]*[-,.][ \t]*{_unit}|[ \t]+(?:(?:dot|punkt|point|punto)[ \t]+)?{_unit}){{3,}}", re.IGNORECASE)
_piece = re.compile(rf"plus[ \t]+|(?P<word>{_words})|(?P<digits>[0-9]++)|(?P<dot>[ \t]*(?:\.|dot|punkt|point|punto)[ \t]*)|(?P<gap>[ \t,-]+)", re.IGNORECASE)
_digit_word = re.compile(_words, re.IGNORECASE)
_dot_hint = re.compile(r"[ \t]dot[ \t]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every "@" with the characters that may stand before it and a domain after it, from the left, not overlapping."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _local:
            start -= 1
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # what follows begins after this "@", which no part of an address contains
        at = text.find("@", done)


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """Base identifiers by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in _ip.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.group().split("."))]
    for m in _card.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _phone.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


class Tape:
    """A text under rewriting: its characters, and for each the source stretch and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put each edit's string in place of [start, end): edits from the left, not overlapping."""
        if not edits:
            return
        text, start, end, changed, done = [], [], [], bytearray(), 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[done:a])
            start += self.start[done:a]
            end += self.end[done:a]
            changed += self.changed[done:a]
            if new:
                text.append(new)
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
                changed += b"\1" * len(new)
            done = b
        self.text, self.start, self.end, self.changed = "".join(text), start, end, changed


def plain(char: str) -> str:
    """What an odd character stands for."""
    if char in INVISIBLE:
        return ""
    if char in SPACES:
        return " "
    if "！" <= char <= "～":
        return chr(ord(char) - 0xFEE0)
    return HOMOGLYPHS.get(char) or str(unicodedata.decimal(char))


def _folded(word: str) -> str:
    """A word as in ``_digit``, also if written with the two letters that match s and i but have another lower case."""
    return word.lower().replace("ſ", "s").replace("i\u0307", "i")


def disguised(text: str) -> bool:
    """Whether the transducers may rewrite something: no text without this sign is changed by them."""
    return bool(_odd.search(text) or _dot_hint.search(text) or any(c in text for c in "[({<") and _bracketed.search(text)
                or any(_digit_word.search(run.group()) for run in _spelled.finditer(text)))


def normalised(text: str) -> Tape:
    """The transducers, one after another, each on what the one before wrote."""
    tape = Tape(text)
    tape.rewrite([(m.start(), m.end(), plain(m.group())) for m in _odd.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), "@" if m.group(1).lower() in ("at", "@") else ".") for m in _bracketed.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), "@") for m in _bare.finditer(tape.text)])
    tape.rewrite([(m.start() + d.start(), m.start() + d.end(), ".") for m in _host.finditer(tape.text) for d in _dot.finditer(m.group())])
    edits = []
    for run in _spelled.finditer(tape.text):
        pieces = [(m.start(), m.end(), m) for m in _piece.finditer(tape.text, *run.span())]
        if not any(m["word"] for _, _, m in pieces):
            continue
        for a, b, m in pieces:
            new = _digit[_folded(m["word"])] if m["word"] else m["digits"] or ("." if m["dot"] else "" if m["gap"] else "+")
            if new != tape.text[a:b]:
                edits.append((a, b, new))
    tape.rewrite(edits)
    return tape


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those added from disguises."""
    base, added = identifiers(text), []
    if disguised(text):
        tape = normalised(text)
        for kind, a, b in identifiers(tape.text) if any(tape.changed) or len(tape.text) < len(text) else ():
            gaps = tape.end[b - 1] - tape.start[a] != b - a  # something inside was taken out
            x, y = tape.start[a], tape.end[b - 1]
            if (gaps or any(tape.changed[a:b])) and not any(k == kind and s <= x and y <= e for k, s, e in base):
                added.append((kind, x, y))
    return base, added


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_<kind> (base spans), base_sha256, spans (all, as text), n_added, and found: the
    spans as (kind, start, end, base)."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS)):
            out = []
            for value in batch.column("text").to_pylist():
                base, added = spans(value or "")
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added),
                            [dict(kind=k, start=a, end=b, base=own) for part, own in ((base, True), (added, False)) for k, a, b in part]))
            columns = [pa.array(x, type=t) for x, t in zip(zip(*out), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.list_(span)]
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added", "found"]
    return slim(docs, text, key).mapInArrow(rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                                                  "spans string, n_added long, found array<struct<kind: string, start: long, end: long, base: boolean>>")


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text: every span, base or added, replaced by its kind in angle brackets."""
    @F.udf("string", useArrow=True)
    def mask(value: str) -> str:
        if value is None:
            return None
        base, added = spans(value)
        out, done = [], 0
        for kind, a, b in sorted(base + added, key=lambda x: (x[1], -x[2])):
            if a >= done:
                out += [value[done:a], f"<{kind}>"]
                done = b
        return "".join(out) + value[done:]

    return slim(docs, text, key).withColumn("text", mask("text"))
