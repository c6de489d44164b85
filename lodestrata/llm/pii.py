"""Operator 3: personal data, with offset-preserving deobfuscation.

The plain text is searched first (the base spans). Then transducers rewrite the
text: look-alike characters to ASCII, spelled digits to digits, at/dot disguises
to ``@`` and ``.``. Each keeps, for every character of its output, the source
range it came from; the same detectors run on the output, and what they find in a
rewritten place is mapped back to source characters. All offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import text_chunks

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, index in KINDS, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A leftmost match can only begin where a run of digits begins, so the lookbehind and the
# possessive repeats change no result; they keep long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _octet(digits: str) -> bool:
    value = digits.lstrip("0")  # the rest may be too long for int()
    return len(value) < 3 or (len(value) == 3 and value <= "255")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, 0, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def detect(text: str) -> list[Span]:
    """The base spans of a text by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


# --- fixed values: look-alikes of ASCII characters, and words for digits
_LOOKALIKES = {
    "a": "аɑα", "c": "сϲ", "e": "еє", "i": "іι", "j": "ј", "o": "оοσ", "p": "рρ", "s": "ѕ", "x": "хχ", "y": "уγ", "v": "ν", "h": "һ", "d": "ԁ", "l": "ӏ", "n": "ո", "u": "υ", "k": "кκ", "m": "м", "t": "т", "b": "ь",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    ".": "․。｡", "-": "‐‑‒–—−", "@": "﹫", "+": "﹢",
}
_DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
# --- end of fixed values
_INVISIBLE = "​‌‍⁠﻿­"
_FOLD = {c: a for a, cs in _LOOKALIKES.items() for c in cs} | dict.fromkeys(_INVISIBLE, "")
for _cp in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x2474), *range(0x2070, 0x208A)]:
    _n = unicodedata.normalize("NFKC", chr(_cp))
    if len(_n) == 1 and _n.isascii():
        _FOLD[chr(_cp)] = _n
for _cp in range(0x0660, 0x1000):  # decimal digits of other scripts
    if (_d := unicodedata.decimal(chr(_cp), None)) is not None:
        _FOLD[chr(_cp)] = str(_d)
_ODD = re.compile("[" + "".join(map(re.escape, sorted(_FOLD))) + "]")

_WORDS = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<!\w)(?:(?:plus|{_WORDS}|[0-9]+)[ ,.-]{{1,2}}){{6,}}(?:{_WORDS}|[0-9]+)(?!\w)", re.I)
_SPELLED_WORD = re.compile(rf"(?<!\w)({_WORDS})(?!\w)", re.I)
#: A longest run of number words and digits. _SPELLED can only match at a run's start: later starts
#: have the same end and fewer words. Possessive, so that runs without a match stay linear.
_RUN = re.compile(rf"(?<!\w)(?:(?:plus|{_WORDS}|[0-9]+)[ ,.-]{{1,2}}){{6,}}+", re.I)
#: Blanks before a bracket are taken back from its left end: a pattern that began with them would be quadratic.
_AT_BRACKET = re.compile(r"(?:[\[({<]\s*+(?:at|@|arobase|arroba)\s*+[\])}>]|&#0*+64;|&#x0*+40;|%40)\s*+", re.I)
_DOT_BRACKET = re.compile(r"(?:[\[({<]\s*+(?:dot|\.|point|punkt|punto)\s*+[\])}>]|&#0*+46;|&#x0*+2e;)\s*+", re.I)
#: The bare words stand for signs only where both occur, as in "jo at site dot org".
_AT_DOT_WORDS = re.compile(r"(?<=[A-Za-z0-9_%+-])\s++at\s++(?!(?:the|a|an|this|that|each|every|one|my|your|our|its|his|her|their)\s)[A-Za-z0-9-]++(?:\s++dot\s++[A-Za-z0-9-]+)+(?!\w)", re.I)
_AT_WORD, _DOT_WORD = re.compile(r"(?<!\s)\s++at\s++", re.I), re.compile(r"(?<!\s)\s++dot\s++", re.I)
_DOMAIN_WORDS = re.compile(r"@[A-Za-z0-9-]++(?:\s++dot\s++[A-Za-z0-9-]++)+", re.I)
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_SPACED = re.compile(r"(?<=[A-Za-z0-9]) ?@ ?(?=[A-Za-z0-9])")


class Mapped:
    """A text and, for each of its characters, the source range it stands for."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None, changed: np.ndarray | None = None):
        n = len(text)
        self.text, self.start, self.end = text, np.arange(n) if start is None else start, np.arange(1, n + 1) if end is None else end
        self.changed = np.zeros(n, bool) if changed is None else changed

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace ascending, disjoint ranges; every new character stands for the whole range."""
        if not edits:
            return self
        if len(self.start) < len(self.text):
            self.__init__(self.text)
        text, start, end, changed, at = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a] if a < b else 0)]
            end += [self.end[at:a], np.full(len(new), self.end[b - 1] if a < b else 0)]
            changed += [self.changed[at:a], np.ones(len(new), bool)]
            at = b
        return Mapped("".join(text), np.concatenate(start), np.concatenate(end), np.concatenate(changed))


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for run in _RUN.finditer(text):
        m = _SPELLED.match(text, run.start())
        if m is None:
            continue
        at, first, plus = m.start(), True, False
        for w in re.finditer(r"[^ ,.-]+", m[0]):
            a, b = m.start() + w.start(), m.start() + w.end()
            word = w[0].lower()
            if word in _DIGIT_WORDS or word == "plus":
                # The gap before a digit word goes with it: "five five" becomes "55".
                edits.append((a if first else max(at, edits[-1][1] if edits else 0), b, "+" if word == "plus" else str(_DIGIT_WORDS[word])))
            elif plus:  # "plus 1" becomes "+1"
                edits.append((at, a, ""))
            at, first, plus = b, False, word == "plus"
    return edits


def _signs(text: str, pattern: re.Pattern, sign: str) -> list[tuple[int, int, str]]:
    """Edits that put ``sign`` for each match and the blanks before it."""
    edits, floor = [], 0
    for m in pattern.finditer(text):
        a = m.start()
        while a > floor and text[a - 1].isspace():
            a -= 1
        edits.append((a, m.end(), sign))
        floor = m.end()
    return edits


def _name_start(text: str, end: int, floor: int) -> int:
    """Where the dotted name that ends at ``end`` begins ("jo dot smith"), or ``end`` if it is none."""
    start = at = end
    while True:
        a = at
        while a > floor and text[a - 1] in _NAME:
            a -= 1
        if a == at:
            return start
        before = text[a - 1] if a else ""
        if not before or not (before.isalnum() or before in "_.%+-"):
            start = a
        if before == "." and a - 1 > floor:
            at = a - 1
            continue
        b = a
        while b > floor and text[b - 1].isspace():
            b -= 1
        c = b - 3
        if b == a or c <= floor or text[c:b].lower() != "dot" or not text[c - 1].isspace():
            return start
        while c > floor and text[c - 1].isspace():
            c -= 1
        at = c


def _word_signs(text: str) -> list[tuple[int, int, str]]:
    """Edits for "jo dot smith at site dot org"; linear, as a name is walked only where the rest matches."""
    edits, floor = [], 0
    for m in _AT_DOT_WORDS.finditer(text):
        a = _name_start(text, m.start(), floor)
        if a < m.start():
            at = _AT_WORD.match(text, m.start())
            left = [(w.start(), w.end(), ".") for w in _DOT_WORD.finditer(text, a, m.start())]
            edits += [*left, (m.start(), at.end(), "@"), *((w.start(), w.end(), ".") for w in _DOT_WORD.finditer(text, at.end(), m.end()))]
            floor = m.end()
    return edits


def _may_have_lookalikes(text: str) -> bool:
    try:  # far faster than a search, and true of most European text
        text.encode("latin-1")
        return "\xad" in text
    except UnicodeEncodeError:
        return not _FOLD.keys().isdisjoint(text)


def deobfuscate(text: str) -> Mapped | None:
    """The text after all transducers, or None where none applies."""
    m = Mapped(text[:0])
    m.text = text  # the maps are made only when something is rewritten
    if _may_have_lookalikes(text):
        m = m.rewrite([(x.start(), x.end(), _FOLD[x[0]]) for x in _ODD.finditer(text)])
    low = m.text.lower()
    m = m.rewrite(_spelled_edits(m.text))
    if "&#" in low or "%40" in low or "[" in low or "(" in low or "{" in low or "<" in low:
        m = m.rewrite(_signs(m.text, _AT_BRACKET, "@"))
        m = m.rewrite(_signs(m.text, _DOT_BRACKET, "."))
    if "dot" in low:
        m = m.rewrite(_word_signs(m.text))
        if "@" in m.text:  # "jo[at]site dot org"
            m = m.rewrite([(w.start(), w.end(), ".") for x in _DOMAIN_WORDS.finditer(m.text) for w in _DOT_WORD.finditer(m.text, x.start(), x.end())])
    if " @" in m.text or "@ " in m.text:
        m = m.rewrite([(x.start(), x.end(), "@") for x in _SPACED.finditer(m.text) if x.end() - x.start() > 1])
    return m if m.text != text else None


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, spans the method adds), each by start, then kind."""
    base = detect(text)
    m = deobfuscate(text)
    if m is None:
        return base, []
    known, added = set(base), set()
    for start, kind, end in detect(m.text):
        a, b = int(m.start[start]), int(m.end[end - 1])
        # Only what a rewritten or dropped character brought about is new.
        if (m.changed[start:end].any() or b - a != end - start) and (a, kind, b) not in known:
            added.add((a, kind, b))
    return base, sorted(added)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str) -> str:
    """The text with every span, overlapping ones together, replaced by ``[KIND]``."""
    base, added = find(text)
    out, at = [], 0
    spans = sorted(base + added)
    i = 0
    while i < len(spans):
        a, k, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at, i = b, i + 1
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added.

    ``spans`` holds base and added spans. A null text counts as empty: counts 0,
    the digest of "", no spans. Repeated rows stay repeated and a null id stays
    null; an empty table gives no rows; texts are searched whole, in time linear in
    their length; other columns, whatever their names, are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw in text_chunks(batch.column(1)):
                found = [find(t.decode()) for t in raw]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i),
                    *(pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)),
                    pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([_joined(sorted(base + added)) for base, added in found], pa.string()),
                    pa.array([len(added) for _, added in found], pa.int64()),
                ], names=names)

    return docs.select(id_col, text_col).mapInArrow(search, f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked; ``length_col``, where present, is the new length.

    Null and empty texts stay as they are, and so do all other columns, whatever
    their names, and repeated rows; an empty table gives no rows.
    """
    at = docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _ in text_chunks(batch.column(at)):
                part = batch.slice(i, j - i)
                columns = list(part.columns)
                columns[at] = pa.array([None if t is None else redact(t) for t in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    out = docs.mapInArrow(mask, docs.schema)
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(docs.columns)
