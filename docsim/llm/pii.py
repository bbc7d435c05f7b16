"""Personal data in texts, disguised forms included, with places in the original text.

Plain identifiers are found on the text as it is. For disguised ones small transducers rewrite the text
- homoglyphs and full-width signs to ASCII, spelled digits to digits, at/dot disguises to signs, each in four
languages - and keep their edits; identifiers found in the rewritten text are mapped back through the edits
to source spans. Spans found on the text as it is stay.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import values

KINDS = ("email", "ip", "card", "phone")

# The identifiers' patterns. Runs are possessive where giving back cannot help.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run before the sign, as the sign is not in its class."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the plain identifiers, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


# Letters of other scripts that look like ASCII letters, and their ASCII forms.
HOMOGLYPHS = dict(
    zip(
        "авеѕіјкмнорстухѵԁɡһԛԝАВЕЅІЈКМНОРСТУХΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυ",
        "abesijkmhopctyxvdghqwABESIJKMHOPCTYXABEZHIKMNOPTYXaovpu",
        strict=True,
    )
)
HOMOGLYPHS |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # full-width forms
HOMOGLYPHS |= {"　": " ", " ": " ", "‐": "-", "‑": "-", "–": "-", "․": ".", "。": "."}
_GLYPH = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + "\U0001d400-\U0001d7ff]")
# letters and digits of the mathematical alphabets, by their compatibility form
HOMOGLYPHS |= {c: f for c in map(chr, range(0x1D400, 0x1D800)) if (f := unicodedata.normalize("NFKC", c)).isascii() and f.isalnum()}
ZERO_WIDTH = "​‌‍⁠﻿­"

# Spelled digits and the plus sign in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "plus": "+",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9", "más": "+",
}
# Words for the signs. "at" is an English word too, so alone it asks for a spelled dot.
AT_WORDS = ("at", "ät", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "point", "punto")
# Words that start a phrase, not a domain ("at the dot in"), and words that end no domain.
NO_DOMAIN = frozenset(
    "the a an this that these those each every any some one no my your our his her its their which what another".split()
)
NO_ENDING = frozenset("on of and or the was with for from as by if we he she they that this".split())

_GLYPHS = str.maketrans(HOMOGLYPHS)
_HIDDEN = re.compile(f"[{ZERO_WIDTH}]+")
_FIRST = sorted({word[0] for word in SPELLED})
_NUMBER = "|".join(f"{c}(?:{'|'.join(sorted((w[1:] for w in SPELLED if w[0] == c), key=len, reverse=True))})" for c in _FIRST)
_SPELLED_RUN = re.compile(rf"(?=[{''.join(_FIRST)}])\b(?:{_NUMBER})\b(?:[ ,.-]{{1,3}}(?:{_NUMBER}|[0-9]++)\b){{3,}}", re.I)
_SPELLED_ONE = re.compile(rf"\b(?:{_NUMBER})\b", re.I)
_BETWEEN = re.compile(r"[ ,.-]+")
_SIGN = re.compile(rf"@|(?<![A-Za-z0-9])(?:{'|'.join(AT_WORDS)})(?![A-Za-z0-9])", re.I)
_BRACKETED_DOT = rf"[\[({{<]\s{{0,3}}(?:{'|'.join(DOT_WORDS)}|\.)\s{{0,3}}[\])}}>]"


def _dot(words: str) -> str:
    return rf"\s{{0,3}}(?:{_BRACKETED_DOT}|(?<=\s)(?:{words})(?=\s))\s{{0,3}}"


#: By whether the sign before is plain English "at": the dots that may follow, and those that may end a stretch.
_DOT = {weak: re.compile(r"\.|" + _dot("dot" if weak else "|".join(DOT_WORDS)), re.I) for weak in (True, False)}
_DOT_BEFORE = {weak: re.compile(_dot("dot" if weak else "|".join(DOT_WORDS)) + r"\Z", re.I) for weak in (True, False)}
_LONGEST_DOT = 12 + 2 + max(map(len, DOT_WORDS))
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_TOP = re.compile(r"[A-Za-z]{2,}")
_WORD_CHARS = _LOCAL_CHARS - {"."}

Edit = tuple[int, int, str]


class Rewriting:
    """Edits of a text, to map places after them back to places before; it holds the edits, not the text."""

    def __init__(self, edits: list[Edit]):
        self.starts, self.ends, self.old_starts, self.old_ends = (array("q") for _ in range(4))
        shift = 0
        for a, b, new in edits:
            self.starts.append(a + shift)
            self.ends.append(a + shift + len(new))
            self.old_starts.append(a)
            self.old_ends.append(b)
            shift += len(new) - (b - a)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """What a stretch stands for; a character written by an edit stands for all that the edit replaced."""
        k = bisect_right(self.starts, start) - 1
        if k >= 0:
            start = self.old_starts[k] if start < self.ends[k] else start - self.ends[k] + self.old_ends[k]
        k = bisect_right(self.starts, end - 1) - 1
        if k >= 0:
            end = self.old_ends[k] if end - 1 < self.ends[k] else end - self.ends[k] + self.old_ends[k]
        return start, end


def _rewrite(text: str, edits: list[Edit]) -> str:
    """Replace the given stretches, in order and disjoint."""
    parts, at = [], 0
    for a, b, new in edits:
        parts += (text[at:a], new)
        at = b
    parts.append(text[at:])
    return "".join(parts)


def _hidden_edits(text: str) -> list[Edit]:
    return [] if text.isascii() else [(m.start(), m.end(), "") for m in _HIDDEN.finditer(text)]


def _spelled_edits(text: str) -> list[Edit]:
    edits = []
    for run in _SPELLED_RUN.finditer(text):
        last = None
        for one in _SPELLED_ONE.finditer(text, run.start(), run.end()):
            # blanks between two digits go, so that the run reads as one number
            if last is not None and _BETWEEN.fullmatch(text, last, one.start()):
                edits.append((last, one.end(), SPELLED[one[0].lower()]))
            else:
                edits.append((one.start(), one.end(), SPELLED[one[0].lower()]))
            last = one.end()
    return edits


def _back(text: str, at: int) -> int:
    """The place before at most three blanks that end at ``at``."""
    stop = max(0, at - 3)
    while at > stop and text[at - 1].isspace():
        at -= 1
    return at


def _on(text: str, at: int) -> int:
    stop = min(len(text), at + 3)
    while at < stop and text[at].isspace():
        at += 1
    return at


def _sign(text: str, m: re.Match) -> tuple[int, int, bool] | None:
    """Stretch of a sign with its brackets and blanks, and whether it is a bare English word."""
    start, end = m.span()
    left, right = _back(text, start), _on(text, end)
    if text[left - 1 : left] in tuple("[({<") and text[right : right + 1] in tuple("])}>"):
        return _back(text, left - 1), _on(text, right + 1), False
    if m[0] == "@":
        return start, end, False
    return (left, right, m[0].lower() == "at") if left < start and end < right else None


def _local(text: str, free: int, end: int, weak: bool) -> list[tuple[int, int]] | None:
    """Spelled dots of the words that end at ``end`` and are joined by dots, none if there is no word."""
    dots: list[tuple[int, int]] = []
    at, words = end, 0
    while True:
        start = at
        while start > free and text[start - 1] in _WORD_CHARS:
            start -= 1
        if start == at:
            break
        words += 1
        if start > free and text[start - 1] == ".":
            at = start - 1
            continue
        low = max(free, start - _LONGEST_DOT)
        spelled = _DOT_BEFORE[weak].search(text[low:start])
        # a dot needs a word before it
        if not spelled or low + spelled.start() <= free or text[low + spelled.start() - 1] not in _WORD_CHARS:
            break
        dots.append((low + spelled.start(), start))
        at = low + spelled.start()
    return dots[::-1] if words else None


def _domain(text: str, at: int, weak: bool) -> tuple[list[re.Match], list[re.Match]]:
    """Labels from ``at`` on that end with one of letters only, and the dots between them."""
    labels, dots = [], []
    label = _LABEL.match(text, at)
    while label:
        labels.append(label)
        dot = _DOT[weak].match(text, label.end())
        label = dot and _LABEL.match(text, dot.end())
        if label:
            dots.append(dot)
    while labels and not _TOP.fullmatch(labels[-1][0]):
        labels.pop()
        del dots[-1:]
    return labels, dots


def _spoken_edits(text: str) -> list[Edit]:
    """Signs for spelled ones, found from each sign outwards, so every stretch is looked at twice at most."""
    edits, free = [], 0
    for m in _SIGN.finditer(text):
        sign = _sign(text, m) if m.start() >= free else None
        if sign is None or sign[0] < free:
            continue
        start, end, weak = sign
        labels, dots = _domain(text, end, weak)
        spelled = [d.span() for d in dots if d[0] != "."]
        if not dots or (weak and not spelled):
            continue  # no domain, or prose: "it at example.com"
        if weak and (labels[0][0].lower() in NO_DOMAIN or labels[-1][0].lower() in NO_ENDING):
            continue
        before = _local(text, free, start, weak)
        if before is None or (end - start == 1 and not spelled and not before):
            continue  # no name, or a plain address
        edits += [(a, b, ".") for a, b in before]
        if end - start > 1:
            edits.append((start, end, "@"))
        edits += [(a, b, ".") for a, b in spelled]
        free = labels[-1].end()
    return edits


def find_disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifiers that appear only in the rewritten text, as source spans clear of the base ones, or addresses
    of which a base span is the end.

    A sign may have up to three blanks on each side, inside and outside its brackets; a spelled number has four
    digits at least, parted by up to three of blank, comma, point and hyphen. A bare "at" needs a spelled dot
    in the domain. Time and memory go with the text and its edits.
    """
    # each rule looks at its own stretch only: what else the text holds does not switch it on
    changed = not text.isascii() and _GLYPH.search(text) is not None
    now = text.translate(_GLYPHS) if changed else text  # one sign for one, so places stay
    steps = []
    for rule in (_hidden_edits, _spelled_edits, _spoken_edits):
        edits = rule(now)
        if edits:
            now = _rewrite(now, edits)
            steps.append(Rewriting(edits))
    if not changed and not steps:
        return []
    starts, ends = array("q"), array("q")  # the base spans, merged where they touch
    for start, _, end in base:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for start, kind, end in find(now):
        for step in reversed(steps):
            start, end = step.source(start, end)
        k = bisect_right(ends, start)  # the first base stretch that ends after the start
        clear = k == len(ends) or starts[k] >= end
        # a disguised letter splits a name, and its rest is a plain address: the whole one is added
        if clear or (kind == 0 and start < starts[k] and end == ends[k]):
            out.append((start, kind, end))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        counts: list[list[int]] = [[], [], [], []]
        digests, spans, added = [], [], []
        for text in values(batch.column(1)):
            base = find(text or "")
            more = find_disguised(text or "", base)
            for k in range(4):
                counts[k].append(sum(1 for s in base if s[1] == k))
            digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
            spans.append(spans_text(sorted(base + more)))
            added.append(len(more))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans), pa.array(added, pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised"],
        )


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the plain identifiers, digest of their spans, all spans, number of disguised ones.

    Spans are ``kind:start:end`` in characters of the source. A null text is empty; repeated rows repeat;
    other columns are ignored; an empty table gives no rows. Texts of any length take time and memory in
    proportion to their length.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _scan,
        f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_disguised bigint",
    )


def redact(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
            at = int(end)
    return "".join(out) + text[at:]
