r"""Offset-preserving deobfuscation of personal data.

Base detectors run on the text itself. Then a chain of transducers rewrites disguises, each keeping for every output
character the source span it came from:

1. characters: homoglyphs, full-width and mathematical forms, digits of other scripts to ASCII; zero-width ones vanish;
2. references and marks: ``&#64;``, ``[at]``, ``(dot)``, ``{punkt}``, ``_at_``, an @ with white space beside it, and
   bare ``at`` / ``dot`` between words where at least one ``dot`` is spelled too, so that "look at example.com" stays;
3. spelled digits: runs of at least three of zero to nine, ``oh``, ``double x``, ``triple x``, ``plus``, ``dot``/``point``.

The detectors run on what comes out, and their spans are mapped back. A mapped span is added if it holds something
that was rewritten. Where base spans of its kind cover a part of it only, the parts beside them are added: base spans
stay, no two spans of a kind overlap, and together they mark the whole identifier. A spelled run of 9 to 15 digits that
is no card is a phone.

Offsets are code points, end exclusive. Texts without any trigger pay only for the base detectors.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from . import scan

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[int, int, int]  # start, kind, end


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _octet(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @ outwards.

    A match can only begin in the run of local characters that ends at the @, and the domain does not depend on where; so
    this equals the regex, but stays linear on long runs without an @.
    """
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((start, 0, done))
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def detect(text: str) -> list[Span]:
    """The base spans: leftmost, non-overlapping per kind; matches that fail their test are dropped, without retries."""
    out: list[Span] = []
    if "@" in text:
        out += emails(text)
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def _lookalikes() -> dict[str, str]:
    pairs = {
        "а": "a", "А": "A", "В": "B", "е": "e", "Е": "E", "ё": "e", "і": "i", "І": "I", "ї": "i", "ј": "j", "Ј": "J", "К": "K", "к": "k", "М": "M", "м": "m",
        "Н": "H", "о": "o", "О": "O", "р": "p", "Р": "P", "с": "c", "С": "C", "ѕ": "s", "Ѕ": "S", "Т": "T", "т": "t", "у": "y", "У": "Y", "х": "x", "Х": "X",
        "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "Һ": "H", "п": "n", "г": "r", "ь": "b", "З": "3", "з": "3",
        "α": "a", "Α": "A", "Β": "B", "ε": "e", "Ε": "E", "Ζ": "Z", "Η": "H", "ι": "i", "Ι": "I", "κ": "k", "Κ": "K", "Μ": "M", "Ν": "N", "ν": "v", "ο": "o", "Ο": "O",
        "ρ": "p", "Ρ": "P", "τ": "t", "Τ": "T", "υ": "u", "Υ": "Y", "χ": "x", "Χ": "X", "γ": "y", "ϲ": "c", "ϳ": "j", "ω": "w", "η": "n",
        "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ք": "p",
        "․": ".", "。": ".", "｡": ".", "·": ".", "•": ".", "‧": ".", "∙": ".", "⋅": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-", "⁃": "-",
        "﹫": "@", "＠": "@", "ⓐ": "a", "✚": "+", "➕": "+", "﹢": "+", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
    }
    return pairs


_LOOKALIKE = _lookalikes()
_GONE = frozenset("­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤︎️﻿")


def _ascii(c: str) -> str:
    """What a character stands for: at most one ASCII character, or nothing for a zero-width one; itself otherwise."""
    if c in _GONE:
        return ""
    if (x := _LOOKALIKE.get(c)) is not None:
        return x
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    x = unicodedata.normalize("NFKC", c)
    return x if len(x) == 1 and x.isascii() else c


_FORMS: dict[str, str] = {}


class Tape:
    """A text with the source span of each character and whether it was rewritten."""

    __slots__ = ("text", "start", "end", "changed")

    def __init__(self, text: str) -> None:
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.changed = bytearray(len(text))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces [a, b) by a text, for ascending, disjoint edits; each new character stands for the whole of [a, b)."""
        if not edits:
            return
        text, start, end, changed = [], [], [], bytearray()
        at = 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            changed += self.changed[at:a]
            if new:
                text.append(new)
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
                changed += b"\1" * len(new)
            at = b
        self.text, self.start, self.end, self.changed = "".join(text), start, end, changed


def characters(tape: Tape) -> None:
    if tape.text.isascii():
        return
    edits = []
    for m in re.finditer(r"[^\x00-\x7f]", tape.text):
        c = m[0]
        if (x := _FORMS.get(c)) is None:
            x = _FORMS[c] = _ascii(c)
        if x != c:
            edits.append((m.start(), m.end(), x))
    tape.replace(edits)


_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_MARK = re.compile(
    rf"(?P<at>{_OPEN}\s*+(?:at|@|arroba|arobase)\s*+{_SHUT}|&(?:\#0*+64|\#x0*+40|commat);|(?<=[A-Za-z0-9])[_*]at[_*](?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]|[_*]dot[_*])))"
    rf"|(?P<dot>{_OPEN}\s*+(?:dot|\.|punkt|punto|point|d0t)\s*+{_SHUT}|&(?:\#0*+46|\#x0*+2e|period);|(?<=[A-Za-z0-9])[_*]dot[_*](?=[A-Za-z0-9]))",
    re.I,
)
_AT = re.compile(r"(?<=\s)at(?=\s)|@", re.I)
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789%+_-")
_HOST = re.compile(r"[A-Za-z0-9-]++")
_NEXT = re.compile(r"(?:\.|(?P<dot>\s++dot\s++))[A-Za-z0-9-]++", re.I)


def _back(text: str, at: int, least: int) -> int:
    """Where the white space that ends at ``at`` begins, at ``least`` or later."""
    while at > least and text[at - 1].isspace():
        at -= 1
    return at


def _ahead(text: str, at: int) -> int:
    while at < len(text) and text[at].isspace():
        at += 1
    return at


def _local(text: str, end: int, least: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Start of the labels that end at ``end``, joined by dots or spelled dots, and the spelled ones among these."""
    dots: list[tuple[int, int, str]] = []
    start, sep = end, None  # sep: a spelled dot that counts if a label comes before it
    at = end
    while True:
        label = at
        while at > least and text[at - 1] in _LABEL:
            at -= 1
        if at == label:
            return start, dots
        if sep:
            dots.append(sep)
        start, sep = at, None
        if at > least and text[at - 1] == ".":
            at -= 1
            continue
        word = _back(text, at, least)
        if word == at or word - 3 <= least or text[word - 3 : word].lower() != "dot":
            return start, dots
        before = _back(text, word - 3, least)
        if before == word - 3:
            return start, dots
        sep, at = (before, at, "."), before


def _addresses(text: str) -> list[tuple[int, int, str]]:
    """Edits for addresses with a spelled dot, or with white space beside their @: each @ or bare ``at`` is followed outwards.

    What one address has taken is not looked at again, and labels and spelled dots alternate, so that the walk to either
    side of a mark passes at most one other mark: linear, for any number of labels and of white spaces.
    """
    edits: list[tuple[int, int, str]] = []
    done = 0
    bare = re.search(r"\sdot\s", text, re.I) is not None
    for m in _AT.finditer(text):
        if m.start() < done or not (bare or m[0] == "@"):
            continue
        a, b = _back(text, m.start(), done), _ahead(text, m.end())
        if a == done or text[a - 1] not in _LABEL or not (host := _HOST.match(text, b)):
            continue
        end, right = host.end(), []
        while n := _NEXT.match(text, end):
            if n["dot"]:
                right.append((*n.span("dot"), "."))
            end = n.end()
        if end == host.end():
            continue
        left = _local(text, a, done)[1]
        if left or right or m[0] == "@" and b - a > 1:
            edits += [*reversed(left), *([(a, b, "@")] if b - a > 1 else []), *right]
        done = end
    return edits


def marks(tape: Tape) -> None:
    if re.search(r"[\[({<&_*]", tape.text):
        edits, done = [], 0
        for m in _MARK.finditer(tape.text):
            a, b = m.span()
            if m[0][0] not in "_*":
                a, b = _back(tape.text, a, done), _ahead(tape.text, b)
            edits.append((a, b, "@" if m["at"] else "."))
            done = b
        tape.replace(edits)
    if re.search(r"\sdot\s|\s@|@\s", tape.text, re.I):
        tape.replace(_addresses(tape.text))


_VALUE = {w: str(k) for k, ws in enumerate(("zero oh", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")) for w in ws.split()}
_DIGIT = r"(?:(?:double|triple)[\s-]+)?(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_RUN = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\s,-]+)?(?:{_DIGIT}|[0-9]+)(?:[\s,-]+(?:{_DIGIT}|[0-9]+|dot|point)|(?:\.)(?=[0-9]))*(?![A-Za-z0-9])", re.I)
_WORD = re.compile(r"[A-Za-z]+|[0-9]+|\.")
_SPELLED = re.compile(r"\b(?:zero|one|two|three|four|five|six|seven|eight|nine)\b", re.I)


def spelled(tape: Tape) -> list[tuple[int, int]]:
    """Rewrites spelled digits; returns the runs, in the new text, that were wholly spelled."""
    if not _SPELLED.search(tape.text):
        return []
    edits, whole = [], []
    shift = 0
    for m in _RUN.finditer(tape.text):
        words = [w.lower() for w in _WORD.findall(m[0])]
        if sum(w in _VALUE for w in words) < 3:
            continue
        out, times = "", 1
        for w in words:
            if w in ("double", "triple"):
                times = 2 if w == "double" else 3
                continue
            out += {"plus": "+", "dot": ".", "point": ".", ".": "."}.get(w) or _VALUE.get(w, w) * times
            times = 1
        out = out.rstrip(".")
        if not any(w.isdigit() for w in words) and "." not in out:
            whole.append((m.start() + shift, m.start() + shift + len(out)))
        edits.append((m.start(), m.end(), out))
        shift += len(out) - (m.end() - m.start())
    tape.replace(edits)
    return whole


_PLAIN = "\u00c0-\u024f¡¿«»§°£€ªº“”‘’„…"  # letters and marks of ordinary text that stand for nothing else
_TRIGGER = re.compile(
    rf"[^\x00-\x7f{_PLAIN}]|"
    r"[\[({<]\s*(?:at|@|dot|\.|arroba|arobase|punkt|punto|point|d0t)\s*[\])}>]|&(?:#|commat|period)|[_*](?:at|dot)[_*]|\sdot\s|\s@|@\s|\b(?:zero|one|two|three|four|five|six|seven|eight|nine)[\s,-]+(?:double|triple|zero|oh|one|two|three|four|five|six|seven|eight|nine|[0-9])",
    re.I,
)


def _beside(text: str, start: int, end: int, base: list[Span]) -> list[tuple[int, int]]:
    """The parts of a source span that no base span covers, without white space at their ends. base: of one kind."""
    out = []
    for k in range(bisect_right(base, start, key=lambda s: s[2]), len(base) + 1):
        a, b = (base[k][0], base[k][2]) if k < len(base) and base[k][0] < end else (end, end)
        part = text[start:a]
        if part.strip():
            out.append((start + len(part) - len(part.lstrip()), start + len(part.rstrip())))
        start = b
        if start >= end:
            break
    return out


def added(text: str, base: list[Span]) -> list[Span]:
    """The spans that only show once disguises are rewritten."""
    if not _TRIGGER.search(text):
        return []
    tape = Tape(text)
    characters(tape)
    marks(tape)
    whole = spelled(tape)
    if not any(tape.changed) and len(tape.text) == len(text):
        return []
    spans = detect(tape.text)
    for a, b in whole:
        n = len(_digits(tape.text[a:b]))
        if 9 <= n <= 15 and not any(s < b and a < e for s, _, e in spans):
            spans.append((a, 3, b))
    out = []
    of_kind = [[s for s in base if s[1] == k] for k in range(len(KINDS))]
    for a, kind, b in spans:
        start, end = tape.start[a], tape.end[b - 1]
        if any(tape.changed[a:b]) or end - start != b - a:
            out += [(s, kind, e) for s, e in _beside(text, start, end, of_kind[kind])]
    return sorted(set(out))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and digest, and all spans, base ones and added ones.

    n_email to n_phone count the base spans, n_added the others, n_spans all. Null text is empty, and empty text has none.
    Repeated rows give repeated results; of matches that begin alike the longest counts, as its regex says. A null doc_id
    stays null; extra columns are dropped. A narrow map: no shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: list[list[int]] = [[], [], [], []]
        digests, spans, extra, total = [], [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = detect(text)
            more = added(text, base)
            for k in range(4):
                counts[k].append(sum(s[1] == k for s in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(sorted([*base, *more])))
            extra.append(len(more))
            total.append(len(base) + len(more))
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extra, pa.int64()), pa.array(total, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return scan.map_arrow(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), run, SCHEMA)
