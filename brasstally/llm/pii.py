"""Personal data in plain and in disguise, with the places in the source text.

Plain identifiers are found as they stand. For disguised ones, small transducers
rewrite the text (look-alike letters, spelled digits, ``at`` and ``dot``) and keep for
every character they write the stretch of source that it came from. The same rules
then search the rewritten text, and what they find is mapped back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table
from brasstally.llm.spans import Span, digest, joined

# The kinds and patterns of the base rules.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")  # no run of digits is entered in its middle
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Letters that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "ԛ": "q", "ԝ": "w", "ь": "b", "к": "k", "м": "m", "т": "t", "г": "r", "п": "n", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ј": "J", "Ѕ": "S", "З": "3",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "γ": "y", "τ": "t", "ε": "e", "η": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅼ": "l", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
    "․": ".", "。": ".", "﹒": ".", "＠": "@", "﹫": "@", "\xa0": " ", " ": " ", " ": " ",
}
INVISIBLE = "­​‌‍⁠﻿"
# Digits by name.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
# Last labels after which a spelled address without brackets counts.
LAST_LABELS = (
    "com org net edu gov mil int info biz name io co me tv ai app dev de fr es it nl be ch at uk us eu ca au nz ie in jp cn ru br mx "
    "se no fi dk pl pt cz gr example test invalid localhost"
).split()

#: Names that are common words too: alone they make no text worth a closer look.
COMMON = {"un", "uno", "dos", "oh", "null", "one", "acht", "sept"}
DIGIT = "|".join(sorted(DIGITS, key=len, reverse=True))
DIGIT_NAME = re.compile(rf"\b(?:{DIGIT})\b", re.I)
#: Digits of which at least one is spelled, with the signs that join them.
SPELLED = re.compile(
    rf"(?:\bplus\s{{1,3}}|\+\s?)?\(?(?:\b(?:{DIGIT})\b|[0-9]++)(?:[\s().,-]{{1,3}}(?:(?:dot|point|dash|hyphen)\s{{1,3}})?(?:\b(?:{DIGIT})\b|[0-9]++))+",
    re.I,
)
SPELLED_PART = re.compile(
    rf"\bplus\s+|\+\s?|\b(?:{DIGIT})\b|[0-9]+|[\s.,-]{{1,3}}(?:dot|point)\s+|[\s.,-]{{1,3}}(?:dash|hyphen)\s+|[\s,]+|.", re.I | re.S
)
OPEN, CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
JOIN = r"(?:\s{1,3}|[_-])"
AT = re.compile(rf"(?P<mark>{OPEN}(?:at|@){CLOSE})|{JOIN}at{JOIN}|(?P<sign>\s?@\s?)", re.I)
DOT = rf"(?:(?P<mark>{OPEN}(?:dot|punkt|point|punto|\.){CLOSE})|(?P<word>{JOIN}dot{JOIN})|\.)"
DOT_AFTER = re.compile(DOT, re.I)
DOT_BEFORE = re.compile(rf"{DOT}$", re.I)
#: A label holds no sign that a spelled ``at`` or ``dot`` hangs on.
LABEL = re.compile(r"(?:[A-Za-z0-9%+]|[_-](?!(?:at|dot)[\s_-]))++", re.I)
LABEL_END = re.compile(r"[A-Za-z0-9%+_-]")
#: Every spelled address has one of these, whatever else its text holds.
ADDRESS_SIGN = re.compile(r"dot|[\[({<]\s{0,3}(?:at|@|punkt|point|punto|\.)|@\s|\s@|[\s_-]at[\s_-]", re.I)
#: No longer stretch of source stands for one dot.
REACH = 16


def lookalikes() -> dict[int, str]:
    """What is written for each look-alike: from the list, and by compatibility for single characters."""
    found = {ord(k): v for k, v in LOOKALIKES.items()} | {ord(c): "" for c in INVISIBLE}
    for at in [*range(0x2070, 0x2100), *range(0x2100, 0x2190), *range(0x2460, 0x24F0), *range(0xFE50, 0xFFF0), *range(0x1D400, 0x1D800)]:
        plain = unicodedata.normalize("NFKC", chr(at))
        if len(plain) == 1 and "!" <= plain <= "~":
            found.setdefault(at, plain)
    return found


LOOKS = lookalikes()
#: Cheap to look for: all look-alikes lie here, and little ordinary Latin text does.
OUTSIDE = re.compile("[\xa0\xaa\xad\xb2\xb3\xb9\xba\u0131\u0250-\U0010ffff]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Base e-mail matches: from each ``@`` left over the run before it, then right over the domain."""
    low = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            low = m.end()
        at = text.find("@", max(low, at + 1))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    found = [("email", *s) for s in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdecimal() for c in m[0]) <= 15]
    return found


class Rewritten:
    """A text as rewritten so far; each character knows the stretch of source that it stands for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)
        self.changed = False

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Write each edit's characters in place of [start, end); all of them stand for the whole stretch."""
        if not edits:
            return
        parts, starts, ends, at = [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            parts += [self.text[at:a], new]
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            if new:
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            at = b
        self.text, self.starts, self.ends, self.changed = "".join(parts), starts, ends, True


def plain_letters(r: Rewritten) -> None:
    if OUTSIDE.search(r.text):
        r.replace([(i, i + 1, LOOKS[ord(c)]) for i, c in enumerate(r.text) if ord(c) in LOOKS])


def names_digits(low: str) -> bool:
    for sign in "-().,":
        low = low.replace(sign, " ")
    found = DIGITS.keys() & set(low.split())
    return len(found) > 1 or bool(found - COMMON)


def plain_digits(r: Rewritten) -> None:
    if not names_digits(r.text.lower()):
        return
    edits = []
    for run in SPELLED.finditer(r.text):
        if not DIGIT_NAME.search(run[0]):
            continue
        for m in SPELLED_PART.finditer(r.text, *run.span()):
            part = m[0].lower()
            sign = part.strip(" \t\n\r.,-")
            if part in DIGITS:
                edits.append((*m.span(), DIGITS[part]))
            elif part.strip() in ("plus", "+"):
                edits.append((*m.span(), "+"))
            elif sign in ("dot", "point"):
                edits.append((*m.span(), "."))
            elif sign in ("dash", "hyphen"):
                edits.append((*m.span(), "-"))
            elif not part.strip(" \t\n\r,"):
                edits.append((*m.span(), ""))
    r.replace(edits)


def host_after(text: str, at: int) -> tuple[int, list[re.Match], str]:
    """The labels and dots from ``at`` on: where they end, the dots, the last label."""
    dots, m = [], LABEL.match(text, at)
    end, last = (m.end(), m[0]) if m else (at, "")
    while m and (dot := DOT_AFTER.match(text, end)) and (m := LABEL.match(text, dot.end())):
        dots.append(dot)
        end, last = m.end(), m[0]
    return end, dots, last


def name_before(text: str, at: int, low: int) -> tuple[int, list[tuple[int, int]]]:
    """The labels and dots up to ``at``: where they begin, and the spelled dots."""
    start, dots = at, []
    while True:
        begin = start
        while begin > low and LABEL_END.match(text, begin - 1):
            begin -= 1
        if begin == start:
            return (dots[-1][1], dots[:-1]) if dots and dots[-1][1] == start else (start, dots)
        start = begin
        window = max(low, start - REACH)
        dot = DOT_BEFORE.search(text, window, start)
        if not dot or dot.start() == low:
            return start, dots
        dots.append(dot.span())
        start = dot.start()


def plain_addresses(r: Rewritten) -> None:
    text = r.text
    if not ADDRESS_SIGN.search(text):
        return
    edits, low = [], 0
    for at in AT.finditer(text):
        if at.start() < low:
            continue
        end, dots, last = host_after(text, at.end())
        if not dots or len(last) < 2 or not last.isascii() or not last.isalpha():
            continue
        known = last.lower() in LAST_LABELS
        spelled = any(d["mark"] or d["word"] for d in dots)
        start, before = name_before(text, at.start(), low)
        name = text[start : at.start()]
        spaced = at[0] != "@" or spelled
        telling = at["mark"] or spelled and (at["sign"] or known) or known and not at["sign"] and re.search(r"[0-9._]", name)
        if name and spaced and telling:
            edits += [(a, b, ".") for a, b in reversed(before)]
            edits.append((*at.span(), "@"))
            edits += [(*d.span(), ".") for d in dots]
            low = end
    r.replace(edits)


def disguised_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that only show in the rewritten text, in places of the source."""
    r = Rewritten(text)
    for step in (plain_letters, plain_digits, plain_addresses):
        step(r)
    if not r.changed:
        return []
    within = {kind: [s for s in base if s[0] == kind] for kind in KINDS}
    found = []
    for kind, a, b in plain_spans(r.text):
        start, end = r.starts[a], r.ends[b - 1]
        if r.text[a:b] != text[start:end] and not any(s[1] <= start and end <= s[2] for s in within[kind]):
            found.append((kind, start, end))
    return found


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and disguised ones together, both by kind and start."""
    base = plain_spans(text)
    more = disguised_spans(text, base)
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if more else base


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts by kind, the base spans' digest, all spans.

    Null texts are empty. Nothing is shuffled; whole texts are searched, and every row
    gives a row. Other columns are left out.
    """
    out = f"doc_id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, texts = [], [], []
            for text in batch.column(1):
                base, spans = all_spans(text.as_py() or "")
                counts.append([sum(s[0] == k for s in base) for k in KINDS])
                digests.append(digest(base))
                texts.append(joined(spans))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, out)


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
