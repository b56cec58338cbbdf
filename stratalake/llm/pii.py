"""Personal data in whole texts, disguised or not, at its place in the source."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.llm.common import slices, strings

KINDS = ("email", "ip", "card", "phone")

# The patterns that define the plain identifiers.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: The parts that these searches are made of, so that a long run of one sign is passed over once: what follows
#: the sign of an address, and an ip from the start of its first number on, where alone one can begin.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_BLANKS = re.compile(r"\s{2,}")

# Letters of other scripts that look like Latin ones, and signs that look like ASCII.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαονιρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ‐‑‒–—−․。｡∙＠﹫   ",
    "aeopcyxijshdqwABEKMHOPCTYXIJSaovipuABEZHIKMNOPTYX------....@@\x20\x20\x20",
)
LOOKALIKES |= {0xFF01 + i: 0x21 + i for i in range(94)}  # wide forms of ASCII
LOOKALIKES |= {start + i: 0x30 + i for start in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for i in range(10)}
INVISIBLE = "­​‌‍⁠﻿"
ODD = frozenset(map(chr, LOOKALIKES)) | frozenset(INVISIBLE)
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
ENDINGS = "com|org|net|edu|gov|io|info|co|uk|de|fr|es|eu|ch|at|us|biz|dev|app"

_WORD = "|".join(DIGIT_WORDS)
_OPEN, _SHUT = r"\s*[(\[{<]\s*", r"\s*[)\]}>]\s*"
#: What makes a bare "at" a sign: a host in plain or disguised form after it.
_HOST = rf"[a-z0-9-]+(?:\s+dot\s+|{_OPEN}(?:dot|\.){_SHUT}|(?:\.[a-z0-9-]+)*\.(?:{ENDINGS})\b)"
#: Rewrites of words, each matched in the text whose letters are already plain.
DISGUISES = re.compile(
    rf"(?P<at>{_OPEN}(?:at|@){_SHUT}|(?<=[a-z0-9])\s+at\s+(?={_HOST})|\s+@\s*(?=[a-z0-9])|(?<=[a-z0-9])@\s+(?=[a-z0-9]))"
    rf"|(?P<dot>{_OPEN}(?:dot|\.){_SHUT}|(?<=[a-z0-9])\s+dot\s+(?=[a-z0-9]))"
    rf"|(?P<plus>\bplus\s+(?=[0-9]|(?:{_WORD})\b))"
    rf"|(?P<digits>\b(?:{_WORD})(?:[\s,-]+(?:{_WORD}|oh)\b)*\b)"
    r"|(?P<round>(?<=[0-9])o(?=[0-9]))|(?P<bar>(?<=[0-9])[il](?=[0-9]))",
    re.IGNORECASE,
)
_DIGIT_RUN = re.compile(rf"{_WORD}|oh", re.IGNORECASE)
#: Parts of a text in lower case, one of which must be there for any rewrite to apply. Each begins
#: with a fixed string where it can, which makes the search for it cheap.
CUES = [
    re.compile(cue)
    for cue in (
        r"[(\[{<]\s*at\s*[)\]}>]", rf"at(?<=\sat)\s+(?={_HOST})",
        r"dot[\s)\]}>](?<=[\s(\[{<]dot[\s)\]}>])", r"@[\s)\]}>]", r"[\s(\[{<]@",
        r"[(\[{<]\s*\.", r"plus\s(?<!\wplus\s)", r"[0-9][oil](?=[0-9])", *(rf"{w}\b(?<!\w{w})" for w in DIGIT_WORDS),
    )
]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL: around each sign, back over what may stand before it and is in no earlier match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at + 1):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", at + 1)


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place, kind) with ends, by start, then kind: what the fixed patterns accept."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in _emails(text)]
    if DIGIT.search(text):
        for m in _IP_RUNS.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return [(start, KINDS[k], end) for start, k, end in sorted(found)]


def _letters(text: str) -> tuple[str, Sequence[int]]:
    """The text with look-alikes made plain and invisible signs left out, and each sign's place in the source."""
    if text.isascii() or ODD.isdisjoint(text):
        return text, range(len(text))
    kept = [i for i, c in enumerate(text) if c not in INVISIBLE]
    if len(kept) == len(text):
        return text.translate(LOOKALIKES), range(len(text))
    return "".join(text[i] for i in kept).translate(LOOKALIKES), kept


def _rewrite(m: re.Match) -> str:
    if m.lastgroup == "digits":
        return "".join(DIGIT_WORDS.get(w.lower(), "0") for w in _DIGIT_RUN.findall(m.group()))
    return {"at": "@", "dot": ".", "plus": "+", "round": "0", "bar": "1"}[m.lastgroup]


def _disguised(text: str) -> bool:
    low = text.lower()
    return any(cue.search(low) for cue in CUES)


def _rewrites(signs: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, result) of each rewrite of words.

    How many blanks stand between words makes no difference to one, and it takes all of them. So each run of
    them is made one before the search, which would otherwise begin anew at every blank of a run.
    """
    runs = [(m.start(), m.end() - m.start() - 1) for m in _BLANKS.finditer(signs)]
    if not runs:
        for m in DISGUISES.finditer(signs):
            yield m.start(), m.end(), _rewrite(m)
        return
    starts, removed, pieces, at, total = [], [0], [], 0, 0
    for start, more in runs:
        starts.append(start - total)  # in the shorter text
        pieces.append(signs[at : start + 1])
        at, total = start + 1 + more, total + more
        removed.append(total)
    short = "".join([*pieces, signs[at:]])
    for m in DISGUISES.finditer(short):
        start, end = m.span()
        yield start + removed[bisect_left(starts, start)], end + removed[bisect_left(starts, end)], _rewrite(m)


class Normalised:
    """Plain form of a text, and the source span of each of its characters.

    Two passes over tracked characters: signs first, words second. What one rewrite makes of
    several characters carries the span of all of them. Only rewrites are recorded, so a text
    without any costs no more than the search for them.
    """

    def __init__(self, text: str):
        signs, self.place = _letters(text)
        out, at, length = [], 0, 0
        #: For each rewrite, where its result begins and ends in the plain form, and its span among the signs.
        self.begins, self.rewrites = [], []
        for start, end, new in _rewrites(signs) if _disguised(signs) else ():
            length += start - at
            self.begins.append(length)
            self.rewrites.append((length + len(new), start, end))
            out += [signs[at:start], new]
            length, at = length + len(new), end
        self.text = "".join([*out, signs[at:]]) if out else signs

    def _signs(self, i: int) -> tuple[int, int]:
        """The signs that character i of the plain form was made of."""
        if not (k := bisect_right(self.begins, i)):
            return i, i + 1
        end, a, b = self.rewrites[k - 1]
        return (a, b) if i < end else (b + i - end, b + i - end + 1)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a span of the plain form."""
        return self.place[self._signs(start)[0]], self.place[self._signs(end - 1)[1] - 1] + 1


def spans(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Plain spans, and all spans: the plain ones and those that appear once disguises are undone.

    What appears is added unless it lies wholly in a plain span of its kind; one that reaches beyond stands beside it.
    """
    base = plain_spans(text)
    plain = Normalised(text)
    if plain.text == text:
        return base, base
    # Plain spans of a kind stand in order and do not overlap.
    starts = {k: [s for s, x, _ in base if x == k] for k in KINDS}
    ends = {k: [e for _, x, e in base if x == k] for k in KINDS}
    added = set()
    for s, k, e in plain_spans(plain.text):
        a, b = plain.source(s, e)
        i = bisect_right(starts[k], a) - 1
        if i < 0 or ends[k][i] < b:
            added.add((a, k, b))
    return base, sorted({*base, *added}, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in found)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in each row's whole text, in code points, ends exclusive.

    Columns: doc_id, n_email, n_ip, n_card, n_phone (plain spans of each kind), n_added (spans found only
    under a disguise), base_sha256 (digest of the plain spans), spans (all). A null or empty text
    has none. Repeated rows give equal rows, equal spans are given once. Other columns of `docs` are
    not read. No rows give no rows.
    """
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            found = [spans(text) for text in strings(batch.column("text"))]
            counts = [pa.array([sum(x[1] == k for x in base) for base, _ in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *counts,
                    pa.array([len(every) - len(base) for base, every in found], pa.int64()),
                    pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([_joined(every) for _, every in found], pa.string()),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(find, f"doc_id {kind}, {counts}, n_added long, base_sha256 string, spans string")
