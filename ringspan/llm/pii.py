"""Personal data in texts, also where it is disguised, with offsets into the source.

The plain text is searched first. Then a chain of transducers rewrites it: look-alike characters to ASCII,
spelled digits to digits, written-out at and dot signs to the signs. Every rewritten character knows the
source characters it stands for, so identifiers found in the rewritten text are reported, and can be
masked, in the source. All searches take time in proportion to the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import documents_of, small_batches

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, ``@`` and dotted domain.

    A local part ends at its ``@``, so the search goes from one ``@`` to the next instead of trying every start.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    """Four dotted numbers of at most 255; a longer chain is read four numbers at a time."""
    for chain in _NUMBERS.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    """Runs of digits, single spaces and hyphens between them, with 12 to 19 digits and a right check digit."""
    for run in _CARD.finditer(text):
        digits = run.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield run.span()


def phones(text: str) -> Iterator[Span]:
    """A plus sign and 9 to 15 digits with the usual marks between them."""
    for run in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(run.group())) <= 15:
            yield run.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (emails, ips, cards, phones)))


@dataclass
class Aligned:
    """A rewritten text; character ``i`` stands for source characters ``starts[i]`` to ``ends[i]``."""

    text: str
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, text: str) -> Aligned:
        at = np.arange(len(text) + 1, dtype=np.int32)
        return cls(text, at[:-1], at[1:])

    def source(self, start: int, end: int) -> Span:
        return int(self.starts[start]), int(self.ends[end - 1])

    def rewritten(self, edits: Iterable[tuple[int, int, str]]) -> Aligned:
        """With each stretch ``start, end`` put as another string, whose characters all stand for the stretch."""
        texts, starts, ends, at = [], [], [], 0
        for start, end, new in edits:
            texts += [self.text[at:start], new]
            starts.append(self.starts[at:start])
            ends.append(self.ends[at:start])
            if new:
                first, last = self.source(start, end)
                starts.append(np.full(len(new), first, np.int32))
                ends.append(np.full(len(new), last, np.int32))
            at = end
        if not texts:
            return self
        return Aligned(
            "".join([*texts, self.text[at:]]),
            np.concatenate([*starts, self.starts[at:]]),
            np.concatenate([*ends, self.ends[at:]]),
        )


# Cyrillic and Greek letters drawn like Latin ones, and the Latin ones.
_LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονα",
        "ABESIJKMHOPCTYXaesijopcyxdhqw" "ABEZHIKMNOPTYXova",
    )
)
# Invisible characters; hyphens and minus signs; spaces; dots.
_INVISIBLE = "­​‌‍⁠﻿"
_HYPHENS = "‐‑‒–−"
_SPACES = "    　"
_DOTS = "․。｡"


def _digit_rows() -> dict[str, str]:
    """Decimal digits of other scripts and styles, by the code points of their zeros."""
    zeros = (0x660, 0x6F0, 0x966, 0x9E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
    return {chr(zero + d): str(d) for zero in zeros for d in range(10)}


_PLAIN = (
    {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}  # full-width forms
    | _digit_rows()
    | _LOOK_ALIKES
    | dict.fromkeys(_INVISIBLE, "")
    | dict.fromkeys(_HYPHENS, "-")
    | dict.fromkeys(_SPACES, " ")
    | dict.fromkeys(_DOTS, ".")
)
_ODD = re.compile("[" + "".join(map(re.escape, _PLAIN)) + "]")


def plain_characters(text: Aligned) -> Aligned:
    """Look-alikes, full-width forms and foreign digits as ASCII; invisible characters go."""
    if text.text.isascii():
        return text
    return text.rewritten((m.start(), m.end(), _PLAIN[m.group()]) for m in _ODD.finditer(text.text))


# The digits in words, in the four languages, from nought to nine.
_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_DIGIT_OF = {word: str(d) for words in _WORDS for d, word in enumerate(words.split())} | {"oh": "0"}
_WORD = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
# Three digits in words at least, with marks or written-out dots between them; a plus sign may come first.
_GAP = r"(?:[ \t]*[-,.][ \t]*|[ \t]+(?:(?:dot|point|punkt|punto)[ \t]+)?)"
_SPELLED = re.compile(rf"(?<!\w)(?:plus[ \t]+)?{_WORD}(?:{_GAP}{_WORD}){{2,}}(?!\w)", re.IGNORECASE)
_SPELLED_PART = re.compile(rf"(?<!\w)(?:plus|dot|point|punkt|punto|{_WORD})(?!\w)|\.", re.IGNORECASE)


_DIGIT_WORDS = frozenset(_DIGIT_OF) | {"dot", "point", "punkt", "punto"}
_MARKS_TO_SPACES = str.maketrans("-,.", "   ")


def _may_spell(text: str) -> bool:
    """Whether three words that may belong to a spelled number follow each other; cheap, for most texts."""
    words = text.lower().translate(_MARKS_TO_SPACES).split()
    return b"\1\1\1" in bytes(map(_DIGIT_WORDS.__contains__, words))


def _spelled(words: str) -> str:
    parts = (m.group().lower() for m in _SPELLED_PART.finditer(words))
    return "".join("+" if p == "plus" else _DIGIT_OF.get(p, ".") for p in parts)


def spelled_digits(text: Aligned) -> Aligned:
    """Runs of three or more digits in words as digits, ``plus`` before them as ``+``, a written dot as ``.``."""
    if not _may_spell(text.text):
        return text
    edits = []
    for run in _SPELLED.finditer(text.text):
        # Each word is rewritten alone, so parts of a run map back to their own words.
        at = run.start()
        for part in _SPELLED_PART.finditer(text.text, run.start(), run.end()):
            if part.start() > at:
                edits.append((at, part.start(), ""))
            edits.append((part.start(), part.end(), _spelled(part.group())))
            at = part.end()
    return text.rewritten(edits)


# A match begins at its bracket; the blanks before it are taken in afterwards, so that long white space is read once.
_OPEN, _CLOSE = r"[(\[{<][ \t]*", r"[ \t]*[)\]}>][ \t]*"
_AT_WORD, _DOT_WORD = r"(?:at|arroba|chez|ät)", r"(?:dot|punkt|punto|point)"
_LABEL = r"[A-Za-z0-9-]{1,63}"
# Last parts of a domain for which a bare "at" and "dot" are believed to spell an address.
_TOP = "(?:com|org|net|edu|gov|mil|info|biz|io|dev|ai|app|eu|uk|us|de|fr|es|it|nl|ch|at|be|pl|ca|au|in|jp|cn|br|mx|ru)"
# In brackets the words are signs; bare ones only where an address is spelled out to its last dot.
_BRACKETED = re.compile(rf"{_OPEN}(?:(at|arroba|@)|(dot|punkt|punto|point|\.)){_CLOSE}", re.IGNORECASE)
_BARE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:[ \t]+{_AT_WORD}[ \t]+|@){_LABEL}"
    rf"(?:\.{_LABEL})*(?:[ \t]+{_DOT_WORD}[ \t]+{_LABEL}(?:\.{_LABEL})*)*?[ \t]+{_DOT_WORD}[ \t]+{_TOP}(?![A-Za-z0-9-])"
    rf"(?:[ \t]+{_DOT_WORD}[ \t]+{_TOP}(?![A-Za-z0-9-]))?",
    re.IGNORECASE,
)
_BARE_SIGN = re.compile(rf"[ \t]+(?:({_AT_WORD})|{_DOT_WORD})[ \t]+", re.IGNORECASE)
_DOTTED_NUMBERS = re.compile(rf"(?<![\w.])[0-9]{{1,3}}(?:[ \t]+{_DOT_WORD}[ \t]+[0-9]{{1,3}}){{3}}(?!\w)", re.IGNORECASE)
_HAS_DOT_WORD = re.compile(rf"[ \t]{_DOT_WORD}[ \t]", re.IGNORECASE)


def written_signs(text: Aligned) -> Aligned:
    """``name (at) host [dot] org``, ``name at host dot org`` and ``1 dot 2 dot 3 dot 4`` with the signs."""
    if any(mark in text.text for mark in "([{<"):
        edits, done = [], 0
        for sign in _BRACKETED.finditer(text.text):
            start = done + len(text.text[done : sign.start()].rstrip(" \t"))
            edits.append((start, sign.end(), "@" if sign[1] else "."))
            done = sign.end()
        text = text.rewritten(edits)
    if not _HAS_DOT_WORD.search(text.text):
        return text
    edits = []
    for pattern in (_BARE, _DOTTED_NUMBERS):
        for run in pattern.finditer(text.text):
            for sign in _BARE_SIGN.finditer(text.text, run.start(), run.end()):
                edits.append((sign.start(), sign.end(), "@" if sign[1] else "."))
    return text.rewritten(sorted(edits))


TRANSDUCERS = (plain_characters, spelled_digits, written_signs)


def find_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """``start, end, kind's place in KINDS, plainly written`` in order of start, then kind.

    A disguised identifier that overlaps a plainly written one of its kind is not reported.
    """
    plain = {kind: list(FINDERS[kind](text)) for kind in KINDS}
    spans = [(a, b, KINDS.index(kind), True) for kind in KINDS for a, b in plain[kind]]
    whole = rewritten = Aligned.of(text)
    for transducer in TRANSDUCERS:
        rewritten = transducer(rewritten)
    if rewritten is not whole:
        for number, kind in enumerate(KINDS):
            taken, at = plain[kind], 0
            for found in FINDERS[kind](rewritten.text):
                start, end = rewritten.source(*found)
                while at < len(taken) and taken[at][1] <= start:
                    at += 1
                if at == len(taken) or taken[at][0] >= end:
                    spans.append((start, end, number, False))
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


SPANS = "array<struct<kind:string,from:int,to:int,plain:boolean>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, spans`` per document: identifiers in whole texts, by start and then kind.

    Spans count code points, end exclusive; ``plain`` tells those found without rewriting. A NULL or empty
    text has no spans; repeated rows are searched one by one. No shuffle.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32()), ("plain", pa.bool_())])
        for batch in small_batches(batches):
            spans = [
                [{"kind": KINDS[k], "from": a, "to": b, "plain": p} for a, b, k, p in find_spans(text)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, pa.list_(kind))], names=["doc_id", "text", "spans"]
            )

    return documents_of(docs, id_col, text_col).mapInArrow(search, f"doc_id long, text string, spans {SPANS}")


def mask_pii(found: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``find_pii`` with every span replaced by its kind, as in ``[email]``.

    Of overlapping spans the first is masked, and what the others add beyond it is cut.
    """

    def step(state, span):  # noqa: ANN001, ANN202
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(span["from"] - state["at"], F.lit(0)))
        label = F.when(span["from"] >= state["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise("")
        return F.struct(
            F.concat(state["out"], gap, label).alias("out"),
            F.greatest(span["to"], state["at"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    masked = F.aggregate(
        "spans", start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    )
    return found.select("doc_id", masked.alias("text"))


def pii_report(found: DataFrame) -> DataFrame:
    """Counts of plainly written identifiers and digests of the spans, per document of ``find_pii``."""

    def listed(spans):  # noqa: ANN001, ANN202
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"], s["to"])))

    def count(kind):  # noqa: ANN001, ANN202
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long")

    plain = F.filter("spans", lambda s: s["plain"])
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(plain), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(plain)).cast("long").alias("n_disguised"),
    )
