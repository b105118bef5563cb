"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton recognises every run of consecutive words of every item. A document's words are streamed
through it once; at each word it gives the longest run ending there that occurs in some item, and its
suffix links lead to all shorter ones. An item is looked for by windows of ``window`` consecutive words;
an item with fewer words is one window.

Items are read in blocks of bounded size, one automaton per block; an automaton is broadcast, so what an
executor holds does not grow with the number of items. Documents pass through the blocks one after another
in the same tasks, with no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringspan.llm.common import documents_of, merge_intervals, small_batches

WINDOW = 10
# Words of items in one automaton: some 100 MB in an executor's worker.
BLOCK_WORDS = 100_000

# The bytes that make up words, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_LOWER = {upper: upper + 32 for upper in range(0x41, 0x5B)}


def words_of(text: str) -> list[bytes]:
    """The normalised words of a text, as UTF-8."""
    return text.encode().translate(_FOLD).split()


class Automaton:
    """Suffix automaton of many word sequences, with the windows of each sequence marked on its states."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.words: dict[bytes, int] = {}
        self.window = window
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]
        items = [(name, [self.words.setdefault(w, len(self.words) + 1) for w in words]) for name, words in items]
        for _, ids in items:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        # Per state: {window length: names of items that have such a window ending in this state}.
        self._marks: dict[int, dict[int, set[str]]] = {}
        for name, ids in items:
            size = min(window, len(ids))
            for at, (state, _) in enumerate(self._walk(ids)):
                if size and at + 1 >= size:
                    while self._length[self._link[state]] >= size:
                        state = self._link[state]
                    self._marks.setdefault(state, {}).setdefault(size, set()).add(name)
        self.shortest = min((m for marks in self._marks.values() for m in marks), default=0)
        # The nearest marked state on each state's chain of suffix links, itself included; -1 for none.
        self._marked = [-1] * len(self._link)
        for state in sorted(range(1, len(self._link)), key=self._length.__getitem__):
            self._marked[state] = state if state in self._marks else self._marked[self._link[state]]

    def _extend(self, last: int, word: int) -> int:
        """Add one word after state ``last``; the state of the whole sequence so far."""
        step, link, length = self._next, self._link, self._length
        seen = step[last].get(word)
        if seen is not None:
            return seen if length[seen] == length[last] + 1 else self._clone(last, word, seen)
        new = len(link)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at != -1:
            target = step[at][word]
            link[new] = target if length[target] == length[at] + 1 else self._clone(at, word, target)
        return new

    def _clone(self, at: int, word: int, target: int) -> int:
        """Split off from ``target`` the runs that end in the transition from ``at``."""
        step, link, length = self._next, self._link, self._length
        new = len(link)
        step.append(dict(step[target]))
        link.append(link[target])
        length.append(length[at] + 1)
        link[target] = new
        while at != -1 and step[at].get(word) == target:
            step[at][word] = new
            at = link[at]
        return new

    def _walk(self, ids: Iterable[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state and the length of the longest run of item words that ends there."""
        step, link, length = self._next, self._link, self._length
        state = matched = 0
        for word in ids:
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            yield state, matched

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit words of a document as disjoint word intervals, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, names
        ids = np.fromiter(map(self.words.get, words, [0] * len(words)), np.int64, len(words))
        # Only stretches of item words that are long enough for some window can hold one.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids != 0, [0]))))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            for at, (state, matched) in enumerate(self._walk(ids[start:end].tolist()), start + 1):
                marked = self._marked[state]
                while marked > 0:
                    reach = matched if marked == state else self._length[marked]
                    for size, owners in self._marks[marked].items():
                        if size <= reach:
                            spans.append((at - size, at))
                            names |= owners
                    marked = self._marked[self._link[marked]]
        return merge_intervals(spans), names

    def longest(self, words: list[bytes]) -> list[int]:
        """After each word, the length of the longest run of item words that ends there."""
        return [matched for _, matched in self._walk([self.words.get(w, 0) for w in words])]


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, window: int, block_words: int
) -> Iterator[Automaton]:
    """Automata over all items, each of at most ``block_words`` words.

    The driver holds one block. A longer item is cut into pieces that overlap by a window less one word,
    so each of its windows lies in one piece.
    """
    block: list[tuple[str, list[bytes]]] = []
    held = 0
    rows = items.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    for name, text in rows.where(rows[0].isNotNull() & rows[1].isNotNull()).toLocalIterator():
        words = words_of(text)
        size = max(block_words, window)
        for at in range(0, max(1, len(words) - window + 1), size - window + 1):
            piece = words[at : at + size]
            if held and held + len(piece) > block_words:
                yield Automaton(block, window)
                block, held = [], 0
            block.append((name, piece))
            held += len(piece)
    if block:
        yield Automaton(block, window)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, text, n_words, hits array<struct<from, to>>, items array<string>``, one row per document.

    ``hits`` are disjoint word intervals (end exclusive) covered by occurrences of windows, ``items`` the
    ids of the items with such windows, each once, sorted as strings. A NULL text has no words; a
    repeated document gives a row per copy; items with a NULL id or text, or no words, are never found;
    items of the same id count as one. Without items, nothing is hit.
    """
    rows = documents_of(docs, id_col, text_col)
    return _through_blocks(rows, items, item_id_col, item_text_col, window, block_words)


def _through_blocks(
    rows: DataFrame,
    items: DataFrame,
    item_id_col: str,
    item_text_col: str,
    window: int,
    block_words: int,
    then: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
    shape: StructType | None = None,
) -> DataFrame:
    """``rows`` (with a column ``text``) and the columns ``n_words``, ``hits`` and ``items`` behind.

    ``then`` makes rows of ``shape`` of these. All of it is one function, as a task has a worker for each function
    that follows another.
    """
    found = rows.select(
        "*",
        F.lit(None).cast("int").alias("n_words"),
        F.array().cast("array<struct<from:int,to:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = found.schema
    context = rows.sparkSession.sparkContext
    # Without any item one pass still counts the words.
    blocks = item_blocks(items, item_id_col, item_text_col, window, block_words)
    shared = [context.broadcast(block) for block in chain([next(blocks, Automaton([], window))], blocks)]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in shared:
            batches = _scan(batches, block.value)
        return then(batches) if then else batches

    return found.mapInArrow(scan, shape or schema)


def _scan(batches: Iterable[pa.RecordBatch], automaton: Automaton) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("from", pa.int32()), ("to", pa.int32())])
    for batch in small_batches(batches, 2 << 20):
        counts, hits, items = [], [], []
        for text, old_hits, old_items in zip(
            *(batch.column(name).to_pylist() for name in ("text", "hits", "items"))
        ):
            words = words_of(text or "")
            spans, names = automaton.hits(words)
            if old_hits:
                spans = merge_intervals([*spans, *((h["from"], h["to"]) for h in old_hits)])
            counts.append(len(words))
            hits.append([{"from": a, "to": b} for a, b in spans])
            items.append(sorted(names.union(old_items)))
        added = [pa.array(counts, pa.int32()), pa.array(hits, pa.list_(span)), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *added], names=batch.schema.names)


def contamination_report(found: DataFrame) -> DataFrame:
    """The figures per document of ``find_contamination``."""
    n_hit = F.aggregate("hits", F.lit(0), lambda n, h: n + h["to"] - h["from"]).cast("long")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in the given word intervals and what stands between those words."""
    places = [m.span() for m in re.finditer(WORD, text.translate(_LOWER))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    max_words: int = WINDOW - 1,
    max_coverage: float = 0.5,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages; the columns stay, clean rows are returned as they are.

    A span of hit words longer than ``max_words`` is cut from the text. A document of which more than
    ``max_coverage`` of the words are hit is dropped. Where there is an integer column ``n_chars`` it
    gets the length of a changed text. Repeated rows are treated one by one; a NULL text stays NULL.
    """
    shape = docs.schema
    # The whole row travels as one value, so no column name can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), whole.alias("row"))
    text_at = shape.names.index(text_col)
    chars_at = shape.names.index("n_chars") if "n_chars" in shape.names else None
    if chars_at is not None and shape["n_chars"].dataType.typeName() not in ("long", "integer"):
        chars_at = None

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2 << 20):
            keep, changed = [], {}
            for at, (hits, n_words) in enumerate(
                zip(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist())
            ):
                spans = [(h["from"], h["to"]) for h in hits]
                if sum(b - a for a, b in spans) > max_coverage * n_words:
                    continue
                spans = [s for s in spans if s[1] - s[0] > max_words]
                if spans:
                    changed[at] = cut_words(batch.column("text")[at].as_py(), spans)
                keep.append(at)
            columns = batch.column("row").flatten()
            _replace(columns, text_at, changed)
            if chars_at is not None:
                _replace(columns, chars_at, {at: len(text) for at, text in changed.items()})
            yield pa.RecordBatch.from_arrays(columns, names=shape.names).take(pa.array(keep, pa.int64()))

    return _through_blocks(rows, items, item_id_col, item_text_col, window, block_words, clean, shape)


def _replace(columns: list[pa.Array], column: int, changed: dict) -> None:
    if changed:
        values = columns[column].to_pylist()
        for at, value in changed.items():
            values[at] = value
        columns[column] = pa.array(values, columns[column].type)
