"""Token counts per section: a document is encoded once, and its tokens are attributed to its sections.

Tokens and sections are both intervals of characters. A document's tokens are joined to its sections by
binary search among the section borders; tokens that cross a border are allotted by a stated rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.bpe import encoder
from ringspan.llm.common import documents_of, small_batches

# How a token that crosses a border is allotted: to the section of its first or last character, to the
# section with most of its characters (the earliest of equals), or to each by its share of characters.
RULES = ("first", "last", "most", "share")

SECTIONS = "doc_id long, section int, from int, to int, n_tokens double, n_crossing long"


def token_spans(text: str, ids: np.ndarray, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters each token covers, as starts and ends (exclusive).

    Tokens are runs of bytes. One that holds part of a character's bytes covers that character.
    """
    ends = np.cumsum(byte_lengths[ids])
    starts = ends - byte_lengths[ids]
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) == len(text):
        return starts, ends
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char_of[starts], char_of[ends - 1] + 1


def allot(
    starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many tokens reach into it across a border.

    Section ``i`` covers ``borders[i]`` to ``borders[i + 1]``; sections cover the whole text and may be empty.
    """
    sections = len(borders) - 1
    tokens, crossing = np.zeros(sections), np.zeros(sections, np.int64)
    if not len(starts):
        return tokens, crossing
    # The last section that begins at or before a character; so characters never go to empty sections.
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, ends - 1, "right") - 1
    first, last = np.minimum(first, sections - 1), np.minimum(last, sections - 1)
    inside = first == last
    tokens += np.bincount(first[inside], minlength=sections)
    for start, end, a, b in zip(starts[~inside], ends[~inside], first[~inside], last[~inside]):
        reached = np.arange(a, b + 1)
        shares = np.minimum(end, borders[reached + 1]) - np.maximum(start, borders[reached])
        crossing[reached[shares > 0]] += 1
        if rule == "first":
            tokens[a] += 1
        elif rule == "last":
            tokens[b] += 1
        elif rule == "most":
            tokens[reached[np.argmax(shares)]] += 1
        else:
            tokens[reached] += shares / shares.sum()
    return tokens, crossing


def _count(batches: Iterable[pa.RecordBatch], tokenizer: str, rule: str, lines: bool) -> Iterator[pa.RecordBatch]:
    coder = encoder(tokenizer)
    for batch in small_batches(batches, 2 << 20):
        texts = batch.column("text").to_pylist()
        if lines:
            borders = [_line_borders(text) for text in texts]
        else:
            borders = [np.array(b, np.int64) for b in batch.column("borders").to_pylist()]
        ids, counts = coder.encode(texts)
        rows: list[list[np.ndarray]] = [[], [], [], [], [], []]
        at = 0
        for n, (text, count, cuts) in enumerate(zip(texts, counts.tolist(), borders)):
            spans = token_spans(text, ids[at : at + count], coder.bytes_of)
            at += count
            tokens, crossing = allot(*spans, cuts, rule)
            size = len(tokens)
            for column, values in zip(
                rows, (np.full(size, n), np.arange(size), cuts[:-1], cuts[1:], tokens, crossing)
            ):
                column.append(values)
        row, section, starts, ends, tokens, crossing = map(np.concatenate, rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(section, pa.int32()),
                pa.array(starts, pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array(tokens),
                pa.array(crossing, pa.int64()),
            ],
            names=["doc_id", "section", "from", "to", "n_tokens", "n_crossing"],
        )


def _line_borders(text: str) -> np.ndarray:
    lengths = np.fromiter((len(line) + 1 for line in text.split("\n")), np.int64)
    lengths[-1] -= 1
    return np.concatenate([[0], np.cumsum(lengths)])


def _check_rule(rule: str) -> None:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")


def line_token_counts(
    docs: DataFrame, tokenizer: str, rule: str = "most", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per line of each document: ``doc_id, section, from, to, n_tokens, n_crossing``.

    A line ends with its line feed, so lines cover the text and the counts of a document add up to its
    tokens. ``from`` and ``to`` are code points. A NULL or empty text has one empty line without tokens;
    repeated rows are counted one by one. No shuffle.
    """
    _check_rule(rule)
    return documents_of(docs, id_col, text_col).mapInArrow(
        lambda batches: _count(batches, tokenizer, rule, True), SECTIONS
    )


def field_token_counts(
    rows: DataFrame,
    fields: Sequence[str],
    tokenizer: str,
    rule: str = "most",
    id_col: str = "doc_id",
    separator: str = "\n",
) -> DataFrame:
    """The same per field of a row: the fields are joined by ``separator`` and encoded as one text.

    ``section`` is the field's position in ``fields``; the separator behind a field belongs to it. A NULL
    field is an empty one.
    """
    _check_rule(rule)
    values = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    values = [F.concat(v, F.lit(separator)) for v in values[:-1]] + values[-1:]
    ends = [F.char_length(F.concat(*values[: n + 1])) for n in range(len(values))]
    joined = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.concat(*values).alias("text"),
        F.array(F.lit(0), *ends).alias("borders"),
    )
    return joined.mapInArrow(lambda batches: _count(batches, tokenizer, rule, False), SECTIONS)
