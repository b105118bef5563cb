"""Byte-level BPE encoding that pays for each distinct word once.

A byte-level tokenizer first splits a text into words, runs of marks and white space, then merges bytes
inside each. Pieces between two sure borders of that split encode the same wherever they stand. The encoder
cuts texts before spaces, line ends, commas and full stops, gives each distinct piece to the ``tokenizers``
library once, keeps its ids in one flat array and builds the ids of whole texts by array gathers. A text
in which some cut is not a sure border goes to the library whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, islice

import numpy as np
from tokenizers import Tokenizer

# Distinct pieces one worker keeps (about 200 bytes each). When there are more, the half met first stays:
# frequent pieces are met early.
KEEP_PIECES = 600_000
# A longer piece is not kept; its text goes to the library.
KEEP_CHARS = 60

_BEFORE = " \n.,"
_BORDER = "\x1f"
_NONE, _EMPTY = 0, 1  # piece numbers: not kept; the empty beginning of a text
_SPACE, _MARK, _START = 0, 1, 2  # how a piece opens
_WHITE, _OTHER, _WORD = 0, 1, 2  # how it closes


def _opens(piece: str) -> int:
    return _SPACE if piece[0] in " \n" else _MARK if piece[0] in ".," else _START


def _closes(piece: str) -> int:
    last = piece[-1]
    # Letters beyond Latin are not trusted to be letters in every version of the Unicode tables.
    return _WHITE if last.isspace() else _WORD if last < "ɐ" and last.isalnum() else _OTHER


def _is_word(piece: str) -> bool:
    """A space and Latin letters: one word for the tokenizer."""
    return piece[0] == " " and piece[1:].isalpha() and max(piece) < "ɐ"


# Byte-level vocabularies write printable Latin-1 characters as they are, other bytes as characters from 256 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
_ALPHABET = {b: 256 + at for at, b in enumerate(_HIDDEN)}


class _Numbers(dict):
    """Piece -> its number in the store; a piece that is asked for first is queued for encoding."""

    def __init__(self) -> None:
        self[""] = _EMPTY
        self.filled = 2
        self.queued: list[str] = []

    def __missing__(self, piece: str) -> int:
        # White space not followed by a word may belong to the piece before or behind.
        if len(piece) > KEEP_CHARS or (piece[0] in " \n" and (len(piece) == 1 or piece[1].isspace())):
            return _NONE
        number = self[piece] = self.filled + len(self.queued)
        self.queued.append(piece)
        return number


class Encoder:
    """Ids of whole texts, without special tokens added, exactly as the tokenizer gives them."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_of = self._byte_lengths()
        self._numbers = _Numbers()
        self._ids = np.empty(1 << 16, np.int32)
        self._used = 0
        self._starts, self._sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._open, self._close = np.zeros(1 << 14, np.int8), np.zeros(1 << 14, np.int8)
        self._open[_EMPTY], self._close[_EMPTY] = _START, _WORD

    def _byte_lengths(self) -> np.ndarray:
        """Bytes of text that each id stands for."""
        lengths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            lengths[i] = len(token)  # one character stands for one byte
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            lengths[i] = len(token.content.encode())
        return lengths

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` one after another, and how many of them belong to each text."""
        if not len(texts):
            return np.empty(0, np.int32), np.zeros(0, np.int64)
        lookup = self._numbers.__getitem__
        found = []
        for text in texts:
            if _BORDER in text:
                found.append(np.array([_NONE]))
                continue
            for mark in _BEFORE:
                text = text.replace(mark, _BORDER + mark)
            pieces = text.split(_BORDER)
            found.append(np.fromiter(map(lookup, pieces), np.int64, len(pieces)))
        self._learn()

        numbers = np.concatenate(found)
        firsts = np.cumsum([0, *map(len, found[:-1])])
        opens, closes = self._open[numbers], self._close[numbers]
        unsure = numbers == _NONE
        # A space needs something else before it, a mark needs a word; the first piece of a text needs nothing.
        behind = np.where(opens[1:] == _MARK, closes[:-1] != _WORD, closes[:-1] == _WHITE)
        behind[firsts[1:] - 1] = False
        unsure[1:] |= behind
        whole = np.flatnonzero(np.maximum.reduceat(unsure, firsts))

        sizes = self._sizes[numbers]
        counts = np.add.reduceat(sizes, firsts)
        ids = self._gather(numbers, sizes)
        if len(whole):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for at, encoding in zip(whole.tolist(), self._library([texts[at] for at in whole])):
                parts[at] = np.array(encoding, np.int32)
                counts[at] = len(encoding)
            ids = np.concatenate(parts)
        if len(self._numbers) > KEEP_PIECES:
            self._forget()
        return ids, counts

    def _gather(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return self._ids[np.repeat(self._starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1])]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the queued pieces and store their ids."""
        queued = self._numbers.queued
        if not queued:
            return
        opens = np.fromiter(map(_opens, queued), np.int8, len(queued))
        closes = np.fromiter(map(_closes, queued), np.int8, len(queued))
        single = np.fromiter(map(_is_word, queued), bool, len(queued))
        joinable = (opens == _SPACE) & (closes != _WHITE) & ~single
        alone, joined = np.flatnonzero(~joinable & ~single), np.flatnonzero(joinable)
        flat, sizes = [], np.zeros(len(queued), np.int64)
        order = np.concatenate([np.flatnonzero(single), alone, joined])
        # One word is what the library's model takes, once its bytes are written in the model's alphabet.
        tokenize = self.tokenizer.model.tokenize
        words = [
            [t.id for t in tokenize(queued[at].encode().decode("latin-1").translate(_ALPHABET))]
            for at in np.flatnonzero(single).tolist()
        ]
        sizes[single] = list(map(len, words))
        flat.append(np.fromiter(chain.from_iterable(words), np.int32))
        for at, ids in zip(alone.tolist(), self._library([queued[at] for at in alone])):
            flat.append(np.array(ids, np.int32))
            sizes[at] = len(ids)
        # Pieces that begin with a space are encoded many in a text, and told apart by their bytes.
        for at in range(0, len(joined), 512):
            group = joined[at : at + 512]
            pieces = [queued[i] for i in group]
            ids = np.array(self._library(["".join(pieces)])[0], np.int32)
            piece_ends = np.cumsum([len(piece.encode()) for piece in pieces])
            upto = np.searchsorted(np.cumsum(self.bytes_of[ids]), piece_ends, "right")
            flat.append(ids)
            sizes[group] = np.diff(upto, prepend=0)
        self._store(np.concatenate(flat), order, sizes, opens, closes)
        self._numbers.queued = []

    def _store(
        self, flat: np.ndarray, order: np.ndarray, sizes: np.ndarray, opens: np.ndarray, closes: np.ndarray
    ) -> None:
        first, end = self._numbers.filled, self._numbers.filled + len(sizes)
        while end > len(self._sizes):
            for name in ("_starts", "_sizes", "_open", "_close"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        while self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        self._ids[self._used : self._used + len(flat)] = flat
        starts = np.empty(len(sizes), np.int64)
        starts[order] = self._used + np.cumsum(sizes[order]) - sizes[order]
        self._starts[first:end], self._sizes[first:end] = starts, sizes
        self._open[first:end], self._close[first:end] = opens, closes
        self._used += len(flat)
        self._numbers.filled = end

    def _forget(self) -> None:
        """Keep the pieces met first, up to half of the limit."""
        kept = dict(islice(self._numbers.items(), KEEP_PIECES // 2))
        numbers = _Numbers()
        numbers.update(kept)
        numbers.filled = max(kept.values()) + 1
        self._used = int((self._starts[: numbers.filled] + self._sizes[: numbers.filled]).max())
        self._numbers = numbers


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, with the pieces it has met so far."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
