"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A batch's distinct words are put one after another and indexed by a suffix array. Every piece of the vocabulary
is searched in it by bisection, which gives all places where it occurs: the edges of a lattice over the words.
Edges are sorted by where they end and relaxed in that order.

For a BPE vocabulary the path is not the one of least cost. Merging has exactly one result for a text, the
results of its prefixes are consistent with it, and a sequence of pieces is that result if and only if merging
leaves every two neighbours apart. So a place is reached by the one edge whose piece stays apart from the
last piece on the path to the edge's beginning, and the path to a word's end is its encoding. Whether two
pieces stay apart is decided by undoing their merges from the latest on: at no time may the two pieces that
meet be mergeable before the next merge that was made.

A space is the mark U+2581, and each text begins with one. Pieces of the vocabulary hold the mark at their
beginning only (checked), or consist of marks; so words, each with its mark, encode alone. Runs of several marks
merge last and from the left. Characters without a piece become pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import documents_of, small_batches

MARK = "▁"
# Distinct words whose encoding a worker keeps; when there are more, the half met first stays.
KEEP_WORDS = 300_000
KEEP_CHARS = 60
# Words of up to so many characters are relaxed side by side.
_IN_STEP = 200
# Characters indexed at once; the index and its edges take many bytes for each.
INDEX_CHARS = 1 << 18
_NEVER = np.iinfo(np.int32).max
_KNOWN_CHARS = 0x110000


class Vocabulary:
    """Pieces of a SentencePiece BPE model, with the order in which they merge."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)])
        self.byte_ids = np.zeros(256, np.int32)
        for i in np.flatnonzero([model.is_byte(i) for i in range(size)]).tolist():
            self.byte_ids[int(self.texts[i][3:5], 16)] = i
        self.control = frozenset(i for i in range(size) if model.is_control(i))
        ordinary = [i for i in range(size) if not special[i] and not model.is_unused(i)]
        if any(MARK in self.texts[i][1:] and self.texts[i].strip(MARK) for i in ordinary):
            raise ValueError("pieces with a mark behind their beginning are not supported")
        self.ids = {self.texts[i]: i for i in ordinary}
        # When a piece is merged: pieces of higher score first. Single characters are there from the beginning.
        order = sorted((i for i in ordinary if len(self.texts[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.merged = np.full(size, -1, np.int32)
        self.merged[order] = np.arange(len(order))
        self._learn_merges()
        self._time, self._halves = self.merged.tolist(), list(zip(self.left.tolist(), self.right.tolist()))
        # What each id stands for, as bytes in one array.
        raw = [t.replace(MARK, " ").encode() for t in self.texts]
        for byte, i in enumerate(self.byte_ids.tolist()):
            raw[i] = bytes([byte])
        for i in self.control:
            raw[i] = b""
        self._sizes = np.array(list(map(len, raw)), np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        """The text of ids: marks are spaces, the first one goes; bytes that are not UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        ids = np.asarray(ids, np.int64)
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        text = self._bytes[places].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def _learn_merges(self) -> None:
        """Pairs that merge, and each piece's own last merge; pieces that merging never makes are left out."""
        pairs = {}
        for text, i in self.ids.items():
            for cut in range(1, len(text)):
                left, right = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = i
        self.pairs = pairs
        keys = np.array([left << 32 | right for left, right in pairs], np.int64)
        order = np.argsort(keys)
        self._keys, self._made = keys[order], np.array(list(pairs.values()), np.int32)[order]
        self.left = np.full(len(self.texts), -1, np.int32)
        self.right = np.full(len(self.texts), -1, np.int32)
        self.usable: dict[str, int] = {}
        for text, i in self.ids.items():
            parts = self._merge(text)
            if len(parts) == 1:
                self.usable[text] = i
                if len(text) > 1:
                    self.left[i], self.right[i] = parts[0]

    def _merge(self, text: str) -> list[tuple[int, int]]:
        """Merge a piece's own characters; per piece left, the two it was made of."""
        parts = [(self.ids.get(c, -1), (-1, -1)) for c in text]
        while True:
            found = [
                (self.merged[made], at)
                for at in range(len(parts) - 1)
                if (made := self.pairs.get((parts[at][0], parts[at + 1][0]))) is not None
            ]
            if not found:
                return [made_of for _, made_of in parts]
            _, at = min(found)
            pair = (parts[at][0], parts[at + 1][0])
            parts[at : at + 2] = [(self.pairs[pair], pair)]

    def _merge_time(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """When two pieces side by side merge; ``_NEVER`` for those that don't."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self.merged[self._made[at]], _NEVER)

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves two pieces side by side as they are, for arrays of pieces."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        result = np.ones(len(left), bool)
        # The boundary pair must not merge before this time.
        limit = np.full(len(left), _NEVER, np.int64)
        open_ = np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            fine = self._merge_time(a, b) >= limit[open_]
            result[open_[~fine]] = False
            time_a, time_b = self.merged[a], self.merged[b]
            more = fine & (np.maximum(time_a, time_b) >= 0)
            open_, a, b, time_a, time_b = (x[more] for x in (open_, a, b, time_a, time_b))
            # Undo the later merge. Equal pieces merge from the left, so the right one is the later.
            undo_left = time_a > time_b
            left[open_] = np.where(undo_left, self.right[a], a)
            right[open_] = np.where(undo_left, b, self.left[b])
            # At equal times a merge further left comes first: that of the left piece, not that of the right one.
            limit[open_] = np.where(undo_left, time_a, time_b.astype(np.int64) + 1)
        return result

    def apart_one(self, left: int, right: int) -> bool:
        """The same for one pair."""
        limit = _NEVER
        while True:
            made = self.pairs.get((left, right))
            if made is not None and self._time[made] < limit:
                return False
            time_left, time_right = self._time[left], self._time[right]
            if time_left > time_right:
                left, limit = self._halves[left][1], time_left
            elif time_right >= 0:
                right, limit = self._halves[right][0], time_right + 1
            else:
                return True


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``codes`` in the order of the ``depth`` codes that begin there; zeros follow the end.

    As many codes as fit into a number are compared at first; ranks then double what is known.
    """
    symbols, small = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(symbols)).bit_length())
    known = min(depth, 62 // bits)
    rank = np.zeros(len(codes), np.int64)
    for step in range(known):
        rank <<= bits
        rank[: max(0, len(codes) - step)] |= small[step:].astype(np.int64) + 1
    while known < depth:
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
        following = np.zeros(len(codes), np.int64)
        following[: max(0, len(codes) - known)] = rank[known:]
        rank = rank << 32 | following
        known *= 2
    return np.argsort(rank)


class Index:
    """The pieces of a vocabulary searched in a text by its suffix array."""

    def __init__(self, vocabulary_: Vocabulary) -> None:
        texts = [t for t in vocabulary_.usable if t.strip(MARK) or t == MARK]
        self.pieces = np.array([vocabulary_.usable[t] for t in texts], np.int64)
        self.lengths = np.array(list(map(len, texts)), np.int64)
        self.depth = int(self.lengths.max())
        self.codes = np.zeros((len(texts), self.depth), np.int32)
        for row, text in enumerate(texts):
            self.codes[row, : len(text)] = list(map(ord, text))

    def _bisect(self, codes: np.ndarray, array: np.ndarray, after: bool) -> np.ndarray:
        """For every piece, the first suffix not before it, or the first one after those that begin with it."""
        low, high = np.zeros(len(self.pieces), np.int64), np.full(len(self.pieces), len(array), np.int64)
        columns = np.arange(self.depth)
        inside = columns < self.lengths[:, None]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            found = codes[array[middle][:, None] + columns]
            differs = (found != self.codes[open_]) & inside[open_]
            first = differs.argmax(axis=1)
            some = np.arange(len(open_))
            less = found[some, first] < self.codes[open_, first]
            before = np.where(differs.any(axis=1), less, after)
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``start, end, piece`` of all occurrences of all pieces in ``codes``."""
        array = suffix_array(codes, self.depth)
        padded = np.concatenate([codes, np.zeros(self.depth, codes.dtype)])
        low, high = self._bisect(padded, array, False), self._bisect(padded, array, True)
        counts = high - low
        which = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        starts = array[place]
        return starts, starts + self.lengths[which], self.pieces[which]


class _Numbers(dict):
    """Word (without its mark) -> its number in the store; a word that is asked for first is queued."""

    def __init__(self) -> None:
        self.filled = 1
        self.queued: list[str] = []

    def __missing__(self, word: str) -> int:
        if not word or len(word) > KEEP_CHARS:
            return 0
        number = self[word] = self.filled + len(self.queued)
        self.queued.append(word)
        return number


class Encoder:
    """Encodes texts; the words met first are kept from batch to batch, their ids in one flat array."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.index = Index(self.vocabulary)
        self._numbers = _Numbers()
        self._ids = np.empty(0, np.int32)
        self._starts = self._sizes = np.zeros(1, np.int64)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of every text; an empty text has none."""
        words = [text.replace(MARK, " ").split(" ") if text else [] for text in texts]
        lookup = self._numbers.__getitem__
        found = [np.fromiter(map(lookup, w), np.int64, len(w)) for w in words]
        self._learn()
        result = []
        for parts, numbers in zip(words, found):
            if not numbers.all():
                result.append(self._one(parts))
                continue
            sizes = self._sizes[numbers]
            ends = np.cumsum(sizes)
            places = np.repeat(self._starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            result.append(self._ids[places])
        if len(self._numbers) > KEEP_WORDS:
            self._forget()
        return result

    def _learn(self) -> None:
        queued = self._numbers.queued
        group: list[str] = []
        held = 0
        for word in [*queued, None]:
            if group and (word is None or held + len(word) > INDEX_CHARS):
                ids = self._encode(group)
                sizes = np.array(list(map(len, ids)), np.int64)
                self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes) - sizes])
                self._sizes = np.concatenate([self._sizes, sizes])
                self._ids = np.concatenate([self._ids, *ids])
                group, held = [], 0
            if word is not None:
                group.append(MARK + word)
                held += len(word) + 2
        self._numbers.filled += len(queued)
        self._numbers.queued = []

    def _forget(self) -> None:
        kept = dict(islice(self._numbers.items(), KEEP_WORDS // 2))
        self._numbers = _Numbers()
        self._numbers.update(kept)
        count = self._numbers.filled = len(kept) + 1
        self._starts, self._sizes = self._starts[:count], self._sizes[:count]
        self._ids = self._ids[: int((self._starts + self._sizes).max())]

    def _one(self, parts: list[str]) -> np.ndarray:
        """A text with runs of spaces or very long words."""
        encoded = iter(self._encode([MARK + word for word in parts if word]) if any(parts) else ())
        ids: list[np.ndarray] = []
        marks = 0
        for word in parts:
            marks += 1
            if not word:
                continue
            own = next(encoded)
            if marks > 1:
                # The run's last mark belongs to the word unless merging leaves it alone.
                alone = own[0] == self.vocabulary.ids.get(MARK)
                ids.append(self._marks(marks if alone else marks - 1))
                own = own[1:] if alone else own
            ids.append(own)
            marks = 0
        if marks:
            ids.append(self._marks(marks))
        return np.concatenate(ids)

    def _marks(self, count: int) -> np.ndarray:
        """A run of marks alone: merged from the left as far as pieces go."""
        return np.array([i for i, _ in _merge_run(self.vocabulary, count)], np.int32)

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Index the words, relax the edges in the order of their ends, and walk the paths back."""
        lengths = np.array(list(map(len, words)), np.int64)
        text = "\0".join(words) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le"), np.int32)
        # Zeros part the words; a real NUL becomes a character that no piece has.
        firsts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        separators = np.zeros(len(codes), bool)
        separators[firsts + lengths] = True
        codes = np.where((codes == 0) & ~separators, _KNOWN_CHARS, codes)
        starts, ends, pieces = self.index.edges(codes)

        # A character that no piece of one character covers stands alone; nothing merges with it.
        covered = separators.copy()
        covered[starts[ends - starts == 1]] = True
        alone = np.flatnonzero(~covered)
        starts, ends = np.concatenate([starts, alone]), np.concatenate([ends, alone + 1])
        pieces = np.concatenate([pieces, np.full(len(alone), -1)])

        word_of = np.cumsum(separators) - separators
        offset = ends - firsts[word_of[starts]]
        order = np.argsort(offset, kind="stable")
        starts, ends, pieces, offset = starts[order], ends[order], pieces[order], offset[order]
        last = np.full(len(codes) + 1, -2, np.int64)  # the piece that ends before a place; -2 for none yet
        back = np.zeros(len(codes) + 1, np.int64)
        begins = np.zeros(len(codes) + 1, bool)
        begins[firsts] = True
        # Words are relaxed in step, an end place at a time; very long ones alone, an edge at a time.
        long = (lengths > _IN_STEP)[word_of[starts]]
        self._relax_long(starts[long], ends[long], pieces[long], begins, last, back)
        starts, ends, pieces, offset = starts[~long], ends[~long], pieces[~long], offset[~long]
        steps = np.flatnonzero(np.diff(offset, prepend=-1))
        for low, high in zip(steps, np.append(steps[1:], len(offset))):
            s, e, p = starts[low:high], ends[low:high], pieces[low:high]
            before = last[s]
            right = begins[s] | (before == -1) | (p == -1)
            ask = np.flatnonzero(~right & (before >= 0))
            if len(ask):
                # Equal questions are answered once.
                keys, where = np.unique(before[ask] << 32 | p[ask], return_inverse=True)
                right[ask] = self.vocabulary.apart(keys >> 32, keys & 0xFFFFFFFF)[where]
            last[e[right]], back[e[right]] = p[right], s[right]
        return self._paths(codes, firsts, firsts + lengths, last, back)

    def _relax_long(
        self,
        starts: np.ndarray,
        ends: np.ndarray,
        pieces: np.ndarray,
        begins: np.ndarray,
        last: np.ndarray,
        back: np.ndarray,
    ) -> None:
        known: dict[tuple[int, int], bool] = {}
        reached: dict[int, int] = {}
        order = np.argsort(ends, kind="stable")
        for s, e, p in zip(starts[order].tolist(), ends[order].tolist(), pieces[order].tolist()):
            if e in reached:
                continue
            if not begins[s] and p != -1:
                before = reached.get(s, -2)
                if before == -2:
                    continue
                if before != -1:
                    if (before, p) not in known:
                        known[before, p] = self.vocabulary.apart_one(before, p)
                    if not known[before, p]:
                        continue
            reached[e] = p
            last[e], back[e] = p, s

    def _paths(
        self, codes: np.ndarray, firsts: np.ndarray, ends: np.ndarray, last: np.ndarray, back: np.ndarray
    ) -> list[np.ndarray]:
        """All words' pieces, from their ends back to their beginnings in step."""
        words, places = np.arange(len(firsts)), ends.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            going = places > firsts[words]
            words, places = words[going], places[going]
            if not len(words):
                break
            found.append((words, places, last[places]))
            places = back[places]
        if not found:
            return [np.empty(0, np.int32) for _ in firsts]
        owner, place, piece = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, owner))
        owner, place, piece = owner[order], place[order], piece[order]
        unknown = piece < 0
        if unknown.any():
            owner, piece = self._with_bytes(codes, owner, place, piece, unknown)
        counts = np.bincount(owner, minlength=len(firsts))
        return np.split(piece.astype(np.int32), np.cumsum(counts)[:-1])

    def _with_bytes(
        self, codes: np.ndarray, owner: np.ndarray, place: np.ndarray, piece: np.ndarray, unknown: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        chars = [chr(c) if c != _KNOWN_CHARS else "\0" for c in codes[place[unknown] - 1].tolist()]
        raw = [c.encode() for c in chars]
        times = np.ones(len(piece), np.int64)
        times[unknown] = list(map(len, raw))
        owner, wide = np.repeat(owner, times), np.repeat(piece, times)
        wide[np.repeat(unknown, times)] = self.vocabulary.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return owner, wide


@lru_cache(maxsize=64)
def _merge_run(vocabulary_: Vocabulary, count: int) -> tuple[tuple[int, int], ...]:
    """Ids and lengths of a run of ``count`` marks. All merges of marks come equally late, so the leftmost is next."""
    limit = max(len(t) for t in vocabulary_.ids if not t.strip(MARK))
    parts: list[int] = []
    left = count
    # Only the first marks of a long run need to be looked at: what is merged to the full length stays.
    while left:
        chunk = _merge_marks(vocabulary_, min(left, 2 * limit))
        if left > 2 * limit:
            chunk = chunk[:1]
        parts += chunk
        left -= sum(chunk)
    return tuple((vocabulary_.ids[MARK * n], n) for n in parts)


def _merge_marks(vocabulary_: Vocabulary, count: int) -> list[int]:
    parts = [1] * count
    at = 0
    while at < len(parts) - 1:
        if MARK * (parts[at] + parts[at + 1]) in vocabulary_.ids:
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            at = max(0, at - 1)
        else:
            at += 1
    return parts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a model file, with the words it has met so far."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, pieces array<int>, intact``, one row per document, as the library encodes it.

    ``intact`` tells whether decoding gives the text back (a mark U+2581 in a text comes back as a space). A
    NULL or empty text has no pieces; repeated rows are encoded one by one. No shuffle.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in small_batches(batches, 1 << 20):
            texts = batch.column("text").to_pylist()
            ids = coder.encode(texts)
            intact = [coder.vocabulary.decode(i) == text.replace(MARK, " ") for i, text in zip(ids, texts)]
            offsets = np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *ids])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                    pa.array(intact),
                ],
                names=["doc_id", "n_pieces", "pieces", "intact"],
            )

    return documents_of(docs, id_col, text_col).mapInArrow(
        encode, "doc_id long, n_pieces long, pieces array<int>, intact boolean"
    )


def decode_pieces(rows: DataFrame, model: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """``doc_id, text`` of encoded rows; NULL pieces give an empty text."""

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            texts = [words.decode(ids or ()) for ids in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    narrow = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{pieces_col}`").alias("pieces"))
    return narrow.mapInArrow(back, "doc_id long, text string")


def pieces_report(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, intact``: the checksum of the ids as little-endian 32-bit integers."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.asarray(p.values, "<u4").tobytes()) for p in batch.column("pieces")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_pieces"), pa.array(sums, pa.int64()), batch.column("intact")],
                names=["doc_id", "n_pieces", "ids_crc32", "intact"],
            )

    return encoded.mapInArrow(check, "doc_id long, n_pieces long, ids_crc32 long, intact boolean")
