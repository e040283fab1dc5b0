"""Tokenising by distinct segments.

A tokenizer that never merges across certain places gives the same ids for a text as for its
segments between such places, one after the other.  Corpus text repeats its segments, so each task
encodes a segment once, keeps its ids in a bounded table and puts texts together from that table.
Everything works on whole Arrow batches: segments are found, compared and gathered as flat numpy
arrays, without a Python object per word.
"""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Segments of up to this many bytes are compared as 64-bit words; longer ones one by one.
KEY_WORDS = 4
#: Segments kept by a worker between batches (some 120 MB); a full table is emptied and filled anew.
KEPT = 600_000
#: Texts are worked on in slices of about this many bytes, so that arrays stay small.
SLICE = 4_000_000


def give_back() -> None:
    """Freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not the GNU C library
        pass


def thrifty(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` as a task for ``mapInArrow`` that gives freed memory back to the system when it ends.

    Python workers live on between tasks and would keep the largest task's memory beside the executor's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ASCII = np.arange(256) < 128
#: Second bytes of the letters U+00C0 to U+00FF, all of that block but the two signs in it.
_LATIN = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0) & (np.arange(256) != 0x97) & (np.arange(256) != 0xB7)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> list[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes, one row at least."""
    out, low = [], 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        out.append((low, high))
        low = high
    return out


def row_slices(column: pa.Array, size: int) -> Iterator[tuple[int, int, pa.Array]]:
    """Rows low to high of a string column, about ``size`` bytes at a time, without a copy of the whole."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    for low, high in slices(offsets, size):
        yield low, high, column.slice(low, high - low)


def _letter_ends(flat: np.ndarray) -> np.ndarray:
    """True where a byte ends a letter of ASCII or of U+00C0 to U+00FF; one shorter than ``flat``."""
    out = _LETTER[flat[:-1]]
    out[1:] |= (flat[:-2] == 0xC3) & _LATIN[flat[1:-1]]
    return out


def words_cut(flat: np.ndarray) -> np.ndarray:
    """Where a pattern of letter runs, single digits and runs of other signs, spaces apart, always
    ends a match: position i is true if one may cut before byte i.

    Cuts lie around ASCII white space, after a letter before an ASCII sign that is none, and before an
    ASCII letter after another ASCII sign but the apostrophe, which may begin a contraction.
    """
    a, b = flat[:-1], flat[1:]
    space = _SPACE[a] != _SPACE[b]
    after = _letter_ends(flat) & _ASCII[b] & ~_LETTER[b]
    before = _LETTER[b] & _ASCII[a] & ~_LETTER[a] & (a != 39)
    return space | after | before


def spaced_cut(flat: np.ndarray) -> np.ndarray:
    """Cuts where a space belongs to what follows it: after a letter before an ASCII sign that is none,
    and before white space after anything else in ASCII."""
    a, b = flat[:-1], flat[1:]
    return (_letter_ends(flat) & _ASCII[b] & ~_LETTER[b]) | (_ASCII[a] & ~_SPACE[a] & _SPACE[b])


def piece_cut(flat: np.ndarray) -> np.ndarray:
    """Cuts before a space after anything else, and around line ends, which no piece holds."""
    a, b = flat[:-1], flat[1:]
    return ((a != 32) & (b == 32)) | (a == 10) | (b == 10)


def occurrences(flat: np.ndarray, offsets: np.ndarray, strings: tuple[bytes, ...]) -> Iterator[tuple[int, int]]:
    """Places of the strings, which neither overlap nor hold each other, within rows."""
    text = flat.tobytes() if strings else b""
    for string in strings:
        low = text.find(string)
        while low >= 0:
            high = low + len(string)
            row = np.searchsorted(offsets, low, side="right")
            if high <= offsets[row]:
                yield low, high
                low = text.find(string, high)
            else:  # begins in one row and ends in another
                low = text.find(string, low + 1)


class SegmentTable:
    """Ids of the segments seen so far by this worker.

    ``encode(list of str) -> (all ids, number of ids of each)`` is called for segments that are not in
    the table.  ``drop_space`` leaves out segments of white space only, which have no ids.  ``whole`` are
    strings that stand for one id wherever they occur: each is a segment of its own.
    """

    def __init__(self, encode: Callable, cut: Callable, drop_space: bool = False, whole: tuple[str, ...] = ()):
        self.encode, self.cut, self.drop_space = encode, cut, drop_space
        self.whole = tuple(x.encode() for x in whole)
        self._empty()

    def _empty(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = self.rows = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.words = np.zeros((1 << 12, KEY_WORDS), np.uint64)

    def _add(self, texts: list[str], words: np.ndarray) -> np.ndarray:
        """New rows of the table."""
        flat, counts = self.encode(texts)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        first, last = self.rows, self.rows + len(texts)
        while last > len(self.start):
            self.start, self.count, self.words = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count, self.words)
            )
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[first:last] = self.used + np.cumsum(counts) - counts
        self.count[first:last] = counts
        self.words[first:last] = words
        self.used, self.rows = self.used + len(flat), last
        return np.arange(first, last)

    def slots(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Table slot of each segment, and each row's first segment (one more at the end)."""
        if len(flat) == 0:
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        edge = np.zeros(len(flat) + 1, bool)
        edge[1:-1] = self.cut(flat)
        edge[offsets] = True
        for low, high in occurrences(flat, offsets, self.whole):
            edge[low:high] = False
            edge[[low, high]] = True
        edge[-1] = False
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(flat))
        if self.drop_space:
            kept = ~_SPACE[flat[starts]]
            starts, ends = starts[kept], ends[kept]
        rows = np.searchsorted(starts, offsets)
        length = ends - starts
        padded = np.concatenate([flat, np.zeros(8 * KEY_WORDS, np.uint8)])
        eights = np.lib.stride_tricks.as_strided(padded, (len(flat) + 8 * (KEY_WORDS - 1) + 1, 8), (1, 1))
        words = []
        mixed = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(KEY_WORDS):
            left = np.clip(length - 8 * k, 0, 8).astype(np.uint64)
            rest = np.flatnonzero(left) if k else slice(None)
            word = np.zeros(len(starts), np.uint64)
            at = starts[rest] + 8 * k
            mask = np.where(left[rest] == 8, ~np.uint64(0), (np.uint64(1) << (left[rest] * np.uint64(8) & np.uint64(63))) - np.uint64(1))
            word[rest] = eights[at].copy().view(np.uint64)[:, 0] & mask
            words.append(word)
            mixed[rest] = (mixed[rest] ^ (mixed[rest] >> np.uint64(29)) ^ word[rest]) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        order = np.argsort(mixed)
        change = np.zeros(len(order), bool)
        change[:1] = True
        # equal hashes stand together; a new group begins wherever anything differs
        for word in (mixed, length, *words):
            by = word[order]
            change[1:] |= by[1:] != by[:-1]
        change |= length[order] > 8 * KEY_WORDS
        groups = np.cumsum(change) - 1
        first = order[change]
        if self.rows > KEPT:
            self._empty()
        keys, long = mixed[first].tolist(), length[first] > 8 * KEY_WORDS
        mine = np.stack([w[first] for w in words], axis=1)
        known = np.fromiter((self.slot.get(key, -1) for key in keys), np.int64, len(keys))
        # a hash that another segment has already taken, and long segments, are encoded each time
        known[(self.words[known] != mine).any(axis=1) | long] = -1
        new = np.flatnonzero(known < 0)
        if len(new):
            text = flat.tobytes()
            low, high = starts[first[new]].tolist(), ends[first[new]].tolist()
            known[new] = self._add([text[a:b].decode() for a, b in zip(low, high, strict=True)], mine[new])
            for i, row in zip(new.tolist(), known[new].tolist(), strict=True):
                if not long[i]:
                    self.slot.setdefault(keys[i], row)
        out = np.empty(len(order), np.int64)
        out[order] = known[groups]
        return out, rows

    def gather(self, slots: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments one after the other, and each row's first id (one more at the end)."""
        counts = self.count[slots]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total, dtype=np.int64) + np.repeat(self.start[slots] - (ends - counts), counts)
        return self.ids[index], np.concatenate([[0], ends])[rows]


def library_table(path: str) -> SegmentTable:
    """A table over a file of the tokenizers library, whose pattern is known to allow the cuts.

    Ids are those of the library as it stands: a special token's string in a text is that token.
    """
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    library = Tokenizer.from_file(path)
    specials = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    mark, model = "<|endoftext|>", library.model

    def shown(text: str) -> str:
        """What the model is given for a text that is one word."""
        if library.normalizer is not None:
            text = library.normalizer.normalize_str(text)
        return "".join(part for part, _ in library.pre_tokenizer.pre_tokenize_str(text))

    letters = {ord(x): shown(x) for x in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]) if x.isalpha()}
    word = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    if library.normalizer is None:  # a space belongs to the word after it
        letters[ord(" ")] = shown(" a").removesuffix("a")
        word = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")

    def plain(texts: list[str]) -> Iterator[list[int]]:
        # a word of these letters is one word to the library's pattern too, so its model can be asked at once
        for text in "\n".join(texts).translate(letters).split("\n"):
            yield [token.id for token in model.tokenize(text)]

    def other(texts: list[str]) -> Iterator[np.ndarray]:
        # encoded many at a time, parted by a special token; segments that are one go alone
        for low in range(0, len(texts), 100):
            some = texts[low : low + 100]
            if any(special in text for text in some for special in specials):
                yield from (np.array(one.ids, np.int32) for one in library.encode_batch_fast(some, add_special_tokens=False))
            else:
                # the same ids as encode, without the places of tokens in texts
                ids = np.array(library.encode_batch_fast([mark.join(some)], add_special_tokens=False)[0].ids, np.int32)
                at = np.flatnonzero(ids == specials[mark])
                yield from (x[i > 0 :] for i, x in enumerate(np.split(ids, at)))

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        is_word = [word.fullmatch(text) is not None for text in texts]
        words = plain([text for text, one in zip(texts, is_word, strict=True) if one])
        rest = other([text for text, one in zip(texts, is_word, strict=True) if not one])
        found = [next(words) if one else next(rest) for one in is_word]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts

    if library.normalizer is None:
        return SegmentTable(encode, spaced_cut, whole=tuple(specials))
    return SegmentTable(encode, words_cut, drop_space=True, whole=tuple(specials))


_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_powers: dict[int, np.ndarray] = {}


def powers(root: np.uint64, n: int) -> np.ndarray:
    """The first n powers of an odd number, kept for the next slice."""
    held = _powers.get(int(root))
    if held is None or len(held) < n:
        held = np.full(max(n, SLICE // 2), root, np.uint64)
        held[0] = 1
        _powers[int(root)] = held = np.multiply.accumulate(held)
    return held[:n]


def run_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of all bytes of each run, from one cumulative sum."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers(_ROOT, len(flat)), out=sums[1:])
    mixed = (sums[ends] - sums[starts]) * powers(_INVERSE, len(flat) + 1)[starts]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true, which end at row ends too."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    at = np.append(np.flatnonzero(edge[:-1]), len(inside))
    kept = inside[at[:-1]]
    return at[:-1][kept], at[1:][kept]
