"""Encoding and decoding of a byte-pair sentencepiece model by vectorised merge rounds.

Words of a batch lie one after the other in a flat array of symbols.  A round looks up the rank of every
pair of neighbours, takes the least rank within each word, merges all its leftmost non-overlapping pairs of
that rank at once and closes the gaps.  Rounds go on until no pair is left.  Merging pairs of one rank
together equals merging them one after the other if no pair that the new piece can form ranks better or as
well; for the few pieces where that does not hold, a round merges the leftmost pair of a word alone.
Characters outside the vocabulary become their UTF-8 bytes' pieces.

Words are the stretches between places that no piece crosses: before a space after anything else, and
around line ends.  Each task encodes a word once (``segments.SegmentTable``).

Decoding joins the pieces' bytes, drops the leading space that encoding puts before a text, and turns bytes
that are no UTF-8 into U+FFFD, one for each byte, as the library does.

Defined results: null is the empty text, which has no ids; documents without an id and repeated rows are
kept as they are; an empty table gives no rows; a text of any length is encoded whole.  Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ordermill.llm import segments

SPACE = "▁"
#: Slots of the pair table, a power of two well above the number of pairs.
SLOTS = 1 << 21
_NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairModel:
    """Ranks and results of all pairs, from a model file of the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.size, self.unknown = size, lib.unk_id()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(size)]
        by_text = {p: i for i, p in enumerate(pieces) if not special[i]}
        scores = np.array([lib.get_score(i) for i in range(size)])
        _, rank = np.unique(-scores, return_inverse=True)
        self.byte = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.char = {ord(p): i for p, i in by_text.items() if len(p) == 1}
        self.char[32] = self.char[ord(SPACE)]

        keys, merged = [], []
        for text, i in by_text.items():
            for cut in range(1, len(text)):
                left, right = by_text.get(text[:cut]), by_text.get(text[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    merged.append(i)
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        ranks = rank[merged]
        best = np.full(size, size, np.int64)  # of the pairs that hold a piece
        for half in (keys // size, keys % size):
            np.minimum.at(best, half, ranks)
        shared = np.bincount(rank[list(by_text.values())], minlength=size + 1)[rank] > 1
        self.alone = (best <= rank) | shared  # pieces to be merged one at a time
        self.rank = rank.astype(np.int32)

        self.keys = np.full(SLOTS, -1, np.int64)
        self.merged = np.full(SLOTS, -1, np.int32)
        self.probes = 1
        slot = self._slot(keys)
        for key, i, at in zip(keys.tolist(), merged.tolist(), slot.tolist(), strict=True):
            probe = 1
            while self.keys[at] >= 0:
                at, probe = (at + 1) & (SLOTS - 1), probe + 1
            self.keys[at], self.merged[at], self.probes = key, i, max(self.probes, probe)

        self.raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in range(size):
            if lib.is_control(i):
                self.raw[i] = b""
        for b in range(256):
            self.raw[self.byte[b]] = bytes([b])
        self.raw[self.unknown] = " ⁇ ".encode()
        self.prefixed = [p.startswith(SPACE) and not special[i] for i, p in enumerate(pieces)]
        self.decimal = [str(i).encode() for i in range(size)]

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(43)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left < self.size) & (right < self.size))
        keys = left[todo].astype(np.int64) * self.size + right[todo]
        at = self._slot(keys)
        for _ in range(self.probes):
            there = self.keys[at]
            hit = there == keys
            out[todo[hit]] = self.merged[at[hit]]
            on = ~hit & (there >= 0)
            if not on.any():
                break
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & (SLOTS - 1)
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        distinct, back = np.unique(points, return_inverse=True)
        # a character outside the vocabulary is a symbol above it, which no pair holds
        known = np.array([self.char.get(p, self.size + p) for p in distinct.tolist()], np.int64)
        symbols = known[back]
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_symbol, done_at = [], [], []
        at = np.arange(len(symbols))
        while len(symbols):
            made = np.full(len(symbols), -1, np.int32)
            inside = np.flatnonzero(word[1:] == word[:-1])
            made[inside] = self.pairs(symbols[inside], symbols[inside + 1])
            rank = np.where(made >= 0, self.rank[made], _NONE)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbols)))
            still = least != _NONE
            ended = np.repeat(~still, size)
            done_word.append(word[ended])
            done_symbol.append(symbols[ended])
            done_at.append(at[ended])
            merge = (rank == np.repeat(least, size)) & ~ended
            # of neighbouring pairs that share a symbol, every other one from the left
            here = np.flatnonzero(merge)
            run = np.concatenate([[True], here[1:] != here[:-1] + 1]) if len(here) else np.zeros(0, bool)
            begin = here[run][np.cumsum(run) - 1] if len(here) else here
            merge[here[(here - begin) % 2 == 1]] = False
            here = np.flatnonzero(merge)
            single = self.alone[made[here]]
            if single.any():
                leftmost = np.concatenate([[True], word[here][1:] != word[here][:-1]])
                merge[here[single & ~leftmost]] = False
                here = np.flatnonzero(merge)
            symbols[here] = made[here]
            kept = ~ended
            kept[here + 1] = False
            symbols, word, at = symbols[kept], word[kept], at[kept]
        if not done_at:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        at = np.concatenate(done_at)
        order = np.argsort(at)
        symbols, word = np.concatenate(done_symbol)[order], np.concatenate(done_word)[order]
        outside = np.flatnonzero(symbols >= self.size)
        if len(outside):
            counts = np.ones(len(symbols), np.int64)
            as_bytes = [chr(int(p) - self.size).encode() for p in symbols[outside].tolist()]
            counts[outside] = [len(b) for b in as_bytes]
            start = np.cumsum(counts) - counts
            spread = np.repeat(symbols, counts)
            for i, data in zip(start[outside].tolist(), as_bytes, strict=True):
                spread[i : i + len(data)] = self.byte[list(data)]
            symbols, word = spread, np.repeat(word, counts)
        return symbols.astype(np.int32), np.bincount(word, minlength=len(words))

    def decode(self, ids: Sequence[int]) -> str:
        data = b"".join([self.raw[i] for i in ids])
        first = next((i for i in ids if self.raw[i]), None)
        if first is not None and self.prefixed[first]:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _lenient(data)


def _lenient(data: bytes) -> str:
    out, i = [], 0
    while i < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[i : i + size].decode())
                i += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


@cache
def model(path: str) -> PairModel:
    return PairModel(path)


@cache
def _table(path: str) -> segments.SegmentTable:
    return segments.SegmentTable(model(path).encode_words, segments.piece_cut)


def encode_column(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text of an Arrow column, in its order."""
    table = _table(path)
    texts = pc.replace_substring(texts.cast(pa.large_string()), SPACE, " ")
    flat, offsets = segments.utf8(texts)
    for low, high in segments.slices(offsets):
        own = offsets[low : high + 1] - offsets[low]
        filled = np.diff(own) > 0
        part = np.insert(flat[offsets[low] : offsets[high]], own[:-1][filled], 32)
        own = own + np.concatenate([[0], np.cumsum(filled)])
        ids, starts = table.gather(*table.slots(part, own))
        for row in range(high - low):
            yield ids[starts[row] : starts[row + 1]]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x.tolist() for x in encode_column(batch.column("text"), path)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        task, "doc_id long, ids array<int>"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them, without carrying the ids on."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model(path)
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for ids in encode_column(batch.column("text"), path):
                ids = ids.tolist()
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(b",".join([pairs.decimal[i] for i in ids])).hexdigest())
                text_hash.append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
