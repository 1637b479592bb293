"""Byte-level BPE in two tiers: a minimal perfect hash for whole pre-tokens, then merging on a heap."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

#: Texts that a worker remembers before it forgets those it has not met again since as many others. A short text and its ids take
#: some 200 bytes, and a worker has two memories of two generations each.
REMEMBERED = 500_000
#: A single space between two characters that are none.
_BETWEEN_WORDS = re.compile(r" (?<=\S )(?=\S)")
#: Bytes of text whose words are cut and looked up together; a longer text is a group of its own.
GROUPED = 1 << 23
#: Bytes that begin a character other than white space, whatever follows; those that begin U+0080 to U+00BF and U+1000 to U+3FFF are none.
_BEGINS = np.isin(np.arange(256), [*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)])


#: The pattern whose matches are, but for endings after an apostrophe, runs of one class of characters with at most a space before them.
_BY_CLASS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Classes of bytes; 0 for those that do not tell.
_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE, _BREAK = range(1, 7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _SIGN
for _kind, _chars in ((_QUOTE, b"'"), (_SPACE, b" "), (_BREAK, b"\t\n\v\f\r"), (_DIGIT, range(48, 58)), (_LETTER, [*range(65, 91), *range(97, 123)])):
    _KINDS[list(_chars)] = _kind
#: For two classes, one after the other, whether a match must end between them: an apostrophe may be of one match with the signs
#: around it or the letters after it, and white space with anything after it.
_ENDS = np.zeros((8, 8), bool)
_ENDS[_LETTER : _QUOTE + 1, _LETTER : _BREAK + 1] = True
_ENDS[[_LETTER, _DIGIT, _SIGN, _QUOTE, _SIGN, _QUOTE, _QUOTE], [_LETTER, _DIGIT, _SIGN, _QUOTE, _QUOTE, _SIGN, _LETTER]] = False
_ENDS = _ENDS.ravel()


class PerfectHash:
    """A minimal perfect hash of byte strings: one bucket seed and one comparison per lookup.

    Keys fall into buckets by one half of their hash. From the largest bucket on, each
    gets the first seed that sends its keys to free places. The table has exactly as many
    places as keys.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // 3)
        members: dict[int, list[int]] = {}
        hashes = [xxh3_64_intdigest(key) for key in keys]
        for i, h in enumerate(hashes):
            members.setdefault((h >> 32) % self.buckets, []).append(i)
        self.seeds = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [0] * self.size
        for bucket in sorted(members, key=lambda b: (-len(members[b]), b)):
            own, seed = members[bucket], 0
            while True:
                places = {self._place(hashes[i], seed) for i in own}
                if len(places) == len(own) and all(self.keys[p] is None for p in places):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for i in own:
                place = self._place(hashes[i], seed)
                self.keys[place], self.values[place] = keys[i], i

    def _place(self, h: int, seed: int) -> int:
        x = ((h ^ (seed * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.size

    def get(self, key: bytes) -> int | None:
        """The index of the key among the keys, or None."""
        h = xxh3_64_intdigest(key)
        place = self._place(h, self.seeds[(h >> 32) % self.buckets])
        return self.values[place] if self.keys[place] == key else None


class ByteBpe:
    """Encoder and decoder for a file of ranks (base64 token and rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        self.whole = PerfectHash([token for token, _ in by_rank])
        self.rank_of_key = [rank for _, rank in by_rank]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: lowest-ranked pair first, leftmost among equals."""
        found = self.whole.get(piece)
        return [self.rank_of_key[found]] if found is not None else self._merge(piece)

    def _merge(self, piece: bytes) -> list[int]:
        """Parts are linked by where each ends and begins; the heap holds rank * n + start of each mergeable pair."""
        n, rank_of = len(piece), self.ranks.get
        end, begin = list(range(1, n + 1)), list(range(-1, n))
        pairs = [rank_of(piece[i : i + 2]) for i in range(n)]
        pairs[-1:] = [None] * (n > 0)
        heap = [rank * n + i for i, rank in enumerate(pairs) if rank is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            if pairs[i] != rank:
                continue  # one side has grown since
            j, k = end[i], end[end[i]]
            end[i], begin[k], pairs[j] = k, i, None
            pairs[i] = rank_of(piece[i : end[k]]) if k < n else None
            if pairs[i] is not None:
                heapq.heappush(heap, pairs[i] * n + i)
            if i:
                h = begin[i]
                pairs[h] = rank_of(piece[h:k])
                if pairs[h] is not None:
                    heapq.heappush(heap, pairs[h] * n + h)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids


class Remembered(dict):
    """What a function gave for short texts; a bounded memory that forgets what is not met again."""

    def __init__(self, compute: Callable[[str], bytes], size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size = compute, size
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(text)
        if ids is None:
            ids = self.compute(text)
        if len(text) <= 64:
            self[text] = ids
        return ids


def _cuts(raw: np.ndarray, edges: np.ndarray, by_class: bool = False) -> np.ndarray:
    """Where texts start and end, and places between where a match must start: the single spaces between two characters that
    are certainly none and, ``by_class``, where matches of ``_BY_CLASS`` end."""
    is_cut = np.zeros(len(raw) + 1, bool)
    is_cut[edges] = True
    last = raw[:-2]
    # classes tell enough of a space after other ASCII characters
    spaces = np.flatnonzero((raw[1:-1] == 32) & ((last > 0x7F) if by_class else (last > 0x20) & (last != 0x7F))) + 1
    spaces = spaces[_BEGINS[raw[spaces + 1]] & ~is_cut[spaces + 1]]
    beyond = raw[spaces - 1] > 0x7F
    # a character of n bytes begins n bytes before
    two, three, four = (raw[np.maximum(spaces - n, 0)] for n in (2, 3, 4))
    solid = ((two > 0xC2) & (two < 0xE0)) | ((three >= 0xE0) & (three < 0xF0) & _BEGINS[three]) | (four >= 0xF0)
    is_cut[spaces[solid | ~beyond]] = True
    if by_class:
        kind = _KINDS[raw]
        wide = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC5))  # U+00C0 to U+017F are letters but for two
        wide = wide[(raw[wide] > 0xC3) | ((raw[wide + 1] != 0x97) & (raw[wide + 1] != 0xB7))]
        kind[wide] = kind[wide + 1] = _LETTER
        is_cut[1:-1] |= _ENDS[kind[:-1] * 8 + kind[1:]]
        # a line break alone is a match; of more than one, the last would be
        breaks = np.flatnonzero(kind[1:-1] == _BREAK) + 1
        known = lambda x: (x >= _LETTER) & (x <= _QUOTE)
        is_cut[breaks[known(kind[breaks - 1]) & known(kind[breaks + 1])] + 1] = True
    return np.flatnonzero(is_cut)


class Stretches:
    """What a function gave for distinct short texts, as Arrow arrays; a bounded memory, of those met last."""

    def __init__(self, compute: Callable[[str], bytes], size: int = REMEMBERED):
        self.compute, self.size = compute, size
        self.texts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def ids_of(self, texts: pa.Array) -> pa.Array:
        at = pc.index_in(texts, value_set=self.texts)
        new, old = texts.filter(pc.is_null(at)), len(self.texts)
        places = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        places[places < 0] = np.arange(old, old + len(new))
        ids = pa.concat_arrays([self.ids, pa.array([self.compute(text) for text in new.to_pylist()], pa.large_binary())])
        if len(new):
            # what was met again goes before what is new, and that before the rest
            known = pa.concat_arrays([self.texts, new])
            met = np.zeros(old, bool)
            met[places[places < old]] = True
            order = np.concatenate([np.flatnonzero(met), np.arange(old, len(known)), np.flatnonzero(~met)])
            order = order[pc.less_equal(pc.binary_length(known), 64).to_numpy(zero_copy_only=False)[order]][: self.size]
            self.texts, self.ids = known.take(pa.array(order)), ids.take(pa.array(order))
        return ids.take(pa.array(places))


class TextEncoder:
    """A text to its ids as little-endian unsigned 32-bit numbers, each match of the pattern encoded separately.

    A space between two other characters must start a match, as in all patterns that take one space
    along with the word after it. So texts are cut there first, and a word met before is neither split
    nor encoded again.
    """

    def __init__(self, pattern: str, encode: Callable[[str], list[int]], remembered: int = REMEMBERED):
        self.split = regex.compile(pattern).findall
        self.by_class = pattern == _BY_CLASS
        self.pieces = Remembered(lambda piece: _bytes_of(encode(piece)), remembered)
        self.words = Remembered(lambda word: self._matches(" " + word), remembered)
        # stretches of a column; where classes cut, most are one match, which need not be remembered twice
        encoded = (lambda text: _bytes_of([x for piece in self.split(text) for x in encode(piece)])) if self.by_class else self._matches
        self.stretches = Stretches(encoded, remembered)

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def __call__(self, text: str | None) -> bytes:
        first, *words = _BETWEEN_WORDS.split(text or "")
        return self._matches(first) + b"".join(map(self.words.__getitem__, words))

    def of_column(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text. Some texts at a time are cut, Arrow finds the distinct stretches, and only new ones are encoded."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        done = 0
        while done < len(texts):
            upto = max(done + 1, int(np.searchsorted(edges, edges[done] + GROUPED, "right")) - 1)
            low, high = int(edges[done]), int(edges[upto])
            own, done = edges[done : upto + 1] - low, upto
            if low == high:
                yield from [b""] * (len(own) - 1)
                continue
            raw = data[low:high]
            cuts = _cuts(np.frombuffer(raw, np.uint8), own, self.by_class)
            cut = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), raw]).dictionary_encode()
            _, starts, found = self.stretches.ids_of(cut.dictionary).take(cut.indices).buffers()
            bounds = np.frombuffer(starts, np.int64)[np.searchsorted(cuts, own)].tolist()
            found = memoryview(found) if found else b""
            yield from (bytes(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def _bytes_of(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if numbers.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, "<u4").tobytes()
    return numbers.tobytes()


@cache
def _bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@cache
def _encoder(path: str, pattern: str) -> TextEncoder:
    """One per worker process: what one task has met helps the next."""
    bpe = _bpe(path)
    return TextEncoder(pattern, lambda piece: bpe.encode(piece.encode()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids``, the little-endian unsigned 32-bit ids of the whole text.

    Each match of the pattern is encoded separately. Works row by row, so nothing is
    shuffled and a lost task repeats alone. Null and empty texts have no ids; null and
    repeated doc_ids are kept as they come; other columns are not looked at.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = _encoder(ranks_path, pattern)
        for batch in batches:
            ids = [encode_text(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``ids`` back to ``bytes``; the other columns are kept. Null ids stay null, an unknown id is an error."""
    others = [c for c in encoded.columns if c not in ("ids", "bytes")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _bpe(ranks_path).tokens.__getitem__
        for batch in batches:
            column = batch.column(batch.schema.names.index("ids"))
            texts = [b"".join(map(token, np.frombuffer(x.as_py(), "<u4").tolist())) if x.is_valid else None for x in column]
            kept = [batch.column(batch.schema.names.index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, column, pa.array(texts, pa.binary())], [*others, "ids", "bytes"])

    from pyspark.sql.types import BinaryType, StructField, StructType

    fields = [encoded.schema[c] for c in others]
    binary = [StructField("ids", BinaryType()), StructField("bytes", BinaryType())]
    return encoded.mapInArrow(decode, StructType([*fields, *binary]))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token counts with digests of the ids and of the bytes they decode to, text and ids staying in the task.

    The same as decoding what ``encode_documents`` gives; see there for odd rows.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text, token = _encoder(ranks_path, pattern), _bpe(ranks_path).tokens.__getitem__
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = encode_text(text.as_py())
                decoded = b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            types = [pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        both, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
