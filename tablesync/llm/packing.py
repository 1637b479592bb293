"""Best-fit packing of token pieces under several capacities at once."""

from __future__ import annotations

import binascii
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.byte_bpe import REMEMBERED, TextEncoder
from tablesync.llm.words import keyed, public_id, written

#: Rows that one task numbers, on average, inside a length and salt.
NUMBERED_TOGETHER = 20_000


@dataclass(frozen=True)
class Capacities:
    """What a sequence may hold: tokens, pieces, and attention cost (the sum of squared lengths).

    By default only the tokens bind: no more than ``tokens`` pieces of a token fit, and
    squares of lengths sum to at most the square of their sum.
    """

    tokens: int = 2048
    pieces: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    choose: str = "norm"  # or "dot"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.pieces or self.tokens, self.attention or self.tokens**2], np.int64)


def plan_bins(counts: dict[int, int], capacities: Capacities) -> list[tuple[int, int, int, int, int]]:
    """Vector best fit over the counts of each length, longest first.

    All pieces of a length are alike, and so are all sequences with the same residual
    capacities. A class of sequences is therefore chosen once for as many pieces as it has
    sequences: the work depends on the distinct lengths (``tokens`` at most), not on the number
    of pieces. Of the classes a piece fits into under every capacity, ``norm`` takes the least weighted
    residual left over and ``dot`` the greatest weighted product of piece and residual.

    Gives rows (length, first, count, sequence, offset): of the pieces of that length,
    numbered from 0, ``count`` from ``first`` on go to consecutive sequences from
    ``sequence`` on, each at ``offset``.
    """
    full = capacities.vector()
    weights = np.array(capacities.weights) / full
    longest = max(counts, default=0)
    if longest and np.any(np.array([longest, 1, longest**2]) > full):
        raise ValueError(f"a piece of {longest} tokens does not fit an empty sequence of {capacities}")
    residual = np.empty((0, 3), np.int64)  # of each class of sequences that still has room
    ranges: list[list[tuple[int, int]]] = []  # the sequences of each class, as (first, count)
    place: dict[tuple[int, ...], int] = {}
    opened, rows, shortest = 0, [], min(counts, default=0)

    def add(state: np.ndarray, part: list[tuple[int, int]]) -> None:
        nonlocal residual
        key = tuple(state.tolist())
        if state[0] < shortest:
            return
        if key not in place:
            place[key] = len(ranges)
            ranges.append([])
            if len(ranges) > len(residual):
                residual = np.concatenate([residual, np.full((max(64, len(residual)), 3), -1)])
        residual[place[key]] = state
        ranges[place[key]].extend(part)

    for length in sorted(counts, reverse=True):
        item, left, first = np.array([length, 1, length**2]), counts[length], 0
        while left:
            fits = np.flatnonzero((residual >= item).all(axis=1))
            if not len(fits):
                # as many new sequences as the rest needs, with one piece of this length each so far
                number = -(-left // int((full // item).min()))
                rows.append((length, first, number, opened, 0))
                add(full - item, [(opened, number)])
                opened, first, left = opened + number, first + number, left - number
                continue
            if capacities.choose == "norm":
                score = (((residual[fits] - item) * weights) ** 2).sum(axis=1)
            else:
                score = -(residual[fits] * item * weights**2).sum(axis=1)
            best = int(fits[np.argmin(score)])
            state, offset, moved = residual[best] - item, int(full[0] - residual[best][0]), []
            while left and ranges[best]:
                start, count = ranges[best].pop()
                taken = min(left, count)
                rows.append((length, first, taken, start, offset))
                moved.append((start, taken))
                if taken < count:
                    ranges[best].append((start + taken, count - taken))
                first, left = first + taken, left - taken
            if not ranges[best]:
                residual[best] = -1
            add(state, moved)
    return rows


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacities: Capacities) -> DataFrame:
    """``pieces`` (id, piece, length and any others) with ``sequence_id`` and ``offset``.

    Only the counts by length reach the driver. A piece's number among those of its length
    comes from a salted count: prefix sums over the salts of a length, then a numbering inside
    each salt, so that a length which a third of all pieces have is numbered by many tasks.
    """
    rows = written(spark, pieces.withColumn("read_at", F.monotonically_increasing_id()), "packing-pieces")
    salts = max(1, -(-rows.count() // NUMBERED_TOGETHER))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("read_at"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = written(spark, counts, "packing-counts")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_bins(by_length, capacities)
    planned = spark.createDataFrame(plan, "length long, first long, count long, sequence long, offset long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("read_at")
    numbered = salted.withColumn("number", F.row_number().over(inside) - 1).join(starts, ["length", "salt"])
    numbered = numbered.withColumn("number", F.col("number") + F.col("base")).drop("base", "salt")
    inside_range = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("count"))
    placed = numbered.join(planned, "length").where(inside_range)
    return placed.select(
        *pieces.columns, (F.col("sequence") + F.col("number") - F.col("first")).alias("sequence_id"), "offset"
    )


class LibraryEncoder(TextEncoder):
    """A tokenizer of the library, pre-token by pre-token; a text with an added token goes to the library whole."""

    def __init__(self, path: str, pattern: str, remembered: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        self.encode_whole = encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        encode_piece = encode
        if tokenizer.normalizer is None and isinstance(tokenizer.pre_tokenizer, ByteLevel):
            # a pre-token goes to the library's model straight, in the letters that byte-level vocabularies use
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in plain]
            letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
            tokenize = tokenizer.model.tokenize
            encode_piece = lambda piece: [t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))]
        super().__init__(pattern, encode_piece, remembered)

    def __call__(self, text: str | None) -> bytes:
        # the library looks for added tokens in the whole text before it splits it
        whole = text and any(token in text for token in self.added)
        return np.array(self.encode_whole(text), "<u4").tobytes() if whole else super().__call__(text)

    def of_column(self, texts: pa.Array) -> Iterator[bytes]:
        texts, none = pc.fill_null(texts, ""), pa.scalar("", texts.type)
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        others = pc.if_else(pa.array(whole), none, texts) if whole.any() else texts
        for i, ids in enumerate(super().of_column(others)):
            yield self(texts[i].as_py()) if whole[i] else ids


@cache
def _encoder(path: str, pattern: str, remembered: int = REMEMBERED) -> LibraryEncoder:
    """One per worker process: what one task has met helps the next."""
    return LibraryEncoder(path, pattern, remembered)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, pattern: str, tokens: int, end_id: int = 0, remembered: int = REMEMBERED
) -> DataFrame:
    """One row per piece of at most ``tokens`` ids: id, piece, start, length, ids_crc32.

    A document is its text's ids and ``end_id``; null counts as empty. If it is longer than
    ``tokens`` it is cut so that all pieces but the first are full. The tokenizer sees each
    pre-token of the pattern alone, which it would cut out itself, so words met before need not be
    tokenized again; ``remembered`` bounds how many a worker keeps. A text with an added token of the tokenizer goes to it whole.
    """
    names = ["id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, pattern, remembered)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encoder.of_column(batch.column(1)), strict=True):
                ids += end
                n = len(ids) // 4
                start, stop, piece = 0, n % tokens or tokens, 0
                while start < n:
                    rows.append((key, piece, start, stop - start, binascii.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + tokens, piece + 1
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select("id", "text").mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long")


def op5_best_fit_packing(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    capacities: Capacities | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """All documents packed into sequences; one row per piece.

    Null texts are packed as empty ones (the end id alone), null doc_ids are kept, rows that repeat
    are packed each on their own, an empty table gives no rows, and other columns are
    not looked at.
    """
    capacities = capacities or Capacities()
    pieces = token_pieces(keyed(docs), tokenizer_path, pattern, capacities.tokens, remembered=remembered)
    packed = pack_pieces(spark, pieces, capacities)
    return packed.select(public_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
