"""Interpolated modified Kneser-Ney model: counted in Spark, kept as sorted hash arrays, mapped by workers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tablesync.llm.words import keyed, mixed, public_id, signed, word_hashes, written
from tablesync.storage import qualified, shared_dir

#: Grams that a task keeps before it sorts, adds up and hands them on.
HELD = 1 << 20
#: Bytes of text whose tokens are cut and looked up together; a longer text is a group of its own.
GROUPED = 1 << 21
#: Occurrences of grams in one file of the model, on average.
PER_SHARD = 1 << 20
END = np.uint64(xxh3_64_intdigest(b"end of document"))
START = np.uint64(xxh3_64_intdigest(b"start of document"))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Words of more bytes are hashed one by one.
_SHORT = 64
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def tokens_of(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words and the one end. No word's hash equals those of end and start but by chance."""
    return next(groups_of(pa.array([text], pa.string())))[0]


def gram_of(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The hash of each token with the one before it."""
    return mixed(before * _PAIR + tokens)


def _hashes(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each stretch of ``raw``, of eight bytes at a time; words of up to eight bytes and one length never share one."""
    padded = np.frombuffer(raw + bytes(8), np.uint8)
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    size = end - begin
    hashes = mixed(size.astype(np.uint64) * _PAIR ^ (eight[begin] & _FIRST_BYTES[np.minimum(size, 8)]))
    at, rest = 8, np.flatnonzero((size > 8) & (size <= _SHORT))
    while len(rest):
        more = eight[begin[rest] + at] & _FIRST_BYTES[np.minimum(size[rest] - at, 8)]
        hashes[rest] = mixed(hashes[rest] ^ more)
        at += 8
        rest = rest[size[rest] > at]
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        hashes[long] = word_hashes([raw[a:b] for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True)])
    return hashes


def groups_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens, the tokens before them and where documents start, for some documents at a time.

    What is looked up for a group is sorted, so the arrays of the model are read in long runs.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    done = 0
    while done < len(texts):
        upto = max(done + 1, int(np.searchsorted(edges, edges[done] + GROUPED, "right")) - 1)
        low, high = int(edges[done]), int(edges[upto])
        # white space and bytes beyond ASCII do not change, so the texts can be lowered before they are split
        raw = data[low:high].to_pybytes().translate(_LOWER) if high > low else b""
        cuts = edges[done : upto + 1] - low
        inside = ~_IS_SPACE[np.frombuffer(raw, np.uint8)]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        bounds = cuts[1:-1]
        bounds = bounds[(bounds > 0) & (bounds < len(raw))]
        first[bounds], last[bounds - 1] = inside[bounds], inside[bounds - 1]  # no word reaches into the next text
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.searchsorted(begin, cuts[1:]) + np.arange(upto - done)
        tokens = np.empty(len(begin) + len(ends), np.uint64)
        is_word = np.ones(len(tokens), bool)
        is_word[ends] = False
        tokens[is_word], tokens[ends] = _hashes(raw, begin, end), END
        starts = np.append(0, ends[:-1] + 1)
        before = np.append(START, tokens[:-1])
        before[starts] = START
        yield tokens, before, starts
        done = upto


def coded(tokens: np.ndarray, before: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a group of documents: its sorted distinct words, and each token and the one before it as a place among them."""
    words, own = np.unique(np.append(tokens, START), return_inverse=True)
    context = np.append(own[-1], own[:-2])
    context[starts] = own[-1]
    return words, own[:-1], context


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of hashes, a power of two of them."""
    bits = shards.bit_length() - 1
    return (grams >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(grams), np.int32)


def _added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    return keys[starts], *[np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values]


class _Sums:
    """Sums by key over the documents of a task, handed on when there are too many."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = self.kept = 0

    def add(self, *columns: np.ndarray) -> tuple[np.ndarray, ...] | None:
        self.parts.append(columns)
        self.held += len(columns[0])
        # what stays distinct after adding up must not be sorted again for each document
        return self.take() if self.held >= max(HELD, 2 * self.kept) else None

    def take(self) -> tuple[np.ndarray, ...] | None:
        if not self.parts:
            return None
        summed = _added(*[np.concatenate(c) for c in zip(*self.parts, strict=True)])
        self.kept = len(summed[0])
        if self.kept >= HELD // 2:
            self.parts, self.held, self.kept = [], 0, 0
            return summed
        self.parts, self.held = [summed], self.kept
        return None

    def rest(self) -> tuple[np.ndarray, ...] | None:
        return _added(*[np.concatenate(c) for c in zip(*self.parts, strict=True)]) if self.parts else None


def _summed(rows_of, names: list[str], types: list[pa.DataType]):
    """A task that adds up the rows of its documents by their first column."""

    def batch_of(columns):
        first, *rest = columns
        arrays = [pa.array(signed(first)), *[pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(rest, types[1:], strict=True)]]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(batch_of, _sums_of(batches, rows_of))

    return run


def _sums_of(batches: Iterator[pa.RecordBatch], rows_of) -> Iterator[tuple[np.ndarray, ...]]:
    sums = _Sums()
    for batch in batches:
        for group in groups_of(batch.column(0)):
            if (full := sums.add(*rows_of(*group))) is not None:
                yield full
    if (last := sums.rest()) is not None:
        yield last


def _grams_once(tokens: np.ndarray, before: np.ndarray, _starts: np.ndarray):
    return gram_of(before, tokens), np.ones(len(tokens), np.int64)


def _packed(shards: int):
    """A task that adds up its grams and gives those of a shard as one row: grams met once here, then the others and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _sums_of(batches, _grams_once):
            many = counts > 1
            once, more, counts = keys[~many], keys[many], counts[many]
            places = np.arange(shards + 1)
            of_once, of_more = (np.searchsorted(shard_of(x, shards), places).tolist() for x in (once, more))
            met = [i for i in range(shards) if of_once[i] < of_once[i + 1] or of_more[i] < of_more[i + 1]]
            cut = lambda x, at: pa.array([x[at[i] : at[i + 1]].tobytes() for i in met], pa.binary())  # noqa: E731, B023
            columns = [pa.array(met, pa.int32()), cut(once, of_once), cut(more, of_more), cut(counts, of_more)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "once", "more", "counts"])

    return run


def _write_shard(folder: str):
    """Write the grams of a shard as sorted arrays; give how many grams have each low count."""

    def run(table: pa.Table) -> pa.Table:
        once, more, n = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)])
            for c, kind in (("once", np.uint64), ("more", np.uint64), ("counts", np.int64))
        )
        keys, counts = _added(np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), n]))
        many = counts > 1
        # most grams occur once: for them the key says it all
        arrays = [keys[~many], keys[many], counts[many].astype(np.int64)]
        name = f"grams-{uuid4().hex}"  # a repeated task writes its own file; only one name is kept
        fs, path = pa.fs.FileSystem.from_uri(f"{folder}/{name}")
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path) as out:
            for a in arrays:
                out.write(a.tobytes())
        of_count = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "name": [name],
            "once": pa.array([len(arrays[0])], pa.int64()), "more": pa.array([len(arrays[1])], pa.int64()),
            **{f"n{i}": pa.array([v], pa.int64()) for i, v in zip((1, 2, 3, 4), of_count, strict=True)},
        })

    return run


def _mapped(folder: str, name: str, size: int) -> np.ndarray:
    """The bytes of a model file, memory-mapped. A file on a remote store is first copied to a local
    one without a name, which the system removes with the last process that uses it."""
    if not size:
        return np.empty(0, np.uint8)
    fs, path = pa.fs.FileSystem.from_uri(f"{folder}/{name}")
    if isinstance(fs, pa.fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as local, fs.open_input_stream(path) as remote:
        while chunk := remote.read(1 << 22):
            local.write(chunk)
        local.flush()
        return np.memmap(local, np.uint8, "r")


@dataclass(frozen=True)
class Model:
    """Where the arrays lie and the few numbers of the model. This is all that is sent to tasks."""

    folder: str
    shards: tuple[tuple[str, int, int], ...]  # file, grams met once, grams met more often
    words: tuple[tuple[str, int], ...]  # file, words; empty while only grams are counted
    discounts: tuple[float, float, float]
    unigram_spare: float  # the share of grams that discounts take from the words
    tokens: int
    vocabulary: int
    gram_kinds: int

    def counts(self, grams: np.ndarray, trained: bool = False) -> np.ndarray:
        """How often training met each gram; ``trained`` if it has met them all, so that those not met often were met once."""
        order = np.argsort(grams)
        wanted = grams[order]
        found = np.ones(len(wanted), np.int64) if trained else np.zeros(len(wanted), np.int64)
        edges = np.searchsorted(shard_of(wanted, len(self.shards)), np.arange(len(self.shards) + 1))
        for shard, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if a < b:
                once, more, counts = _grams_of(self.folder, *self.shards[shard])
                at, hit = _places(more, wanted[a:b])
                found[a:b][hit] = counts[at[hit]]
                if not trained:
                    rest = np.flatnonzero(~hit) + a
                    found[rest] = _places(once, wanted[rest])[1]
        out = np.empty_like(found)
        out[order] = found
        return out

    def of_words(self, words: np.ndarray) -> np.ndarray:
        """Per sorted word a row (count, probability, followers' total, weight of backing off); zeros for unknown ones."""
        out = np.zeros((len(words), 4))
        edges = np.searchsorted(shard_of(words, len(self.words)), np.arange(len(self.words) + 1))
        for shard, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if a < b:
                keys, values = _words_of(self.folder, *self.words[shard])
                at, hit = _places(keys, words[a:b])
                out[a:b][hit] = values[at[hit]]
        return out


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key would stand among sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@lru_cache(maxsize=4096)
def _grams_of(folder: str, name: str, once: int, more: int):
    raw = _mapped(folder, name, 8 * (once + 2 * more))
    cuts = np.cumsum([0, once, more, more]) * 8
    first, second, third = (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    return first.view(np.uint64), second.view(np.uint64), third.view(np.int64)


@lru_cache(maxsize=4096)
def _words_of(folder: str, name: str, n: int):
    raw = _mapped(folder, name, 40 * n)
    return raw[: 8 * n].view(np.uint64), raw[8 * n :].view(np.float64).reshape(n, 4)


def discounts_of(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from the numbers of grams met once to four times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not (n1 and n2):  # too few grams to tell, e.g. none repeats
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    limits = (1.0, 2.0, 3.0)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0)
    return tuple(float(min(max(x, 0.05), limit - 0.05)) for x, limit in zip(raw, limits, strict=True))


def _discount(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3)]


def _write_words(folder: str, discounts, unigram_discounts, unigram_spare: float, kinds: int, vocabulary: int):
    def run(table: pa.Table) -> pa.Table:
        get = lambda c: table.column(c).to_numpy()
        keys = get("word").view(np.uint64)
        order = np.argsort(keys)
        followed = np.stack([np.rint(get(c)) for c in ("once", "twice", "more")])
        total = get("followed")
        weight = np.divide(np.array(discounts) @ followed, total, out=np.ones(len(total)), where=total > 0)
        contexts = np.rint(get("contexts")).astype(np.int64)
        known = (contexts - _discount(contexts, unigram_discounts)) / max(kinds, 1)
        probability = known + unigram_spare / (vocabulary + 1)
        values = np.stack([get("n").astype(float), probability, total.astype(float), weight], axis=1)[order]
        name = f"words-{uuid4().hex}"
        fs, path = pa.fs.FileSystem.from_uri(f"{folder}/{name}")
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path) as out:
            out.write(keys[order].tobytes())
            out.write(np.ascontiguousarray(values).tobytes())
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "name": [name], "words": pa.array([len(keys)], pa.int64())})

    return run


def _power_of_two(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def _shard(col: str, shards: int):
    bits = shards.bit_length() - 1
    return (F.shiftrightunsigned(F.col(col), 64 - bits) if bits else F.lit(0)).cast("int")


def train(spark: SparkSession, texts: DataFrame) -> Model:
    """Count a bigram model over the column ``text``; every row counts.

    1. Words: tasks add up their own counts, Spark adds those of a word.
    2. Grams (a token with the one before it): the same, by ranges of hashes. The task that
       has a range writes it to the shared folder as sorted arrays. A frequent gram
       arrives as one row per task that met it.
    3. The followers of a word and the words before one are kinds of grams. A second pass over the
       texts adds 1 / count for each gram met, which makes 1 for each kind, so that
       no table of grams has to be joined.

    Hashes have 64 bits: among 10**9 words or grams two collide once in about 37 such corpora.
    """
    folder = qualified(spark, shared_dir(spark, "kneser-ney"))
    texts = texts.select("text")

    def words_once(tokens: np.ndarray, _before: np.ndarray, _starts: np.ndarray):
        return np.unique(tokens, return_counts=True)

    unigrams = texts.mapInArrow(_summed(words_once, ["word", "n"], [pa.int64(), pa.int64()]), "word long, n long")
    unigrams = written(spark, unigrams.groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    totals = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, vocabulary = totals["n"], totals["v"]
    shards = _power_of_two(-(-tokens // PER_SHARD) or 1)

    grams = texts.mapInArrow(_packed(shards), "shard int, once binary, more binary, counts binary").repartition(shards, "shard")
    files = grams.groupBy("shard").applyInArrow(
        _write_shard(f"{folder}/grams"),
        "shard int, name string, once long, more long, n1 long, n2 long, n3 long, n4 long",
    )
    # one short row per file, a million grams each
    manifest = {r["shard"]: r for r in written(spark, files, "gram-files").collect()}
    rows = [manifest.get(i) for i in range(shards)]
    kinds = sum(r["once"] + r["more"] for r in rows if r)
    discounts = discounts_of([sum(r[f"n{i}"] for r in rows if r) for i in (1, 2, 3, 4)])
    arrays = tuple((r["name"], r["once"], r["more"]) if r else ("", 0, 0) for r in rows)
    counted = Model(f"{folder}/grams", arrays, (), discounts, 0.0, tokens, vocabulary, kinds)

    def kinds_of(tokens: np.ndarray, before: np.ndarray, starts: np.ndarray):
        count = counted.counts(gram_of(before, tokens), trained=True)
        share = 1.0 / count
        words, own, context = coded(tokens, before, starts)
        added = lambda at, values=None: np.bincount(at, values, len(words))
        met = [added(context[chosen], share[chosen]) for chosen in map(np.flatnonzero, (count == 1, count == 2, count > 2))]
        return words, added(own, share), *met, added(context).astype(float)

    names = ["word", "contexts", "once", "twice", "more", "followed"]
    kinds_task = _summed(kinds_of, names, [pa.int64()] + [pa.float64()] * 5)
    stats = texts.mapInArrow(kinds_task, "word long, " + ", ".join(f"{c} double" for c in names[1:]))
    stats = stats.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])
    stats = stats.join(unigrams, "word", "left").fillna(0, ["n"])  # the start is no token
    stats = written(spark, stats, "word-statistics")
    single = F.round(F.col("contexts").cast("decimal(20,4)"))
    few = stats.agg(*[F.count_if(single == i) for i in (1, 2, 3, 4)], F.count_if(single > 2)).first()
    unigram_discounts = discounts_of(list(few[:4]))
    unigram_spare = float(np.dot(unigram_discounts, [few[0], few[1], few[4]])) / max(kinds, 1)
    word_shards = _power_of_two(-(-vocabulary // PER_SHARD) or 1)
    word_files = stats.withColumn("shard", _shard("word", word_shards)).groupBy("shard").applyInArrow(
        _write_words(f"{folder}/grams", discounts, unigram_discounts, unigram_spare, kinds, vocabulary),
        "shard int, name string, words long",
    )
    found = {r["shard"]: r for r in written(spark, word_files, "word-files").collect()}
    words = tuple((found[i]["name"], found[i]["words"]) if i in found else ("", 0) for i in range(word_shards))
    return Model(f"{folder}/grams", arrays, words, discounts, unigram_spare, tokens, vocabulary, kinds)


def op7_kneser_ney(spark: SparkSession, docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Score all documents by a model of those whose crc32(doc_id) mod ``folds`` is not ``held_out``.

    A null text is empty and so has one token, its end. A null doc_id hashes as the empty text.
    Rows that repeat count, and are scored, as often as they occur. Without any training document each
    word has probability 1 / (vocabulary + 1) = 1. An empty table gives no rows; other columns
    are not looked at.
    """
    number = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    rows = keyed(docs, (number % folds == held_out).alias("held_out"))
    model = train(spark, rows.where("NOT held_out"))
    names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [_scores(model, tokens, before, *coded(tokens, before, starts), starts) for tokens, before, starts in groups_of(batch.column(1))]
            if not scores:
                continue
            arrays = [pa.array(np.concatenate(c)) for c in zip(*scores, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], names)

    scored = rows.select("id", "text", "held_out").mapInArrow(
        run, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        public_id(), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _scored_together(
    model: Model, tokens: np.ndarray, before: np.ndarray, starts: np.ndarray
) -> list[tuple[int, int, float, float]]:
    """(tokens, known ones, base score, score) of each document of a group, whatever tokens come before."""
    words, places = np.unique(np.concatenate([tokens, before]), return_inverse=True)
    columns = _scores(model, tokens, before, words, places[: len(tokens)], places[len(tokens) :], starts)
    return list(zip(*[c.tolist() for c in columns], strict=True))


def _scores(
    model: Model, tokens: np.ndarray, before: np.ndarray, words: np.ndarray, own: np.ndarray, context: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The columns of ``_scored_together``; ``own`` and ``context`` are the places of the tokens and of those before them among the words."""
    of_word = model.of_words(words)
    known = of_word[:, 0] > 0
    spare = model.unigram_spare / (model.vocabulary + 1)
    lower = np.where(known, of_word[:, 1], spare if model.gram_kinds else 1.0)
    base = np.log10((of_word[:, 0] + 1) / (model.tokens + model.vocabulary + 1))
    count = model.counts(gram_of(before, tokens))
    total, weight = of_word[context, 2], np.where(of_word[:, 2] > 0, of_word[:, 3], 1.0)[context]
    higher = np.divide(
        np.maximum(count - _discount(count, model.discounts), 0), total, out=np.zeros(len(tokens)), where=total > 0
    )
    score = np.log10(higher + weight * lower[own])
    sizes = np.diff(np.append(starts, len(tokens)))
    return sizes, np.add.reduceat(known[own].astype(np.int64), starts), np.add.reduceat(base[own], starts), np.add.reduceat(score, starts)
