"""Near copies by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh3_64_intdigest

from tablesync.llm.components import components
from tablesync.llm.words import gram_hashes, mixed, row_keyed, signed, with_doc_id, written

#: Distinct words whose counts a task holds before it hands them on.
HELD_WORDS = 200_000
#: Shingles that are sampled at once, so few that their numbers stay in a core's cache.
DRAWN = 512
#: Features that are compared at once.
SAMPLED = 4_096
#: Texts of one block; two blocks of a bucket are compared in one task.
BLOCK = 512


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; ``bands`` of ``rows`` samples each; links of ``similarity`` or more.

    Two texts of weighted Jaccard similarity s share a band with probability 1 - (1 - s**rows)**bands:
    0.9974 at 0.8 and 0.99998 at 0.9 by default. A word in fewer than one of ``rarest`` documents
    weighs like one in exactly so many.
    """

    words: int = 5
    bands: int = 12
    rows: int = 4
    similarity: float = 0.8
    rarest: int = 1000


def normal_words(text: str | None) -> list[bytes]:
    return text.lower().encode().split() if text else []


def document_frequencies(docs: DataFrame) -> DataFrame:
    """word and df, the number of documents with it, over all documents. Tasks add up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def batch_of():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                counts.update(set(normal_words(text.as_py())))
                if len(counts) > HELD_WORDS:
                    yield batch_of()
                    counts.clear()
        yield batch_of()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("df"))


@dataclass(frozen=True)
class Weights:
    """The inverse document frequency of words; a shingle's is the sum over its words.

    That sum is what log(documents / documents with the shingle) would be were its words
    independent. Only words in one of ``rarest`` documents or more have an entry: there are
    no more of them than ``rarest`` times the mean number of distinct words of a document,
    however many documents there are. All others share the ceiling.
    """

    idf: dict[bytes, float]
    ceiling: float
    settings: Settings = field(default_factory=Settings)

    def shingles(self, text: str | None, with_counts: bool = False) -> tuple[np.ndarray, ...]:
        """Distinct shingle hashes, ascending, and their weights tf * idf. A text of fewer words is one shingle."""
        words = normal_words(text)
        if not words:
            return (np.empty(0, np.uint64), np.empty(0), np.empty(0))[: 2 + with_counts]
        k = min(self.settings.words, len(words))
        hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        idf = np.array([self.idf.get(w, self.ceiling) for w in words])
        grams = gram_hashes(hashes, k)
        sums = np.convolve(idf, np.ones(k), "valid")
        distinct, first, tf = np.unique(grams, return_index=True, return_counts=True)
        return (distinct, sums[first] * tf, tf)[: 2 + with_counts]


def weigh(docs: DataFrame, settings: Settings) -> Weights:
    n = docs.count()
    least = max(1, math.ceil(n / settings.rarest))
    common = document_frequencies(docs).where(F.col("df") >= least).collect()  # bounded, see Weights
    rate = lambda df: 1 + math.log(max(n, 1) / max(df, n / settings.rarest, 1e-9))
    return Weights({bytes(r["word"]): rate(r["df"]) for r in common}, rate(0), settings)


def _uniforms(x: np.ndarray) -> np.ndarray:
    """Two numbers between 0 and 1, both excluded, from each 64-bit hash: along the last axis, in turn."""
    u = x.view(np.int32).astype(np.float32)
    u *= np.float32((1 - 2.0**-20) / 2**32)
    u += np.float32(0.5)
    return u


def signature(shingles: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """``size`` consistent weighted samples, each hashed from the shingle drawn and its level.

    Per sample and shingle, r and c are Gamma(2, 1) and b is uniform, all from the shingle's hash;
    the level is t = floor(ln(weight) / r + b) and the shingle with the least ln(c) - r (t - b + 1) is drawn.
    Two texts draw the same shingle and level with the probability of their weighted Jaccard similarity.
    """
    seeds = mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    best = np.full(size, np.inf, np.float32)
    drawn = np.zeros(size, np.uint64)
    rows = np.arange(size)
    logs = np.log(weights).astype(np.float32)
    for start in range(0, len(shingles), DRAWN):
        part = shingles[start : start + DRAWN]
        x = mixed(part ^ seeds)
        y = x * np.uint64(0xD6E8FEB86659FD93)
        y ^= y >> np.uint64(32)
        z = y * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(32)
        u, v, b = _uniforms(x), _uniforms(y), _uniforms(z)[:, ::2]
        r = -np.log(u[:, ::2] * u[:, 1::2])
        c = np.log(-np.log(v[:, ::2] * v[:, 1::2]))
        t = np.floor(logs[start : start + DRAWN] / r + b)
        a = c - r * (t - b + 1)
        at = a.argmin(axis=1)
        value = a[rows, at]
        better = value < best
        best = np.where(better, value, best)
        level = t[rows, at].astype(np.int64).view(np.uint64)
        drawn = np.where(better, mixed(part[at] + mixed(level)), drawn)
    return drawn


def band_hashes(samples: np.ndarray, settings: Settings) -> np.ndarray:
    rows = samples.reshape(settings.bands, settings.rows)
    total = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for i in range(settings.rows):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return total


def _signed_texts(weights: Weights):
    settings = weights.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, bands = [], []
            for text in batch.column(1):
                words = normal_words(text.as_py())
                copies.append(xxh3_128_digest(b" ".join(words)) if words else None)
                shingles, weight = weights.shingles(text.as_py())
                own = band_hashes(signature(shingles, weight, settings.bands * settings.rows), settings) if words else ()
                bands.append(signed(own) if words else own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(copies, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "copy", "bands"],
            )

    return run


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][i], b[1][j]).sum())
    whole = float(a[1].sum() + b[1].sum()) - shared
    return shared / whole if whole else 0.0


def _verified(texts: DataFrame, pairs: DataFrame, weights: Weights) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough. Texts meet by two joins, rows of b by those of a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, vector = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(len(a)):
                if a[i] != last:
                    last, vector = a[i], weights.shingles(batch.column(2)[i].as_py())
                other = weights.shingles(batch.column(3)[i].as_py())
                keep.append(weighted_jaccard(vector, other) >= weights.settings.similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    firsts = pairs.groupBy("b").agg(F.collect_set("a").alias("firsts"))
    of_b = texts.join(firsts.withColumnRenamed("b", "id"), "id").select(
        F.explode("firsts").alias("a"), F.col("id").alias("b"), F.col("text").alias("text_b")
    )
    both = of_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _same_bucket(weights: Weights):
    """Weighted Jaccard similarity of all texts of one or two blocks of a bucket, by one matrix product.

    A shingle that occurs n times is n features of its weight; the weight that two texts share is the sum
    over the features both have. Given are links to the least id each can be reached from, one per text.
    """

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        texts = [weights.shingles(t.as_py(), with_counts=True) for t in table.column("text")]
        features, values, owner = [], [], []
        for i, (shingles, weight, tf) in enumerate(texts):
            for level in range(int(tf.max(initial=0))):
                more = tf > level
                features.append(mixed(shingles[more] + np.uint64(level)))
                values.append((weight / tf)[more])
                owner.append(np.full(int(more.sum()), i))
        features, values, owner = (np.concatenate(x) for x in (features, values, owner))
        total = np.bincount(owner, values, len(ids))
        _, first, place, times = np.unique(features, return_index=True, return_inverse=True, return_counts=True)
        column = np.cumsum(times > 1) - 1  # what only one text has is not shared
        use = times[place] > 1
        owner, place, root = owner[use], column[place[use]], np.sqrt(values[first][times > 1])
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        shared = np.zeros((len(ids), len(ids)))
        for start in range(0, len(root), SAMPLED):
            a, b = np.searchsorted(place, [start, start + SAMPLED])
            part = np.zeros((len(ids), min(SAMPLED, len(root) - start)))
            part[owner[a:b], place[a:b] - start] = root[place[a:b]]
            shared += part @ part.T
        linked = shared >= weights.settings.similarity * (total[:, None] + total[None, :] - shared) - 1e-9
        least = ids.copy()
        while True:
            near = np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1)
            if (near >= least).all():
                break
            least = np.minimum(near, least)
        found = least != ids
        return pa.table({"a": least[found], "b": ids[found]})

    return run


def _open_buckets(texts: DataFrame, buckets: DataFrame, weights: Weights) -> DataFrame:
    """Links among the texts of each bucket that are not one class yet, compared in blocks of bounded size.

    The members of a bucket's largest class need no comparison with each other. The others, mostly
    few, are compared with every text of the bucket: blocks of others meet each other and each block of that class.
    ``buckets`` has band, hash, id and class_id. No pairs are handed on but those that link.
    """
    sides = buckets.groupBy("band", "hash", "class_id").agg(F.count("*").alias("n"))
    main = sides.groupBy("band", "hash").agg(
        F.max_by("class_id", F.struct("n", "class_id")).alias("main"),
        F.ceil(F.max("n") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK).cast("int").alias("other_blocks"),
    )
    placed = buckets.join(main, ["band", "hash"]).withColumn("outside", F.col("class_id") != F.col("main"))
    spread = F.xxhash64("id")
    block = F.when(F.col("outside"), F.pmod(spread, F.col("other_blocks"))).otherwise(
        F.col("other_blocks") + F.pmod(spread, F.col("main_blocks"))
    )
    placed = placed.withColumn("block", block.cast("int"))
    # the others come before the blocks of the largest class, so the lesser block of a task is always one of theirs
    last = F.col("other_blocks") + F.when(F.col("outside"), F.col("main_blocks")).otherwise(0) - 1
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last))).where("block <> other")
    keys = ["band", "hash", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    met = met.select("id", *keys).join(texts, "id")
    return met.groupBy("band", "hash", "low", "high").applyInArrow(_same_bucket(weights), "a long, b long")


def _classed(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The buckets with the classes found so far, without those that are one class."""
    now = buckets.select("band", "hash", "id").join(found, "id", "left")
    now = now.select("band", "hash", "id", F.coalesce("component", "id").alias("class_id"))
    several = now.groupBy("band", "hash").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).where("x <> y")
    return now.join(several.select("band", "hash"), ["band", "hash"])


def classes(spark: SparkSession, docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``id`` and ``class_id`` of every row of ``docs`` (id, text).

    Texts of the same words are one from the start. The others, where they share a band, are compared
    in two steps, neither of which hands on all pairs of a band's bucket:

    1. Each bucket names two leaders, its least id and the text with the most company over all its bands;
       every text of the bucket is compared with them. A bucket whose texts are one class by now is done.
    2. In the buckets left over, the texts outside of the largest class are compared with all texts inside
       tasks, in blocks of bounded size.

    So every pair of texts that share a band is compared, or is in one class by other links.
    """
    settings = settings or Settings()
    weights = weigh(docs, settings)
    signed_rows = docs.select("id", "text").mapInArrow(_signed_texts(weights), "id long, copy binary, bands array<long>")
    signed_rows = written(spark, signed_rows, "signatures")
    empty = signed_rows.where("copy IS NULL").select("id", F.col("id").alias("rep"))
    kinds = signed_rows.where("copy IS NOT NULL").groupBy("copy").agg(F.min("id").alias("rep"), F.min("bands").alias("bands"))
    kinds = written(spark, kinds, "kinds")
    members = signed_rows.select("id", "copy").where("copy IS NOT NULL").join(kinds.select("copy", "rep"), "copy").select("id", "rep")
    bucketed = kinds.select(F.col("rep").alias("id"), F.posexplode("bands").alias("band", "hash"))
    crowded = bucketed.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(spark, bucketed.join(crowded, ["band", "hash"]).select("band", "hash", "id", "n"), "buckets")
    company = buckets.groupBy("id").agg(F.sum("n").alias("company"))
    buckets = written(spark, buckets.join(company, "id").select("band", "hash", "id", "company"), "company")
    # of equal company the least id: the complement reverses the order and, unlike a minus sign, fits every id
    most = F.max_by("id", F.struct("company", F.bitwise_not("id").alias("id")))
    leaders = buckets.groupBy("band", "hash").agg(F.array_distinct(F.array(F.min("id"), most)).alias("leaders"))
    met = buckets.join(leaders, ["band", "hash"]).select("id", F.explode("leaders").alias("leader")).where("id <> leader")
    pairs = written(spark, met.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "compared")
    # the one pass that may shuffle all texts: what follows reads only those that share a band with another.
    # their ids are a table first, so Spark knows its size before it decides whether the texts must move at all
    shared = written(spark, buckets.select("id").distinct(), "compared-ids")
    texts = written(spark, docs.select("id", "text").join(shared, "id", "left_semi"), "compared-texts")
    links = written(spark, _verified(texts, pairs, weights), "links")
    found = written(spark, components(spark, links), "classes")
    rest = written(spark, _classed(buckets, found), "open-buckets")
    if not rest.isEmpty():
        stars = found.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        links = written(spark, stars.unionByName(_open_buckets(texts, rest, weights)), "links")
        found = written(spark, components(spark, links), "classes")
    named = found.select(F.col("id").alias("rep"), "component")
    # a class is named by its least id; representatives are the least of their copies
    everyone = members.unionByName(empty).join(named, "rep", "left")
    return everyone.select("id", F.coalesce("component", "rep").alias("class_id"))


def op10_minhash_icws(spark: SparkSession, docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Class of near copies of each document; ``kept`` marks the first document of a class.

    A class is named by its least doc_id, and a null one counts as the least. Texts are compared in lower case, by words between white space.
    Null and empty texts, and those of white space alone, are alike with nothing and stay alone. A
    document of fewer words than a shingle is one shingle. Rows that share a doc_id, repeated rows and those without an id
    among them, are documents of their own: one row of a class is kept. An empty table gives no rows; other columns are not looked at.
    """
    rows, names = row_keyed(spark, docs)
    found = classes(spark, rows, settings).withColumn("kept", F.col("id") == F.col("class_id"))
    named = with_doc_id(with_doc_id(found, names), names, "class_id", "class_doc")
    return named.select("doc_id", F.col("class_doc").alias("class_id"), "kept")
