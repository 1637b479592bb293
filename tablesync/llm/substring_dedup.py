"""Removal of word passages that occur earlier in the corpus, by suffix automata of reference shards."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.words import gram_hashes, mixed, row_keyed, signed, with_doc_id, word_hashes, words_of, written

#: Words of an anchor; each window has one, the gram of so many words with the least hash.
ANCHOR = 8
#: Passages in one automaton, on average. This bounds what a task holds.
SHARD = 3_000
#: Different passages of one core beyond which they are dealt again, by more of the words around it.
HOT_ANCHOR = 1_000
_POWER = 0xD6E8FEB86659FD93
_INVERSE = pow(_POWER, -1, 2**64)


class SuffixAutomaton:
    """All substrings of the word sequences added so far."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of the shorter strings of q, which p reaches by the word."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        edges, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            known = edges[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, known, word)
                continue
            state, p = len(length), last
            edges.append({})
            length.append(length[last] + 1)
            while p >= 0 and word not in (out := edges[p]):
                out[word] = state
                p = link[p]
            if p < 0:
                link.append(0)
            else:
                q = out[word]
                link.append(q)
                if length[q] != length[p] + 1:
                    link[state] = self._split(p, q, word)
            last = state

    def matches(self, words: list[int]) -> list[int]:
        """Matching statistics: at each word the longest match that ends there."""
        edges, link, lengths = self.next, self.link, self.length
        state = length = 0
        found = []
        for word in words:
            reached = edges[state].get(word)
            while reached is None and state:
                state = link[state]
                length = lengths[state]
                reached = edges[state].get(word)
            if reached is None:
                length = 0
            else:
                state, length = reached, length + 1
            found.append(length)
        return found


@dataclass(frozen=True)
class Powers:
    """Powers of an odd number and of its inverse, for hashes of any run of words."""

    up: np.ndarray
    down: np.ndarray

    @classmethod
    def upto(cls, n: int) -> Powers:
        one = np.ones(1, np.uint64)
        up = np.cumprod(np.concatenate([one, np.full(n, _POWER, np.uint64)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([one, np.full(n, _INVERSE, np.uint64)]), dtype=np.uint64)
        return cls(up, down)


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share their anchor: (anchor hash, its place, first window, end)."""
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none, none, none
    grams = gram_hashes(hashes, ANCHOR)
    choices = np.lib.stride_tricks.sliding_window_view(grams, window - ANCHOR + 1)
    anchor = choices.argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return grams[anchor[first]], anchor[first], first, np.append(first[1:], n)


def passages(hashes: np.ndarray, window: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """Runs of windows that share their anchor: (anchor hash, content hash, first window, end).

    A window's anchor depends on its words alone, so equal windows lie in passages of
    equal anchor hash, and as far before or after the anchor.
    """
    anchor, place, first, end = anchors(hashes, window)
    if not len(first):
        return anchor, anchor, first, end
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers.up[: len(hashes)], dtype=np.uint64)])
    content = (sums[end + window - 1] - sums[first]) * powers.down[first]
    shape = ((place - first) * 65_536 + (end - first)).astype(np.uint64)
    return anchor, mixed(content ^ mixed(shape)), first, end


def _anchors_of(window: int):
    """The anchors of a batch's passages and how many passages have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [anchors(word_hashes(words_of(text.as_py())), window)[0] for text in batch.column(0)]
            if parts:
                found, n = np.unique(signed(np.concatenate(parts)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())], ["anchor", "n"])

    return run


def _passages_of(window: int):
    names = ["anchor", "content", "id", "first", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers.upto(1 << 12)
        for batch in batches:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = word_hashes(words_of(text.as_py()))
                if len(hashes) > len(powers.up):
                    powers = Powers.upto(2 * len(hashes))
                anchor, content, first, end = passages(hashes, window, powers)
                parts.append((signed(anchor), signed(content), np.full(len(first), key), first, end))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                types = [pa.int64()] * 3 + [pa.int32()] * 2
                arrays = [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


PASSAGE = "anchor long, content long, id long, first int, end int"
#: A piece of the passage (anchor, content) of document id at word ``owner``: the windows that hold the passage's anchor
#: ``low`` to ``high`` words from their start, and therefore all words of the core. Equal pieces have one core and one shape.
PIECE = (
    "anchor long, content long, id long, owner int, core long, shape long, first int, pivot int, low int, high int, "
    "twin boolean, words binary"
)
#: Words of a piece, from its first, that a window covers which starts earlier as well: in the piece itself or (later) in its copies.
MATCH = "core long, shape long, id long, first int, later boolean, start int, stop int"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _runs(starts: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal word spans covered by windows at the ascending starts."""
    spans: list[tuple[int, int]] = []
    for start in starts:
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], start + window)
        else:
            spans.append((start, start + window))
    return spans


def _match_shard(window: int):
    """Stream the pieces of a shard, in the order of their places, through the automaton of those before.

    A piece that has equal ones later on streams once more after it was added, in place of all of them.
    """

    def run(table: pa.Table) -> pa.Table:
        # a row repeated in full brings its pieces again
        names = ("id", "first", "core", "shape", "twin", "words")
        rows = sorted(set(zip(*[table.column(c).to_pylist() for c in names], strict=True)))
        automaton, found = SuffixAutomaton(), []
        collecting = gc.isenabled()
        gc.disable()  # an automaton is millions of objects without cycles; passes over them find nothing
        try:
            for key, first, core, shape, twin, packed in rows:
                words = np.frombuffer(packed, np.int64).tolist()
                for later in (False, True)[: 1 + twin]:
                    starts = [i - window + 1 for i, length in enumerate(automaton.matches(words)) if length >= window]
                    found += [(core, shape, key, first, later, *span) for span in _runs(starts, window)]
                    if not later:
                        automaton.add(words)
        finally:
            if collecting:
                gc.enable()
        return pa.Table.from_batches([_batch(found, _arrow(MATCH))])

    return run


def _content_of(window: int):
    """Wanted passages of a document with the hashes of their words, each as one piece."""
    schema = _arrow(PIECE + ", hot boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, wanted in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                hashes = word_hashes(words_of(text))
                for w in wanted:
                    own = hashes[w["first"] : w["end"] + window - 1]
                    pivot = int(gram_hashes(own[:window], ANCHOR).argmin()) if w["hot"] else 0
                    place = (w["anchor"], w["content"], key, w["first"])
                    piece = (w["anchor"], w["content"], w["first"], pivot, 0, window - ANCHOR)
                    rows.append((*place, *piece, w["twin"], own.tobytes(), w["hot"]))
            yield _batch(rows, schema)

    return run


def _halves(window: int):
    """Each piece as two, by where in a window the anchor stands: the nearer these places, the more words must be the same."""
    schema = _arrow(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                words, pivot = np.frombuffer(r["words"], np.uint64), r["pivot"]
                middle = (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                    begin, end = max(0, pivot - high), min(len(words) - window, pivot - low) + 1
                    if begin >= end:
                        continue
                    core, own = words[pivot - low : pivot - high + window], words[begin : end + window - 1]
                    core = mixed(gram_hashes(core, len(core)) ^ mixed(np.array([low * 65_536 + high], np.uint64)))
                    shape = mixed(gram_hashes(own, len(own)) ^ mixed(np.array([(pivot - begin) * 65_536 + end - begin], np.uint64)))
                    hashes = (int(signed(core)[0]), int(signed(shape)[0]))
                    place = (r["anchor"], r["content"], r["id"], r["owner"])
                    rows.append((*place, *hashes, r["first"] + begin, pivot - begin, low, high, r["twin"], own.tobytes()))
            yield _batch(rows, schema)

    return run


def _matched(pieces: DataFrame, window: int) -> DataFrame:
    """What the automata find; pieces of one core, and no others with equal windows, meet in one shard."""
    shards = max(1, -(-pieces.count() // SHARD))
    shard = F.pmod(F.xxhash64("core"), F.lit(shards)).alias("shard")
    columns = pieces.select("core", "shape", "id", "first", "twin", "words")
    return columns.groupBy(shard).applyInArrow(_match_shard(window), MATCH)


def _dealt_again(spark: SparkSession, pieces: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The halves of crowded pieces, ``hot`` if their core is crowded still, and the earliest of equal ones that may match others."""
    halves = written(spark, pieces.mapInArrow(_halves(window), PIECE), "halves")
    alike = halves.groupBy("core", "shape").agg(
        F.min(F.struct("id", "first")).alias("at"),
        F.count("*").alias("copies"),
        F.max("twin").alias("twin"),
        F.first("low").alias("low"),
        F.first("high").alias("high"),
    )
    alike = written(spark, alike, "half-kinds")
    cores = alike.groupBy("core").agg(
        (F.sum("copies") + F.max("twin").cast("long")).alias("n"),
        ((F.count("*") > HOT_ANCHOR) & F.max(F.col("low") < F.col("high"))).alias("hot"),
    )
    cores = written(spark, cores.where("n > 1").select("core", "hot"), "half-cores")
    halves = halves.join(cores, "core")
    firsts = alike.select("core", "shape", "at", (F.col("twin") | (F.col("copies") > 1)).alias("repeats"))
    earliest = halves.join(firsts, ["core", "shape"]).where(
        "NOT hot AND id = at.id AND first = at.first"
    )
    return halves, earliest.drop("at", "twin").withColumnRenamed("repeats", "twin")


def _of_passages(halves: DataFrame, matched: DataFrame) -> DataFrame:
    """What was found in pieces, told of the passages they are from."""
    found = matched.select("core", "shape", F.struct("id", "first").alias("at"), "later", "start", "stop")
    met = halves.select("anchor", "content", "id", "owner", "core", "shape", "first", "twin").join(found, ["core", "shape"])
    same = (F.col("id") == F.col("at.id")) & (F.col("first") == F.col("at.first"))
    shift = F.col("first") - F.col("owner")
    place = ["anchor", "content", "id", "owner"]
    span = [(F.col("start") + shift).alias("start"), (F.col("stop") + shift).alias("stop")]
    own = met.where(F.col("later") != same).select(*place, F.lit(False).alias("later"), *span)
    return own.unionByName(met.where("later AND twin").select(*place, "later", *span))


def repeated_spans(spark: SparkSession, docs: DataFrame, window: int = 20) -> DataFrame:
    """Word spans (id, first, end) covered by windows whose words also start earlier; they may overlap.

    ``docs`` has ``id`` and ``text``. The steps, each over all documents:

    1. Every document is cut into passages, runs of windows with one anchor. Passages
       whose anchor occurs once hold nothing that repeats and go no further.
    2. Of equal passages the earliest is sent to the reference shard of its anchor. There they stream, in
       order of place, through the suffix automaton of those before them; matching statistics of a window's
       length or more give the spans. A passage with equal ones later streams once more when it is
       in the automaton, and what is found then is the spans of all of these.
       An automaton thus meets only the passages that can match it, instead of being broadcast to all
       documents, which would cost documents times shards.
    3. An anchor with more than ``HOT_ANCHOR`` different passages would overfill its shard. They are cut in two by where
       in its windows the anchor stands, and dealt by all words that such windows must share: 14 instead of 8
       of a window of 20, then 17, 19 and all. Pieces go through automata as passages do, as soon as
       their core is not crowded; a whole window as the core has one piece alone.
    """
    if window <= ANCHOR:
        raise ValueError(f"the window must be longer than {ANCHOR} words")
    found = docs.select("id", "text").mapInArrow(_passages_of(window), PASSAGE)
    counted = docs.select("text").mapInArrow(_anchors_of(window), "anchor long, n long")
    repeated = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    repeated = written(spark, repeated, "anchors")
    # the anchors grow with the documents: never broadcast; as both sides are plain shuffles, Spark can split a hot anchor
    candidates = written(spark, found.join(repeated.hint("merge"), "anchor"), "passages")
    firsts = candidates.groupBy("anchor", "content").agg(
        F.min(F.struct("id", "first", "end")).alias("at"), (F.count("*") > 1).alias("twin")
    )
    firsts = written(spark, firsts, "first-passages")
    crowded = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ANCHOR)
    crowded = written(spark, crowded.select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    wanted = firsts.join(crowded, "anchor", "left").select(
        "at.id", F.struct("anchor", "content", "at.first", "at.end", "twin", F.coalesce("hot", F.lit(False)).alias("hot")).alias("w")
    )
    by_doc = wanted.groupBy("id").agg(F.collect_list("w").alias("wanted"))
    texts = docs.select("id", "text").join(by_doc, "id").select("id", "text", "wanted")
    pieces = written(spark, texts.mapInArrow(_content_of(window), PIECE + ", hot boolean"), "passage-words")
    matched = _matched(pieces.where("NOT hot"), window)
    parts = [
        matched.select(
            F.col("core").alias("anchor"), F.col("shape").alias("content"), "id", F.col("first").alias("owner"), "later", "start", "stop"
        )
    ]
    while not (pieces := pieces.where("hot").drop("hot")).isEmpty():
        pieces, earliest = _dealt_again(spark, pieces, window)
        pieces = written(spark, pieces, "pieces")
        parts.append(_of_passages(pieces, _matched(written(spark, earliest, "first-pieces"), window)))
    matches = written(spark, reduce(DataFrame.unionByName, parts), "matches")
    own = matches.where("NOT later").select("id", (F.col("owner") + F.col("start")).alias("first"), (F.col("owner") + F.col("stop")).alias("end"))
    copied = matches.where("later").select("anchor", "content", F.struct("id", F.col("owner").alias("first")).alias("at"), "start", "stop")
    copies = candidates.select("anchor", "content", "id", "first").join(copied, ["anchor", "content"]).where(
        (F.col("id") != F.col("at.id")) | (F.col("first") != F.col("at.first"))
    )
    copies = copies.select("id", (F.col("first") + F.col("start")).alias("first"), (F.col("first") + F.col("stop")).alias("end"))
    return written(spark, own.unionByName(copies), "spans")


def _kept(text: str | None, spans: list[dict]) -> tuple[list[bytes], np.ndarray]:
    words = words_of(text)
    edges = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        edges[min(s["first"], len(words))] += 1
        edges[min(s["end"], len(words))] -= 1
    return words, np.cumsum(edges)[:-1] == 0


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The columns of docs and, last, the spans under a name that docs does not use."""
    name = "spans"
    while name in docs.columns:
        name += "_"
    gathered = spans.groupBy("id").agg(F.collect_set(F.struct("first", "end")).alias(name))
    return docs.join(gathered, "id", "left").select(*docs.columns, name)


def digest(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document: id, n_words, n_removed and the digest of the kept words joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, own in zip(batch.column(1), batch.column(2), strict=True):
                words, keep = _kept(text.as_py(), own.as_py() or [])
                left = b" ".join(words if keep.all() else [w for w, k in zip(words, keep, strict=True) if k])
                rows.append((len(words), int((~keep).sum()), hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            types = [pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n_words", "n_removed", "kept_sha256"])

    return _with_spans(docs.select("id", "text"), spans).mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with the spans taken out of ``text``; what stays keeps its own white space.

    All columns stay as they are, ``id`` included. A text without spans is unchanged.
    """
    names = docs.columns  # tasks must not hold the DataFrame
    at = names.index("text")

    def cut_text(text: str, own: list[dict]) -> str:
        words, keep = _kept(text, own)
        raw, parts, position = text.encode(), [], 0
        for word, k in zip(words, keep.tolist(), strict=True):
            begin = raw.index(word, position)
            stop = begin + len(word)
            if k:
                parts.append(raw[position:stop])  # with the white space before it
            position = stop
        return b"".join(parts).strip().decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, spans_of = batch.columns
            texts = columns[at].to_pylist()
            own = spans_of.to_pylist()
            columns[at] = pa.array([cut_text(t, s) if s else t for t, s in zip(texts, own, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return _with_spans(docs, spans).mapInArrow(run, docs.schema)


def op1_substring_dedup(spark: SparkSession, docs: DataFrame, window: int = 20) -> DataFrame:
    """Counts and digest of what each document keeps.

    A null doc_id counts as the smallest. A null text has no words. Rows that share a doc_id, repeated rows and
    those without an id among them, are documents of their own, in the order of their texts' hashes: a repeated row loses what
    the one before it has, and no row loses what only it has. Documents shorter than a window
    lose nothing. An empty table gives no rows; other columns are not looked at.
    """
    rows, names = row_keyed(spark, docs)
    found = digest(rows, repeated_spans(spark, rows, window))
    return with_doc_id(found, names).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
  lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS gram FROM d, unnest(range(1, len(words) - 18)) AS r(i)),
r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, range(20) AS x(j)),
k AS (SELECT doc_id, list(i) AS removed FROM c GROUP BY doc_id),
s AS (SELECT doc_id, words, coalesce(removed, []) AS removed FROM d LEFT JOIN k USING (doc_id))
SELECT doc_id, len(words)::BIGINT AS n_words, len(removed)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(removed, i)), ' ')) AS kept_sha256 FROM s
"""
