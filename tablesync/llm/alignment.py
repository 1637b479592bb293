"""Two tokenizers over the same texts, aligned by the bytes their tokens cover."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablesync.llm.words import written

#: A block holds texts of about so many bytes; all arrays of a task are of this order.
BLOCK_BYTES = 1 << 20
#: A worker remembers words and their ids up to so many bytes of Arrow arrays, then starts anew.
REMEMBERED_BYTES = 1 << 25
#: A single space between two characters that are none: both tokenizers start a token there.
_BETWEEN_WORDS = re.compile(r" (?<=\S )(?=\S)")
#: The document a key belongs to stands above so many bits, the byte where a token ends below.
_END_BITS = 40
_SEPARATORS = (",", ";", "|", "")
_NEXT, _GROUP, _SIDE, _FIRST = range(4)
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies:
    """Both tokenizers with the bytes behind each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in plain]
        byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}
        a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in byte_of for c in token)
            a_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        # words are tokenized alone: no piece may go on over a space into the next word
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("the second vocabulary has pieces that reach over a space")
        self.bytes = {"a": pa.array(a_bytes, pa.binary()), "b": pa.array(b_bytes, pa.binary())}
        self.size = max(len(a_bytes), len(b_bytes))
        self.texts = pa.array([s + str(i) for s in _SEPARATORS for i in range(self.size)])
        self.forget()

    def forget(self) -> None:
        lists = pa.array([], pa.list_(pa.int64()))
        self.known = {"word": pa.array([], pa.large_string()), "a": lists, "b": lists, "whole": pa.array([], pa.bool_())}

    def places_of(self, words: pa.Array) -> pa.Array:
        """Where each of some distinct words stands among the known ones, to which new ones are added."""
        at = pc.index_in(words, value_set=self.known["word"])
        if not at.null_count:
            return at
        if sum(x.nbytes for x in self.known.values()) > REMEMBERED_BYTES:
            self.forget()
            return self.places_of(words)
        fresh = pc.filter(words, pc.is_null(at))
        found = {"word": fresh, **self.ids(fresh.to_pylist())}
        found["whole"] = pc.and_(*(self.covers(side, found[side], fresh) for side in ("a", "b")))
        self.known = {k: pa.concat_arrays([x, found[k]]) for k, x in self.known.items()}
        return pc.index_in(words, value_set=self.known["word"])

    def ids(self, words: list[str]) -> dict[str, pa.ListArray]:
        """The ids of each word with a space before it."""
        a = [e.ids for e in self.a.encode_batch([" " + w for w in words], add_special_tokens=False)]
        b = self.b.encode(words, num_threads=1) if words else []  # puts the space there itself
        return {"a": pa.array(a, pa.list_(pa.int64())), "b": pa.array(b, pa.list_(pa.int64()))}

    def covers(self, side: str, ids: pa.ListArray, words: pa.Array) -> pa.Array:
        """Whether the tokens of each word are exactly its bytes after a space."""
        tokens = pa.ListArray.from_arrays(ids.offsets, pc.take(self.bytes[side], pc.list_flatten(ids)))
        wanted = pc.binary_join_element_wise(pa.scalar(b"", pa.binary()), words.cast(pa.binary()), b" ")
        return pc.equal(pc.binary_join(tokens, b""), wanted)


@cache
def _vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


@dataclass
class Aligned:
    """Per text of a block: counts and the groups as text; the links as a table doc, pair, times."""

    counts: dict[str, np.ndarray]
    groups: list[str]
    links: pa.Table


def align(texts: list[str], v: Vocabularies) -> Aligned:
    """Align the tokens of some non-empty texts, all of them at once in Arrow.

    A word not met before is tokenized. Its id lists are dealt to its places in the texts,
    flattened, and summed up to the byte where each token ends. Ends of both sides meet in one
    full outer join on (document, end): its rows, in order, are the links, as two tokens
    overlap in one run of bytes without an end inside. Rows that both sides have close a group.
    """
    words = [_BETWEEN_WORDS.split(t) for t in texts]
    doc_of_word = pa.array(np.repeat(np.arange(len(texts)), [len(w) for w in words]))
    places = pa.array([w for ws in words for w in ws], pa.large_string()).dictionary_encode()
    word = pc.take(v.places_of(places.dictionary), places.indices)
    # a text with a word that its tokens do not cover has no tokens
    in_word = pc.take(v.known["whole"], word).to_numpy(zero_copy_only=False)
    broken = np.bincount(doc_of_word.to_numpy()[~in_word], minlength=len(texts)) > 0
    keep = pa.array(~broken[doc_of_word.to_numpy()])
    doc_of_word, word = pc.filter(doc_of_word, keep), pc.filter(word, keep)

    tokens, ends, docs = {}, {}, {}
    for side in ("a", "b"):
        lists = pc.take(v.known[side], word)
        tokens[side] = pc.list_flatten(lists)
        doc = pc.take(doc_of_word, pc.list_parent_indices(lists))
        length = pc.take(pc.binary_length(v.bytes[side]).cast(pa.int64()), tokens[side])
        running = pc.cumulative_sum(length)
        # segmented: what came before the first token of each document goes off again
        totals = np.bincount(doc.to_numpy(), weights=length.to_numpy(), minlength=len(texts)).astype(np.int64)
        before = pa.array(np.cumsum(totals) - totals)
        ends[side] = pc.add(pc.shift_left(doc, _END_BITS), pc.subtract(running, pc.take(before, doc)))
        docs[side] = doc.to_numpy()
    sides = [pa.table({"end": ends[s], s: pa.array(np.arange(len(ends[s])))}) for s in ("a", "b")]
    met = sides[0].join(sides[1], "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    has = {s: pc.is_valid(met[s]).to_numpy() for s in ("a", "b")}
    closes = has["a"] & has["b"]
    group = np.cumsum(closes) - closes
    row_doc = pc.shift_right(met["end"], _END_BITS).to_numpy()
    # a text's last end is common to both sides, so no filling reaches into the next text
    at = {s: pc.take(tokens[s], pc.fill_null_backward(met[s])) for s in ("a", "b")}
    pair = pc.add(pc.shift_left(at["a"], 32), at["b"])
    links = pa.table({"doc": pa.array(row_doc), "pair": pair})
    links = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    counts = {
        "n_a": np.bincount(docs["a"], minlength=len(texts)),
        "n_b": np.bincount(docs["b"], minlength=len(texts)),
        "n_groups": np.bincount(row_doc[closes], minlength=len(texts)),
        "n_links": np.bincount(row_doc, minlength=len(texts)),
    }
    texts_of = _group_texts(v, tokens, {s: group[has[s]] for s in has}, docs, counts)
    return Aligned(counts, texts_of, links.rename_columns(["doc", "pair", "times"]).sort_by([("doc", "ascending"), ("pair", "ascending")]))


def _group_texts(v: Vocabularies, tokens, group, docs, counts) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` per text: every id with the separator before it, put in order and joined."""
    n = int(max((g[-1] + 1 for g in group.values() if len(g)), default=0))
    size = {s: np.bincount(group[s], minlength=n) for s in group}
    upto = {s: np.cumsum(size[s]) for s in group}
    ordered = np.empty(sum(map(len, group.values())), np.int64)
    for side, opens in (("a", _GROUP), ("b", _SIDE)):
        g, at = group[side], np.arange(len(group[side]))
        first = np.ones(len(g), bool)
        first[1:] = g[1:] != g[:-1]
        separator = np.where(first, opens, _NEXT)
        if side == "a":
            in_doc = np.ones(len(g), bool)
            in_doc[1:] = docs["a"][1:] != docs["a"][:-1]
            separator[in_doc] = _FIRST
            at = at + (upto["b"] - size["b"])[g]
        else:
            at = at + upto["a"][g]
        ordered[at] = separator * v.size + tokens[side].to_numpy()
    offsets = np.concatenate([[0], np.cumsum(counts["n_a"] + counts["n_b"])])
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pc.take(v.texts, pa.array(ordered)))
    return pc.binary_join(lists, "").to_pylist()


def _parts(text: str) -> Iterator[str]:
    """The text, or where it is longer than a block, its pieces between words."""
    start = 0
    while len(text) - start > BLOCK_BYTES and (cut := _BETWEEN_WORDS.search(text, start + BLOCK_BYTES)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def _align_long(text: str, v: Vocabularies) -> Aligned:
    """One text of more than a block, piece by piece; pieces start with the space they were cut at."""
    digest, counts, tables = hashlib.sha256(), {c: np.zeros(1, np.int64) for c in _COUNTS}, []
    for i, part in enumerate(_parts(text)):
        one = align([part], v)
        if not one.counts["n_a"][0]:
            return Aligned({c: np.zeros(1, np.int64) for c in _COUNTS}, [""], one.links.slice(0, 0))
        digest.update(((";" if i else "") + one.groups[0]).encode())
        counts = {c: counts[c] + one.counts[c] for c in _COUNTS}
        tables.append(one.links)
        if len(tables) > 16:
            tables = [_added(tables)]
    return Aligned(counts, [digest.hexdigest()], _added(tables).sort_by("pair"))


def _added(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return both.rename_columns(["doc", "pair", "times"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, cut into blocks by the length of the texts; a longer text is a block alone."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            own = text.as_py() or ""
            if ids and (size + len(own) > BLOCK_BYTES or len(ids) >= 10_000):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(key.as_py())
            texts.append(own)
            size += len(own)
    if ids:
        yield ids, texts


def align_documents(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The tokens of two tokenizers side by side, a row per document and one per block of documents.

    A row of a document (``of_block`` false) has its counts, the digest of its groups, and its
    distinct linked id pairs (``a << 32 | b``) with how often each is linked. A block's row lists
    the pairs of its documents with in how many of them each stands: counted by Arrow where the
    texts are, summed over blocks by Spark.

    Texts that are null, empty, or whose tokens are not exactly their bytes have no tokens:
    zeros and an empty digest. doc_ids are carried along and never compared, so null and repeated ones
    and repeated rows keep a row each. Other columns are not looked at. The rows are written,
    so a lost executor repeats only its tasks.
    """
    kind = docs.schema["doc_id"].dataType
    schema = StructType([StructField("block", LongType()), StructField("doc_id", kind)]).add("of_block", "boolean")
    for c in _COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", ArrayType(LongType())).add("times", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, first = _vocabularies(a_path, b_path), TaskContext.get().partitionId() << 32
        for block, (ids, texts) in enumerate(_blocks(batches), first):
            yield _block_rows(block, ids, texts, v)

    def _block_rows(block: int, ids: list, texts: list[str], v: Vocabularies) -> pa.RecordBatch:
        full = [i for i, t in enumerate(texts) if t and "▁" not in t]  # U+2581 comes back as a space
        long = len(full) == 1 and len(texts[full[0]]) > BLOCK_BYTES
        done = _align_long(texts[full[0]], v) if long else align([texts[i] for i in full], v)
        n = len(ids)
        rows = {c: np.zeros(n + 1, np.int64) for c in _COUNTS}
        shas = [""] * (n + 1)
        for place, i in enumerate(full):
            if done.counts["n_a"][place]:
                text = done.groups[place]
                shas[i] = text if long else hashlib.sha256(text.encode()).hexdigest()
                for c in _COUNTS:
                    rows[c][i] = done.counts[c][place]
        in_block = done.links.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        of_doc = np.array(full, np.int64)[done.links["doc"].to_numpy()] if full else np.empty(0, np.int64)
        starts = [*np.searchsorted(of_doc, np.arange(n + 1)), len(of_doc) + len(in_block)]
        lists = {
            "pairs": np.concatenate([done.links["pair"].to_numpy(), in_block["pair"].to_numpy()]),
            "times": np.concatenate([done.links["times"].to_numpy(), in_block["count_all"].to_numpy()]),
        }
        offsets = pa.array(np.array(starts, np.int32))
        columns = {
            "block": pa.array([block] * (n + 1), pa.int64()),
            "doc_id": pa.array([*ids, None]),
            "of_block": pa.array([False] * n + [True]),
            **{c: pa.array(rows[c]) for c in _COUNTS},
            "groups_sha256": pa.array(shas),
            **{c: pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for c, x in lists.items()},
        }
        return pa.RecordBatch.from_pydict(columns, schema=wire)

    wire = to_arrow_schema(schema)
    return written(spark, docs.select("doc_id", "text").mapInArrow(run, schema), "aligned")


def pair_counts(spark: SparkSession, aligned: DataFrame) -> DataFrame:
    """Each linked id pair: ``documents`` that hold it, and ``best`` if none of its a id's pairs has more.

    The greatest counts per a id are broadcast: at most one row per id of the first vocabulary.
    """
    entry = F.explode(F.arrays_zip("pairs", "times")).alias("e")
    partial = aligned.where("of_block").select(entry).select("e.pairs", "e.times")
    counts = partial.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("documents"))
    counts = written(spark, counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    scored = counts.join(F.broadcast(most), "a")
    return scored.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _score(docs: pa.Table, found: pa.Table) -> pa.Table:
    """The sums over the links of a block's documents, from the counts of the block's pairs."""
    lists = docs["pairs"].combine_chunks()
    links = pa.table({
        "doc": pc.list_parent_indices(lists).cast(pa.int64()),
        "pair": pc.list_flatten(lists),
        "times": pc.list_flatten(docs["times"].combine_chunks()),
    })
    links = links.join(found.select(["pair", "documents", "best"]), "pair", join_type="inner", use_threads=False)
    times = links["times"]
    links = links.append_column("sum", pc.multiply(times, links["documents"]))
    links = links.append_column("hit", pc.multiply(times, links["best"].cast(pa.int64())))
    sums = links.group_by("doc", use_threads=False).aggregate([("sum", "sum"), ("hit", "sum")])
    out = {c: np.zeros(len(docs), np.int64) for c in ("hit_sum", "sum_sum")}
    for c in out:
        out[c][sums["doc"].to_numpy()] = sums[c].to_numpy()
    kept = docs.select(["doc_id", *_COUNTS])
    kept = kept.append_column("n_best", pa.array(out["hit_sum"])).append_column("count_sum", pa.array(out["sum_sum"]))
    return kept.append_column("groups_sha256", docs["groups_sha256"])


def alignment_report(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: its alignment, and how its links stand among those of all documents.

    The corpus-wide counts come back to a block once per distinct pair of the block, not per
    document, and meet its documents in one task. Blocks are of bounded size, and a pair stands
    in a block once, so neither key gathers more than that. See ``align_documents`` for odd rows.
    """
    aligned = align_documents(spark, docs, a_path, b_path)
    wanted = aligned.where("of_block").select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    found = wanted.join(pair_counts(spark, aligned), "pair")
    of_docs = aligned.where("NOT of_block").drop("of_block")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType)])
    for c in (*_COUNTS, "n_best", "count_sum"):
        schema = schema.add(c, LongType())
    schema = schema.add("groups_sha256", StringType())
    return of_docs.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_score, schema)


def op11_alignment(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The digest of ``alignment_report`` over all documents; an empty table gives no rows."""
    return alignment_report(spark, docs, a_path, b_path)
