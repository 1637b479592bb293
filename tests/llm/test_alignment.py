"""The alignment of two tokenizers against the libraries and byte sets, on odd texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tablesync.llm import alignment
from tablesync.llm.queries import op11_alignment
from tablesync.llm.words import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, "The quick brown fox jumps over the lazy dog.", "a"),
    (1, "The quick brown fox jumps over the lazy dog.", "a"),  # a row repeated in full
    (None, "The quick brown fox", "b"),
    (2, "", "c"),
    (3, None, "d"),
    (4, "one ▁ two", "U+2581 comes back as a space"),
    (5, "  leading,  double   spaces \n\n and \t tabs \r\n trailing  ", None),
    (6, "ünïcödé ☃ 漢字 ①ﬁ 👩‍👩‍👧 \x00\x1c\x85 \xa0 x", None),
    (7, "<|endoftext|> <s> </s> <unk> <0x0A> <|endoftext|>", None),
    (8, "x" * 3000 + " " + "the " * 500, None),
    (9, " ", None),
    (9, "don't we'll I'm 12345 67,890.12 a-b_c/d", None),
    (10, "é é ​﻿ zero", None),
]


V = alignment.Vocabularies(A, B)
A_BYTES, B_BYTES = V.bytes["a"].to_pylist(), V.bytes["b"].to_pylist()


def brute(rows):
    """Each text whole through the libraries; links by comparing byte ranges."""
    a_bytes, b_bytes = A_BYTES, B_BYTES
    a, b = V.a, SentencePieceProcessor(model_file=B)
    docs = []
    for key, text, *_ in rows:
        text = text or ""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        joined = b"".join(a_bytes[i] for i in ids_a), b"".join(b_bytes[i] for i in ids_b)
        if not text or joined != (whole, whole):
            ids_a, ids_b = [], []
        spans = []
        for ids, lengths in ((ids_a, a_bytes), (ids_b, b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(lengths[i]), i))
                at += len(lengths[i])
            spans.append(own)
        links = Counter()
        for s, e, i in spans[0]:
            for s2, e2, j in spans[1]:
                if s < e2 and s2 < e:
                    links[i, j] += 1
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, last = [], 0
        for end in common:
            inside = [",".join(str(i) for s, e, i in side if last < e <= end) for side in spans]
            groups.append("|".join(inside))
            last = end
        docs.append((key, len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    count = Counter(pair for *_, links, _ in docs for pair in links)
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for key, n_a, n_b, n_groups, links, text in docs:
        n_best = sum(n for pair, n in links.items() if count[pair] == best[pair[0]])
        total = sum(n * count[pair] for pair, n in links.items())
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((key, n_a, n_b, n_groups, sum(links.values()), n_best, total, sha))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 21, 60])
def test_equals_brute_force(spark, monkeypatch, block):
    """Blocks of 60 characters also take the way of texts longer than a block."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(ODD, "doc_id long, text string, block string").coalesce(2)
    if block == 60:
        v = V
        for _, text, _ in ODD:
            if text and "▁" not in text:
                long, short = alignment._align_long(text, v), alignment.align([text], v)
                assert {c: x.tolist() for c, x in long.counts.items()} == {c: x.tolist() for c, x in short.counts.items()}
                assert long.groups == [hashlib.sha256(short.groups[0].encode()).hexdigest()]
                assert long.links.select(["pair", "times"]).to_pylist() == short.links.select(["pair", "times"]).to_pylist()
    else:
        assert rows_of(alignment.alignment_report(spark, docs, A, B)) == brute(ODD)


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text[:700]) for r in table(spark, sf_dir, "documents").collect()]
    short = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(alignment.alignment_report(spark, short, A, B)) == brute(docs)
    whole = rows_of(op11_alignment(spark, sf_dir))
    ends = {r[0]: r for r in whole}
    for key, text in docs:
        if len(text) < 700:
            n_a, n_b, n_groups, n_links, *_, sha = ends[key][1:]
            assert (n_a, n_b, n_groups, n_links, sha) == (*brute([(key, text)])[0][1:5], brute([(key, text)])[0][-1])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.alignment_report(spark, empty, A, B).collect() == []
