"""The training-data operators against brute force and libraries, on small tables with odd rows."""

from __future__ import annotations

import base64
import binascii
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tablesync.llm import byte_bpe, embedding_dedup, kneser_ney, license_scan, minhash_icws, packing, preference_format
from tablesync.llm import quality_ledger, sharding, substring_dedup
from tablesync.llm.byte_bpe import decode_ids, encode_documents, round_trip
from tablesync.llm.packing import Capacities, plan_bins
from tablesync.llm.words import keyed, word_hashes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PASSAGE = " ".join(f"word{i}" for i in range(40))
ROWS = [
    (1, f"start here {PASSAGE} the end", "a", 5),
    (2, f"other words {PASSAGE} and more", "b", 6),
    (2, f"other words {PASSAGE} and more", "b", 6),  # a row repeated in full
    (3, "", "c", 0),
    (4, None, None, None),
    (5, "x " * 5000, "d", 10000),
    (6, "All rights reserved. Licensed under CC BY 4.0", "e", 1),
    (None, f"without an id {PASSAGE}", "f", 1),
    (7, "Ünï ☃ \t tabs\nand lines\n\nand lines", "g", 1),
]
#: Extra columns whose names operators use inside.
SCHEMA = "doc_id long, text string, id string, spans long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert substring_dedup.op1_substring_dedup(spark, empty).count() == 0
    assert license_scan.op2_license_scan(spark, empty).count() == 0
    assert packing.op5_best_fit_packing(spark, empty, path, public_tokenizers.PATTERN).count() == 0
    assert round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert kneser_ney.op7_kneser_ney(spark, empty).count() == 0
    assert sharding.op8_shard_by_bytes(spark, empty).count() == 0
    assert quality_ledger.op9_quality_ledger(empty).count() == 0
    assert minhash_icws.op10_minhash_icws(spark, empty).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.op3_nn_descent(spark, vectors).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference_format.op4_preference_format(turns).count() == 0


def brute_spans(rows, window=20):
    """The words that go, by the place of each row in the order of ids; rows of one id must be equal or share nothing."""
    places = defaultdict(list)
    for at, (_, text) in enumerate(rows):
        words = (text or "").encode().split()
        for s in range(len(words) - window + 1):
            places[tuple(words[s : s + window])].append((at, s))
    gone = defaultdict(set)
    for where in places.values():
        for at, s in sorted(where)[1:]:
            gone[at].update(range(s, s + window))
    return gone


def brute_digests(rows):
    rows = sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    gone, out = brute_spans(rows), []
    for at, (i, text) in enumerate(rows):
        words = (text or "").encode().split()
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone[at])
        out.append((i, len(words), len(gone[at]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digests(spark, docs):
    return sorted(map(tuple, substring_dedup.op1_substring_dedup(spark, docs).collect()), key=repr)


def test_substring_dedup(spark, docs):
    assert digests(spark, docs) == brute_digests(ROWS)


def prose(seed, n=120):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**9, n))


#: Rows that share an id, or have none: two copies of a text, and texts of their own beside them.
SHARED_IDS = [(1, prose(1)), (5, prose(1)), (5, prose(2)), (None, prose(3)), (None, prose(4)), (None, None), (7, prose(4)), (7, prose(5)), (7, prose(5))]


def test_rows_that_share_an_id_lose_no_words_of_their_own(spark):
    docs = spark.createDataFrame(SHARED_IDS, "doc_id long, text string").repartition(3)
    found = digests(spark, docs)
    assert found == brute_digests(SHARED_IDS)
    assert sum(n - gone for _, n, gone, _ in found) == 5 * 120  # each text is kept once, whole


def test_near_copies_of_rows_that_share_an_id(spark):
    """Classes are of rows: a shared id joins nothing, and null ids are like others."""
    near = prose(2).replace(prose(2).split()[50], "changed")
    rows = [*SHARED_IDS, (9, near), (None, near), (3, prose(6)), (3, prose(6)), (3, prose(7))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter(map(tuple, minhash_icws.op10_minhash_icws(spark, docs).collect()))
    assert found == Counter([
        (1, 1, True), (5, 1, False),  # the same text
        (None, None, True), (5, None, False), (9, None, False),  # near copies; that without an id is the least
        (None, None, True), (None, None, True), (None, None, True),  # alone, but for the next
        (7, None, False), (7, 7, True), (7, 7, False), (3, 3, True), (3, 3, False), (3, 3, True),
    ])
    unique = [(None, prose(1)), (1, prose(1)), (2, prose(2)), (-(2**62), near)]
    docs = spark.createDataFrame(unique, "doc_id long, text string")
    found = Counter(map(tuple, minhash_icws.op10_minhash_icws(spark, docs).collect()))
    assert found == Counter([(None, None, True), (1, None, False), (2, -(2**62), False), (-(2**62), -(2**62), True)])


def test_pipeline_stages_on_rows_that_share_an_id(spark):
    rows = [(i, t, "en", n, {"a": 1}) for n, (i, t) in enumerate(SHARED_IDS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, spans map<string,int>")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near copies"](spark, docs, "")
    assert kept.columns == docs.columns
    # a text once; the row without a text is like nothing
    assert Counter(r.text for r in kept.collect()) == Counter({prose(i): 1 for i in range(1, 6)} | {None: 1})
    cut = stages["repeated passages"](spark, docs, "")
    assert cut.columns == docs.columns
    assert Counter(r.text for r in cut.collect()) == Counter({prose(i): 1 for i in range(1, 6)} | {None: 1, "": 3})
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name


def phrases(seed, n=60):
    """Texts of a few common phrases, 8 to 30 words long, between words of their own; some texts twice."""
    random = np.random.default_rng(seed)
    common = [prose(100 + i, int(size)).split() for i, size in enumerate(random.integers(8, 31, 4))]
    texts = []
    for i in range(n):
        parts = [w for _ in range(4) for w in (*prose(1000 * seed + i, int(random.integers(1, 9))).split(), *common[random.integers(0, 4)])]
        texts.append(" ".join(parts))
    return list(enumerate([*texts, *texts[:5]]))


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_crowded_anchors_are_dealt_by_more_words(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", hot)
    monkeypatch.setattr(substring_dedup, "SHARD", 20)
    rows = phrases(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = substring_dedup.repeated_spans(spark, keyed(docs)).collect()
    found = {(r["id"], i) for r in spans for i in range(r["first"], r["end"])}
    assert found == {(at, i) for at, gone in brute_spans(rows).items() for i in gone}
    assert len(found) > 1000


def test_hot_anchors_give_the_same_spans(spark, docs, monkeypatch):
    rows = keyed(docs)
    covered = lambda df: {(r["id"], i) for r in df.collect() for i in range(r["first"], r["end"])}
    cold = covered(substring_dedup.repeated_spans(spark, rows))
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", 0)
    assert covered(substring_dedup.repeated_spans(spark, rows)) == cold


@pytest.mark.parametrize("hot", [0, 1000])
def test_all_spans_come_from_the_automata(spark, docs, monkeypatch, hot):
    nothing = lambda window: lambda table: substring_dedup.pa.Table.from_batches(
        [substring_dedup._batch([], substring_dedup._arrow(substring_dedup.MATCH))]
    )
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", hot)
    monkeypatch.setattr(substring_dedup, "_match_shard", nothing)
    assert substring_dedup.repeated_spans(spark, keyed(docs)).isEmpty()


def test_automaton():
    random = np.random.default_rng(3)
    past, automaton = [], substring_dedup.SuffixAutomaton()
    for _ in range(30):
        words = random.integers(0, 4, 30).tolist()
        known = {tuple(p[i:j]) for p in past for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
        want = [max((n for n in range(1, e + 2) if tuple(words[e + 1 - n : e + 1]) in known), default=0) for e in range(30)]
        assert list(automaton.matches(words)) == want
        automaton.add(words)
        past.append(words)


def test_license_scan(spark, docs):
    found = {r.doc_id: r for r in license_scan.op2_license_scan(spark, docs).collect()}
    r = found[6]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (9, 2, 0, 5)
    assert (r.base_labels, r.labels, r.score) == ("cc-by,reserved", "cc-by,cc-by-4.0,reserved", 1.0)
    assert found[4].n_words == 0 and found[4].n_base == 0 and found[4].first_word is None and found[4].labels == ""


def test_words_that_change_a_license(spark):
    notice = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License"
    texts = {
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0",
        "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
        "Licensed under CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa-4.0",
        "Licensed under CC BY 4.0": "cc-by,cc-by-4.0",
        "Licensed under CC BY 3.0": "cc-by",
        "This work is licensed under the GNU General Public License, version 3": "gpl,gpl-3.0",
        "This work is licensed under the GNU General Public License, version 2": "gpl",
        "This work is now licensed under the GNU General Public License, version 3 of 2007": "gpl,gpl-3.0",
        notice.format(""): "gpl",
        notice.format("Lesser ") + " as published by the Free Software Foundation": "gpl,lgpl",
        notice.format("Affero ") + " as published by the Free Software Foundation": "agpl,gpl",
        "the GNU Lesser GPL, by Affero": "",
        "Permission is hereby granted, free of charge, to any person obtaining one copy of this software": "mit",
        " ".join(sorted("released under the mit license".split())): "",
        "Permission is hereby granted, free of charge": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan.op2_license_scan(spark, docs).collect()}
    assert {t: found[i] for i, t in enumerate(texts)} == texts
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    by_sql = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, labels FROM ({license_scan.SQL})").fetchall()}
    assert by_sql == found


def test_nn_descent_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (4, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 1.0])]
    found = embedding_dedup.op3_nn_descent(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = Counter(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect()))
    want = [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, None, False), (4, 1, None, False), (None, 1, None, True)]
    assert got == Counter(want + [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10)])


def test_vectors_that_share_an_id_are_each_compared(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 2.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0]),
            (None, [0.0, -1.0]), (None, [-1.0, 0.01])]
    found = embedding_dedup.op3_nn_descent(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = Counter(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == Counter([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, None, False),
                           (4, 1, None, False), (None, 0, None, True), (None, 1, None, True)])


def brute_links(rows, similarity=0.95):
    """(n_links, component) by id, of vectors that are all comparable."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= similarity
    np.fill_diagonal(linked, False)
    component = ids.copy()
    while True:
        least = np.array([min(component[i], component[near].min(initial=component[i])) for i, near in enumerate(linked)])
        if (least == component).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), component, strict=True)}
        component = least


def near(random, center, cosine):
    """A vector at exactly that cosine from a unit vector."""
    away = random.standard_normal(len(center))
    away -= (away @ center) * center
    return cosine * center + math.sqrt(1 - cosine**2) * away / np.linalg.norm(away)


def links_found(spark, rows, settings):
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    return {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.op3_nn_descent(spark, vectors, settings).collect()}


def test_links_between_tight_groups(spark):
    random = np.random.default_rng(5)
    rows = []
    for _ in range(6):
        u = near(random, np.eye(32)[0], 0.0)
        for center in (u, near(random, u, 0.956)):
            rows += [(len(rows) + i, near(random, center, 0.99999)) for i in range(20)]
    want = brute_links(rows)
    assert len({c for _, c in want.values()}) == 6 and all(n > 30 for n, _ in want.values())
    assert links_found(spark, rows, embedding_dedup.Settings(queries=1)) == want


def test_isolated_pairs_beside_a_hot_group(spark):
    random = np.random.default_rng(6)
    hot = near(random, np.eye(24)[0], 0.0)
    rows = [(i, near(random, hot, 0.99)) for i in range(1000)]
    for _ in range(1500):
        x = near(random, hot, random.uniform(-0.3, 0.3))
        rows += [(len(rows), x), (len(rows) + 1, near(random, x, 0.951))]
    settings = embedding_dedup.Settings(queries=20, tables=8, descents=2)
    assert links_found(spark, rows, settings) == brute_links(rows)


def test_recall_of_few_links_is_not_outvoted(spark):
    links = [(1, i) for i in range(100, 1100)] + [(2, 3), (4, 5)]
    classes = [(1, 1), *[(i, 1) for i in range(100, 1100)], (2, 2), (3, 2)]
    truth = spark.createDataFrame(links, "a long, b long")
    assert embedding_dedup.recalled(truth, spark.createDataFrame(classes, "id long, component long")) == 0.5


def test_preference_format(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", None), (None, None, None, "x")]
    found = preference_format.op4_preference_format(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = {r.chosen_id: r for r in found.collect()}
    r = rows[1]
    assert (r.rejected_id, r.prompt_turns, r.prompt) == (2, 1, "<|user|>\nhi<|end|>\n")
    for text, mask, word in ((r.chosen_completion, r.chosen_mask, "yes"), (r.rejected_completion, r.rejected_mask, "no")):
        assert [text[s.start : s.end] for s in mask] == [f"{word}<|end|>"]
    assert rows.keys() == {1, 3, None} and rows[3].rejected_id is None


def test_openings_are_paired_over_the_whole_table(spark):
    random = np.random.default_rng(7)
    ids = sorted({1000, 1030, *random.integers(-(10**6), 10**6, 300).tolist()})
    opening = {i: "far" if i in (1000, 1030) else random.choice(["hot", "a", "b", "c"]) for i in ids}
    turns = [(i, t, *x) for i in ids for t, x in enumerate([("user", str(opening[i])), ("user", f"own {i}")])]
    random.shuffle(turns)
    turns = [(int(i), int(t), str(role), str(text)) for i, t, role, text in turns]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    got = {(r.chosen_id, r.rejected_id): r for r in preference_format.op4_preference_format(rows).collect()}
    want = set()
    for o in set(opening.values()):
        own = [i for i in ids if opening[i] == o]
        want |= {(a, b) for a, b in zip(own[::2], [*own[1::2], None], strict=False)}
    assert got.keys() == want and (1000, 1030) in want
    assert all(r.prompt_turns == 1 and r.rejected_completion == f"<|user|>\nown {b}<|end|>\n" for (_, b), r in got.items() if b is not None)


def brute_preferences(turns):
    """The rows of op4 in plain Python, from (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for i, _, role, text in sorted(turns):
        talks[i].append((role, text))
    ids, openings, answers, rings = sorted(talks), defaultdict(list), {}, defaultdict(list)
    for i in ids:
        openings[talks[i][0]].append(i)
        said = [n for n, (role, _) in enumerate(talks[i]) if role == "assistant"]
        if said:
            text = talks[i][said[-1]][1]
            answers[i] = said[-1], text, len(f"{len(text):b}")
            if text not in [x for x, _ in rings[answers[i][2]]]:
                rings[answers[i][2]].append((text, i))
    lone = sorted(own[-1] for own in openings.values() if len(own) % 2)
    pairs = [(a, b, talks[b]) for own in openings.values() for a, b in zip(own[::2], own[1::2], strict=False)]
    met = Counter()
    for i in lone:
        if i not in answers or sum(map(len, rings.values())) == 1:
            pairs.append((i, None, []))
            continue
        at, text, kind = answers[i]
        ring, turn = rings[kind], met[text]
        met[text] += 1
        if len(ring) > 1:
            here = [x for x, _ in ring].index(text)
            other, donor = ring[(here + 1 + turn % (len(ring) - 1)) % len(ring)]
        else:
            ring = rings[min([k for k in rings if k > kind], default=min(rings))]
            other, donor = ring[turn % len(ring)]
        pairs.append((i, donor, [*talks[i][:at], ("assistant", other), *talks[i][at + 1 :]]))
    rows = []
    for a, b, rejected in pairs:
        n = 0
        while n < min(len(talks[a]), len(rejected)) and talks[a][n] == rejected[n]:
            n += 1
        shown = lambda ts: "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in ts)
        trained = lambda ts: tuple(f"{text}<|end|>" for role, text in ts if role == "assistant")
        sides = [x for ts in (talks[a][n:], rejected[n:]) for x in (shown(ts), trained(ts))]
        rows.append((a, b, n, shown(talks[a][:n]), *sides))
    return rows


def preferences_found(turns):
    masked = lambda text, spans: tuple(text[s.start : s.end] for s in spans)
    return [
        (r.chosen_id, r.rejected_id, r.prompt_turns, r.prompt, r.chosen_completion, masked(r.chosen_completion, r.chosen_mask),
         r.rejected_completion, masked(r.rejected_completion, r.rejected_mask))
        for r in preference_format.op4_preference_format(turns).collect()
    ]


def test_preferences_of_a_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = [tuple(r) for r in table.collect()]
    want = brute_preferences(turns)
    assert Counter(preferences_found(table)) == Counter(want)
    answered = {i for i, _, role, _ in turns if role == "assistant"}
    assert answered and all(n > 0 and chosen != rejected for i, _, n, _, chosen, _, rejected, _ in want if i in answered)


def test_preferences_with_common_answers(spark):
    random = np.random.default_rng(8)
    texts = ["yes", "no", "it depends", "x" * 40, "y" * 300, "z" * 301]
    turns = []
    for i in random.permutation(400).tolist():
        opening = "hot" if i % 3 == 0 else f"own {i}"
        turns.append((i, 0, "user", opening))
        for t in range(1, int(random.integers(1, 6))):
            turns.append((i, t, str(random.choice(["user", "assistant"])), str(random.choice(texts, p=[0.6, 0.1, 0.1, 0.05, 0.1, 0.05]))))
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    assert Counter(preferences_found(rows)) == Counter(brute_preferences(turns))


@pytest.mark.parametrize("choose", ["norm", "dot"])
@pytest.mark.parametrize("pieces,attention", [(None, None), (3, None), (None, 2048**2 // 2)])
def test_plan_respects_every_capacity(choose, pieces, attention):
    random = np.random.default_rng(1)
    counts = {int(k): int(v) for k, v in zip(random.choice(np.arange(1, 1400), 200, replace=False), random.integers(1, 50, 200))}
    cap = Capacities(2048, pieces, attention, choose=choose)
    bins = defaultdict(list)
    for length, _first, count, sequence, offset in plan_bins(counts, cap):
        for i in range(count):
            bins[sequence + i].append((offset, length))
    assert Counter(n for b in bins.values() for _, n in b) == Counter(counts)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048 and len(b) <= (pieces or 2048) and sum(n * n for _, n in b) <= (attention or 2048**2)


def test_bpe_as_the_library(docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    rows = decode_ids(encoded, RANKS).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id) or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r.bytes).decode() == text


def test_encoders_on_odd_white_space(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)  # so that much is forgotten
    rng = np.random.default_rng(1)
    letters = list(" \t\n\r\x1c\x85\xa0\u2003\u3000 ab'sré1½#<|>.\u0301")
    texts = ["".join(rng.choice(letters, rng.integers(40))) for _ in range(3000)]
    texts += ["", " ", "x" * 5000, "a b " * 3, "one <|endoftext|> two"]
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    ranks = byte_bpe.ByteBpe(RANKS)
    library = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=ranks.ranks, special_tokens={})
    own = byte_bpe.TextEncoder(pattern, lambda piece: ranks.encode(piece.encode()))
    assert [np.frombuffer(own(t), "<u4").tolist() for t in texts] == [library.encode_ordinary(t) for t in texts]
    tokenizer = Tokenizer.from_file(path)
    own = packing._encoder(path, pattern)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(own(t), "<u4").tolist() for t in texts] == expected


ODD_CHARACTERS = [*" \t\n\r\v\f", "'", "'s", "'ll", "'ve", *"sdmabBZ019(.#é½²٣ªµßſƀ×÷Āжя中ॐ😀“", *"\x00\x1c\x7f\x85\xa0\u0301\u200b\u2003\u3000"]


def test_cuts_are_ends_of_matches():
    """Each stretch between two cuts has by itself the matches that it has in its text."""
    rng = np.random.default_rng(2)
    matches = regex.compile(public_tokenizers.PATTERN).findall
    assert byte_bpe.TextEncoder(public_tokenizers.PATTERN, lambda _: []).by_class
    for _ in range(4000):
        texts = ["".join(rng.choice(ODD_CHARACTERS, rng.integers(14))) for _ in range(3)]
        raw = "".join(texts).encode()
        edges = np.cumsum([0, *[len(t.encode()) for t in texts]])
        for by_class in (False, True) if raw else ():
            cuts = byte_bpe._cuts(np.frombuffer(raw, np.uint8), edges, by_class)
            stretches = [raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            assert [m for x in stretches for m in matches(x)] == [m for t in texts for m in matches(t)]


@pytest.mark.parametrize("remembered", [20, 500_000])
@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, rf"(?:{public_tokenizers.PATTERN})"])
def test_columns_as_the_library(monkeypatch, remembered, pattern):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(ODD_CHARACTERS, rng.integers(40))) for _ in range(1500)]
    texts += ["", None, " ", "x" * 5000, "a b " * 3, "ends ", " begins", "<|endoftext|>", "one <|endoftext|> two"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (1, 300, 1 << 23):
        monkeypatch.setattr(byte_bpe, "GROUPED", size)
        own = packing.LibraryEncoder(path, pattern, remembered)
        for kind in (pa.string(), pa.large_string()):
            found = own.of_column(pa.array(["cut off ", *texts], kind).slice(1))
            assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected
        assert 0 < len(own.stretches.texts) == len(own.stretches.ids) <= remembered
        assert list(own.of_column(pa.array([], pa.string()))) == []


def test_columns_encode_each_stretch_once():
    encoded = []
    own = byte_bpe.TextEncoder(public_tokenizers.PATTERN, lambda piece: encoded.append(piece) or list(piece.encode()))
    texts = ["to be, or not to be: that is", "to be or not", "(be) " + "q" * 65, None]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").astype(np.uint8).tobytes().decode() for x in own.of_column(pa.array(texts))] == [t or "" for t in texts]
    assert encoded.pop() == " " + "q" * 65  # too long to be remembered
    assert len(encoded) == len(set(encoded)) and " be" in encoded and "," in encoded


def test_kneser_ney_sums_to_one(spark):
    """Over all known words and one unknown, the model's probabilities after any word make one."""
    texts = [(i, " ".join(f"w{(i * j) % 7}" for j in range(1, 30))) for i in range(60)]
    model = kneser_ney.train(spark, spark.createDataFrame(texts, "doc_id long, text string"))
    words = np.append(np.unique(np.concatenate([kneser_ney.tokens_of(t) for _, t in texts])), np.uint64(12345))
    for context in words.tolist() + [int(kneser_ney.START)]:
        before = np.full(len(words), context, np.uint64)
        scored = kneser_ney._scored_together(model, words, before, np.arange(len(words)))
        assert math.isclose(sum(10**s for *_, s in scored), 1.0, rel_tol=1e-9)


def test_kneser_ney_as_plain_python(spark, docs):
    random = np.random.default_rng(9)
    texts = [(i, " ".join(f"W{x}" for x in random.zipf(1.4, random.integers(1, 80)) if x < 400)) for i in range(200)]
    rows = [(*r[:2], None, None) for r in texts] + ROWS
    held_out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda text: ["<s>", *(w.decode() for w in (text or "").encode().lower().split()), "</s>"]
    grams = Counter(g for i, text, *_ in rows if not held_out(i) for t in [tokens(text)] for g in zip(t, t[1:], strict=False))
    words, contexts, followers = Counter(), Counter(), defaultdict(list)
    for (a, b), n in grams.items():
        words[b] += n
        contexts[b] += 1
        followers[a].append(n)
    discounts = lambda counts: kneser_ney.discounts_of([sum(n == i for n in counts) for i in (1, 2, 3, 4)])
    high, low = discounts(grams.values()), discounts(contexts.values())
    less = lambda n, ds: ds[min(n, 3) - 1] if n else 0
    spare = sum(less(n, low) for n in contexts.values()) / len(grams) / (len(words) + 1)

    def probability(a, b):
        lower = (contexts[b] - less(contexts[b], low)) / len(grams) + spare
        if a not in followers:
            return lower
        own = followers[a]
        return (grams[a, b] - less(grams[a, b], high) + sum(less(n, high) for n in own) * lower) / sum(own)

    found = kneser_ney.op7_kneser_ney(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    total = sum(words.values())
    want = []
    for i, text, *_ in rows:
        t = tokens(text)
        base = sum(math.log10((words[b] + 1) / (total + len(words) + 1)) for b in t[1:])
        score = sum(math.log10(probability(a, b)) for a, b in zip(t, t[1:], strict=False))
        want.append((i or -1, held_out(i), len(t) - 1, sum(b in words for b in t[1:]), total, base, score))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_kneser_ney_hashes_words_together(monkeypatch):
    """Tokens are words at ASCII white space, whatever lies around; only long words are hashed one by one."""
    rng = np.random.default_rng(5)
    letters = list(" \t\n\x0b\x0c\r\x1c\x85\xa0\u2003 aAbB\x00é")
    texts = ["".join(rng.choice(letters, rng.integers(40))) for _ in range(2000)]
    texts += [None, "", " ", "x" * 64 + " " + "x" * 65, "Y" * 200, "x" * 8 + " " + "x" * 9, "a\x00 a", " start", "end "]
    singly = []
    monkeypatch.setattr(kneser_ney, "word_hashes", lambda words: singly.extend(words) or word_hashes(words))
    want = [w for t in texts for w in [*(t or "").encode().lower().split(), None]]
    for size in (1, 50, 1 << 21):
        monkeypatch.setattr(kneser_ney, "GROUPED", size)
        for kind in (pa.string(), pa.large_string()):
            singly.clear()
            groups = list(kneser_ney.groups_of(pa.array(["cut off", *texts], kind).slice(1)))
            tokens = np.concatenate([g[0] for g in groups]).tolist()
            assert len(set(zip(tokens, want, strict=True))) == len(set(tokens)) == len(set(want))
            assert sorted(singly) == [b"x" * 65, b"y" * 200]
            assert sum(len(g[2]) for g in groups) == len(texts)
            for own, before, starts in groups:
                assert before[0] == kneser_ney.START and all(before[starts] == kneser_ney.START)
                assert all((before[1:] == own[:-1]) | (own[:-1] == kneser_ney.END))
                words, at, context = kneser_ney.coded(own, before, starts)
                assert (words[at] == own).all() and (words[context] == before).all()


def test_kneser_ney_packs_grams(monkeypatch):
    """A task hands on one row per shard, not one per gram, and no gram is lost when it does so in parts."""
    rng = np.random.default_rng(6)
    texts = pa.array([" ".join(f"w{x}" for x in rng.zipf(1.3, 300) if x < 5000) for _ in range(60)])
    monkeypatch.setattr(kneser_ney, "GROUPED", 2000)
    want = Counter(kneser_ney.gram_of(*[np.concatenate(x) for x in list(zip(*kneser_ney.groups_of(texts), strict=True))[1::-1]]).tolist())
    for held in (1 << 20, 1000):
        monkeypatch.setattr(kneser_ney, "HELD", held)
        batches = list(kneser_ney._packed(8)(iter([pa.record_batch([texts], ["text"])])))
        assert (len(batches) > 1) == (held == 1000) and all(0 < b.num_rows <= 8 for b in batches)
        got = Counter()
        for row in (r for b in batches for r in b.to_pylist()):
            once, more = np.frombuffer(row["once"], np.uint64), np.frombuffer(row["more"], np.uint64)
            assert set(kneser_ney.shard_of(np.append(once, more), 8).tolist()) == {row["shard"]}
            got.update(once.tolist())
            got.update(dict(zip(more.tolist(), np.frombuffer(row["counts"], np.int64).tolist(), strict=True)))
        assert got == want


def test_kneser_ney_in_many_shards(spark, docs, monkeypatch):
    scored = lambda: sorted(map(str, kneser_ney.op7_kneser_ney(spark, docs).collect()))
    one = scored()
    monkeypatch.setattr(kneser_ney, "PER_SHARD", 32)
    assert scored() == one


def test_shards(spark, docs):
    rows = sharding.op8_shard_by_bytes(spark, docs).collect()
    texts = {r[0]: r[1] or "" for r in ROWS}
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        (r[0] or -1, len(texts[r[0]].encode()) + 1, zlib.crc32(texts[r[0]].encode())) for r in ROWS
    )
    for shard in {r.shard for r in rows}:
        own = [r.slot for r in rows if r.shard == shard]
        assert sorted(own) == list(range(len(own)))


def test_ablations(docs):
    ledger = quality_ledger.measure(docs)
    bits = [r.failed for r in ledger.collect()]
    for r in quality_ledger.ablations(ledger, "v1").collect():
        bit = 1 << quality_ledger.RULES.index(r.rule)
        assert r.failing == sum(bool(b & bit) for b in bits) and r.rejected_by_it_alone == sum(b == bit for b in bits)


def test_near_copies_in_a_large_bucket(spark, monkeypatch):
    random = np.random.default_rng(0)
    base = [f"w{i}" for i in range(400)]
    rows = [(1000 + i, " ".join(f"v{x}" for x in random.integers(0, 10**6, 100))) for i in range(50)]
    for i in range(60):
        words = list(base)
        for j in random.integers(0, 400, random.integers(0, 30)):
            words[j] = f"e{random.integers(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(5000, rows[0][1]), (5001, None), (5002, ""), (5003, "one"), (5004, "one")]
    monkeypatch.setattr(minhash_icws, "BLOCK", 16)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash_icws.op10_minhash_icws(spark, docs).collect()}
    weights = minhash_icws.weigh(docs.withColumnRenamed("doc_id", "id"), minhash_icws.Settings())
    vectors = {i: weights.shingles(t) for i, t in rows if t}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in vectors:
        for b in vectors:
            if a < b and minhash_icws.weighted_jaccard(vectors[a], vectors[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert found == {i: root(i) for i in parent}


def test_open_buckets_compare_all_that_is_not_one_class_yet(spark, monkeypatch):
    """One bucket of a class of 14 texts and 23 others, in blocks of 4: pairs within the class and only these need no link."""
    monkeypatch.setattr(minhash_icws, "BLOCK", 4)
    random = np.random.default_rng(3)
    rows = []
    for i in range(37):
        words = [f"f{i % 5 if i >= 14 else 0}w{j}" for j in range(120)]
        for j in random.integers(0, 120, 2):
            words[j] = f"e{random.integers(10**6)}"
        rows.append((i, " ".join(words)))
    texts = spark.createDataFrame(rows, "id long, text string")
    weights = minhash_icws.weigh(texts, minhash_icws.Settings())
    vectors = {i: weights.shingles(t) for i, t in rows}
    classes = {i: 0 if i < 14 else i for i, _ in rows}
    bucket = spark.createDataFrame([(0, 7, i, c) for i, c in classes.items()], "band int, hash long, id long, class_id long")

    def least_of(links):
        least = dict(classes)
        while True:
            before = dict(least)
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
            for i in least:
                least[i] = min(least[i], least[classes[i]])
            if least == before:
                return least

    alike = [
        (a, b) for a in vectors for b in vectors if a < b and minhash_icws.weighted_jaccard(vectors[a], vectors[b]) >= 0.8
    ]
    found = [tuple(r) for r in minhash_icws._open_buckets(texts, bucket, weights).collect()]
    assert least_of(found) == least_of(alike)
    assert len(set(least_of(alike).values())) > 1


def test_pipeline_rows_as_plain_python(spark, tmp_path):
    random = np.random.default_rng(10)
    vocabulary = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), random.integers(3, 9))) for _ in range(3000)]
    prose = lambda n: [str(w) for w in random.choice(vocabulary, n, replace=False)]
    words = {i: prose(int(random.integers(60, 200))) for i in range(30)}
    shared = prose(40)
    words[3], words[9], words[17] = prose(50) + shared + prose(50), prose(60) + shared, shared + prose(70)
    words |= {40: words[5], 41: [*words[6][:-1], "changed"], 42: prose(9), 43: [], 44: prose(2900)}
    texts = {i: " ".join(w) for i, w in words.items()}
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", "web", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    good = {i: t for i, t in texts.items() if len(t.split()) >= 10}  # the other rules meet nothing here
    weights = minhash_icws.weigh(spark.createDataFrame(list(good.items()), "id long, text string"), minhash_icws.Settings())
    vectors = {i: weights.shingles(t) for i, t in good.items()}
    alike = lambda a, b: minhash_icws.weighted_jaccard(vectors[a], vectors[b]) >= 0.8
    single = {i: t for i, t in good.items() if not any(a < i and alike(a, i) for a in good)}  # classes are of two
    assert good.keys() - single.keys() == {40, 41} and texts.keys() - good.keys() == {42, 43}
    order = list(single)
    gone = {order[at]: places for at, places in brute_spans(list(single.items())).items()}
    gone = {i: gone.get(i, set()) for i in order}
    assert {i for i, places in gone.items() if places} == {9, 17}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, total = [], 0
    for i, t in single.items():
        kept = " ".join(w for at, w in enumerate(t.split()) if at not in gone[i])
        ids = [*tokenizer.encode(kept, add_special_tokens=False).ids, 0]
        total += len(ids)
        edges = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(i, n, a, b - a, binascii.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
    assert len(want) > len(single)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:at]) for at in range(len(own))] and sum(n for _, n in own) <= 2048
    assert sorted(sequences) == list(range(len(sequences))) and len(sequences) <= 2 * -(-total // 2048)
