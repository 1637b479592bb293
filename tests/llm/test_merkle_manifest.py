"""The Merkle manifest against a plain recursive one, on odd rows and every small size."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tablesync.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, `index` long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    fields = [row[0], row[3], row[2], row[4], row[1]]  # doc_id, source, lang, n_chars, text
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf its steps as (side, sibling)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, j in enumerate(at):
            other = j ^ 1
            side = "" if other >= len(nodes) else "L" if other < j else "R"
            steps[i].append((side, nodes[other] if side else ""))
            at[i] = j >> 1
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], steps


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf_of(r))))
        trees[g] = own, *climb([leaf_of(r) for r in own])
    root, upper = climb([trees[g][1] for g in order])
    out = []
    for g, above in zip(order, upper, strict=True):
        own, subroot, steps = trees[g]
        for row, lower in zip(own, steps, strict=True):
            used = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                used = (*row[:4], row[4] + 1)
            node = leaf_of(used)
            for side, other in lower + above:
                node = sha(other + node if side == "L" else node + other)
            proof = sha("".join(other for _, other in lower + above))
            out.append((row[0], leaf_of(row), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("n", [*range(1, 36), 64, 100, 127, 128, 129])
def test_closed_form_positions(n):
    """Every node stands where the closed form says, whatever the number of leaves."""
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    log = mm.build_log(leaves, mm.heights(n))
    level, nodes = 0, leaves
    count = 0
    while True:
        for index, node in enumerate(nodes):
            assert log[mm.position(n, level, index)] == node
            count += 1
        if len(nodes) == 1:
            break
        nodes = [mm.digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        level += 1
    assert count == len(log)


def odd_rows():
    rows = [(i * 3, f"text {i}", "en" if i % 3 else "de", "s", i) for i in range(75)]
    rows += [(7, "same", "en", "x", 4)] * 9  # rows repeated in full
    rows += [(7, "other", "en", None, 4), (None, "no id", "en", "s", 5), (None, None, None, None, None)]
    rows += [(21, "", "", "", 0), (22, "ünï ☃\n", "ä", "s", -3), (23, "alone", "zz", "s", 2**63 - 1), (24, "x" * 100_000, None, "s", 7)]
    rows += [(i, "t", f"lang{i}", "s", 1) for i in range(100, 120)]
    return [(*r, "tree", 5) for r in rows]


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_equals_brute_force(spark, levels):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if levels == 8:
        got = mm.op13_merkle_manifest(spark, docs)
    else:
        from pyspark.sql import functions as F

        more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
        changed = mm.leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
        hit = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0) & F.col("n_chars").isNotNull()
        m = mm.manifest(spark, docs, changed=F.when(hit, changed), levels=levels)
        got = mm.proofs(spark, m, "bigint", levels)
    assert rows_of(got) == brute([r[:5] for r in rows])


def test_only_tampered_rows_fail(spark):
    rows = odd_rows()
    found = mm.op13_merkle_manifest(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in found if not r.verified} == {
        r[0] for r in rows if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    }


def test_one_row_and_no_rows(spark):
    one = [(1, "t", "en", "s", 1, None, None)]
    assert rows_of(mm.op13_merkle_manifest(spark, spark.createDataFrame(one, SCHEMA))) == brute([one[0][:5]])
    assert mm.op13_merkle_manifest(spark, spark.createDataFrame([], SCHEMA)).collect() == []
