"""A Merkle manifest of a dataset: postorder logs of hashes, proofs addressed by closed-form positions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tablesync.llm.words import numbered, written

#: A builder takes 2**LEVELS consecutive nodes, so it holds twice as many digests of 32 bytes.
LEVELS = 8
#: What a step of a path says: the sibling stands left, right, or there is none.
LEFT, RIGHT, NONE = b"\x00", b"\x01", b"\x02"
_STEP = 33


def digest(*children: bytes) -> bytes:
    """SHA-256 of the children's digests as lowercase hex, joined."""
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def heights(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


def position(n: int, level: int, index: int) -> int:
    """Where the node ``index`` of a level stands in the postorder log of n leaves.

    The first m leaves complete ``2m - popcount(m)`` nodes, the sizes of the full subtrees in m's
    binary form. A full node of ``2**level`` leaves is completed by its last leaf, after its
    descendants there. Nodes with leaves missing, one at most on a level, are closed at
    the end from the lowest up.
    """
    last = ((index + 1) << level) - 1
    if last < n:
        return 2 * last - last.bit_count() + level
    return 2 * n - n.bit_count() + sum(1 for above in range(1, level) if n & ((1 << above) - 1))


def build_log(leaves: list[bytes], top: int) -> list[bytes]:
    """All nodes up to the level ``top`` in the order in which they are completed.

    A stack holds one open subtree per level. At the end, what is open is closed level by level;
    a node without a right sibling is hashed alone.
    """
    log: list[bytes] = []
    open_nodes: list[tuple[int, bytes]] = []
    for leaf in leaves:
        level, node = 0, leaf
        log.append(node)
        while level < top and open_nodes and open_nodes[-1][0] == level:
            node, level = digest(open_nodes.pop()[1], node), level + 1
            log.append(node)
        open_nodes.append((level, node))
    level, node = open_nodes.pop()
    while level < top:
        if open_nodes and open_nodes[-1][0] == level:
            node = digest(open_nodes.pop()[1], node)
        else:
            node = digest(node)
        level += 1
        log.append(node)
    return log


def path_in_log(log: bytes, n: int, index: int, top: int) -> bytes:
    """The steps from a leaf up to the level ``top``, each a side and the sibling's digest."""
    steps = []
    for level in range(top):
        sibling = (index >> level) ^ 1
        if sibling << level >= n:
            steps.append(NONE + bytes(32))
            continue
        at = 32 * position(n, level, sibling)
        steps.append((LEFT if sibling < index >> level else RIGHT) + log[at : at + 32])
    return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    """The siblings' digests on a path, from the leaf up."""
    steps = (path[i : i + _STEP] for i in range(0, len(path), _STEP))
    return [s[1:] for s in steps if s[:1] != NONE]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the path above it give."""
    node = leaf
    for i in range(0, len(path), _STEP):
        side, other = path[i : i + 1], path[i + 1 : i + _STEP]
        node = digest(node) if side == NONE else digest(other, node) if side == LEFT else digest(node, other)
    return node


@dataclass(frozen=True)
class Forest:
    """Trees by name: the log of each round, and a root per tree.

    A round's segments have a row per builder: ``tree``, ``chunk``, ``n`` (the nodes of the tree that entered the
    round), ``leaves`` (how many of them are here), ``top`` (levels built), ``log`` (digests in completion order), ``node`` (the last of them) and,
    in the first round, the lists of what was carried beside the leaves.
    """

    rounds: list[DataFrame]
    roots: DataFrame  # tree, root


def _builder(levels: int, carried: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("index").combine_chunks()
        n = rows["n"][0].as_py()
        top = min(levels, heights(n))  # the only builder of a tree ends at its root
        log = build_log(rows["node"].to_pylist(), top)
        out = {
            "tree": pa.array(rows["tree"][:1].to_pylist(), pa.string()),
            "chunk": pa.array([rows["index"][0].as_py() >> levels], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "leaves": pa.array([len(rows)], pa.int64()),
            "top": pa.array([top], pa.int32()),
            "log": pa.array([b"".join(log)], pa.binary()),
            "node": pa.array([log[-1]], pa.binary()),
        }
        for c in carried:
            values = rows[c].chunk(0) if rows[c].num_chunks else pa.array([], rows[c].type)
            out[c] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.table(out)

    return run


def build(spark: SparkSession, leaves: DataFrame, carried: list[str] | None = None, levels: int = LEVELS) -> Forest:
    """The trees over ``leaves`` (tree, index, n, node), all trees and all builders at once.

    Each round takes aligned runs of ``2**levels`` nodes to one builder each, which appends the nodes above them to
    its segment of the log as they are completed; only the top of each run goes on to the next round.
    A tree of n leaves takes ``log2(n) / levels`` rounds, and no task gets more than a run.
    """
    carried, rounds = carried or [], []
    schema = StructType().add("tree", "string").add("chunk", "long").add("n", "long").add("leaves", "long")
    schema = schema.add("top", "integer").add("log", "binary").add("node", "binary")
    rows, finished = leaves, []
    while True:
        own = carried if not rounds else []
        with_lists = StructType(list(schema.fields))
        for c in own:
            with_lists = with_lists.add(c, ArrayType(leaves.schema[c].dataType))
        kept = rows.select("tree", "index", "n", "node", *own)
        runs = kept.groupBy("tree", F.shiftright("index", levels).alias("run")).applyInArrow(_builder(levels, own), with_lists)
        rounds.append(written(spark, runs, f"merkle-log-{len(rounds)}"))
        done = F.col("n") <= 1 << levels
        finished.append(rounds[-1].where(done).select("tree", F.col("node").alias("root")))
        open_rows = rounds[-1].where(~done)
        if open_rows.isEmpty():
            break
        rows = open_rows.select(
            "tree", F.col("chunk").alias("index"), F.shiftright(F.col("n") + (1 << levels) - 1, levels).alias("n"), "node"
        )
    roots = finished[0]
    for more in finished[1:]:
        roots = roots.unionByName(more)
    return Forest(rounds, roots)


def paths(
    spark: SparkSession, forest: Forest, above: DataFrame, levels: int = LEVELS, extract: Callable | None = None,
    schema: str | None = None,
) -> DataFrame:
    """What ``extract`` makes of each segment of the first round and the path above it.

    ``above`` has a ``tree``, the ``path`` over its root and a ``root`` to hand down. Paths are handed from
    the last round's segments down to the first round's: each segment reads its own nodes' siblings at
    their positions in its log and adds the path above. A path is met by one run of segments, never by all of a tree.
    ``extract(segment, path, root)`` gives a table's rows; by default a row (tree, index, path, root) per leaf.
    """
    extract = extract or leaf_paths
    schema = schema or "tree string, index long, path binary, root binary"
    upper = None
    for r in reversed(range(len(forest.rounds))):
        segments = forest.rounds[r]
        single = segments.where(F.col("n") <= 1 << levels).select("tree", "chunk")
        here = single.join(above, "tree").select("tree", "chunk", "path", "root")
        upper = here if upper is None else here.unionByName(upper)
        upper = upper.select(F.col("tree").alias("t"), F.col("chunk").alias("c"), "path", "root")
        both = segments.join(upper, (segments["tree"] == F.col("t")) & (segments["chunk"] == F.col("c"))).drop("t", "c")
        if r:
            slim = both.select("tree", "chunk", "leaves", "top", "log", "path", "root")
            lower = slim.mapInArrow(_rows_of(leaf_paths, levels), "tree string, index long, path binary, root binary")
            upper = written(spark, lower.withColumnRenamed("index", "chunk"), f"merkle-paths-{r}")
        else:
            return both.drop("node", "n").mapInArrow(_rows_of(extract, levels), schema)
    raise ValueError("a forest has at least one round")


def _rows_of(extract: Callable, levels: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                segment["first"] = segment["chunk"] << levels
                yield extract(segment)

    return run


def leaf_paths(segment: dict) -> pa.RecordBatch:
    """A row per node that entered the segment, with the path from it to the root of all."""
    log, n, top = segment["log"], segment["leaves"], segment["top"]
    own = [path_in_log(log, n, i, top) + segment["path"] for i in range(n)]
    columns = [
        pa.array([segment["tree"]] * n, pa.string()),
        pa.array([segment["first"] + i for i in range(n)], pa.int64()),
        pa.array(own, pa.binary()),
        pa.array([segment["root"]] * n, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["tree", "index", "path", "root"])


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    """The digest of a row's fields, 32 bytes."""
    return F.unhex(F.sha2(F.encode(F.concat(*map(field, columns)), "UTF-8"), 256))


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups, and the tree over their roots."""

    groups: Forest
    top: Forest
    root: bytes | None


def manifest(
    spark: SparkSession, docs: DataFrame, group: str = "lang", order: str = "doc_id",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: Column | None = None,
    levels: int = LEVELS,
) -> Manifest:
    """A tree per group over its rows in the order of ``order``, and one over the groups' roots.

    A null ``order`` comes first. Rows that share it stand in the order of their digests; rows that repeat in full are leaves
    each. The null group is a group of its own and comes first, the others follow bytewise. An empty table has no root.
    Columns that are not fields are not looked at. ``changed`` is a second digest to carry beside each leaf.

    Only digests and ids are moved: the texts are read once, where they lie.
    """
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("tree"),
        F.col(order).alias("key"),
        leaf_of([F.col(c) for c in fields]).alias("node"),
        (F.lit(None).cast("binary") if changed is None else changed).alias("changed"),
        F.monotonically_increasing_id().alias("read_at"),  # tells repeated rows apart, so that they can be spread
    )
    leaves = written(spark, leaves, "merkle-leaves")
    placed = numbered(spark, leaves, ["key", "node", "read_at"])
    groups = build(spark, placed.select("tree", "index", "n", "node", "key", "changed"), ["key", "changed"], levels)
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("node"))
    above = numbered(spark, written(spark, roots, "merkle-roots"), ["group"])
    top = build(spark, above.select("tree", "index", "n", "node", "group"), ["group"], levels)
    found = top.roots.first()
    return Manifest(groups, top, None if found is None else bytes(found["root"]))


def group_paths(spark: SparkSession, m: Manifest, levels: int = LEVELS) -> DataFrame:
    """Per group its ``root`` and the ``path`` from there to the root of all."""
    start = m.top.roots.select("tree", F.lit(b"").alias("path"), "root")
    schema = "tree string, path binary, root binary"
    return written(spark, paths(spark, m.top, start, levels, _group_rows, schema), "merkle-group-paths")


def _group_rows(segment: dict) -> pa.RecordBatch:
    log, n, top = segment["log"], segment["leaves"], segment["top"]
    own = [path_in_log(log, n, i, top) + segment["path"] for i in range(n)]
    nodes = [log[32 * position(n, 0, i) :][:32] for i in range(n)]
    columns = [pa.array(segment["group"], pa.string()), pa.array(own, pa.binary()), pa.array(nodes, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["tree", "path", "root"])


def proofs(spark: SparkSession, m: Manifest, key_type: str, levels: int = LEVELS) -> DataFrame:
    """Per leaf its key, digests, the digest of its proof, and the root its changed or own digest folds to.

    ``leaf``, ``subroot``, ``root``, ``proof_sha256`` and ``folded_root`` are lowercase hex; ``verified`` says whether
    the folded root is the root.
    """
    root = m.root

    def rows(segment: dict) -> pa.RecordBatch:
        log, n, top = segment["log"], segment["leaves"], segment["top"]
        out = []
        for i in range(n):
            at = 32 * position(n, 0, i)
            leaf, path = log[at : at + 32], path_in_log(log, n, i, top) + segment["path"]
            folded = fold(segment["changed"][i] or leaf, path)
            out.append((leaf.hex(), segment["root"].hex(), root.hex(), digest(*siblings(path)).hex(), folded.hex(), folded == root))
        columns = [pa.array(segment["key"], wire), *map(pa.array, zip(*out, strict=True))]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    wire = pa.string() if key_type == "string" else pa.int64() if key_type == "bigint" else None
    return paths(spark, m.groups, group_paths(spark, m, levels), levels, rows, schema)


def op13_merkle_manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The proof of every document, folded from a tampered leaf where 7 divides the crc32 of its id.

    Documents without an id are not tampered with. An empty table gives no rows. See ``manifest`` for odd rows.
    """
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    m = manifest(spark, docs, changed=F.when(hit & F.col("n_chars").isNotNull(), tampered))
    return proofs(spark, m, docs.schema["doc_id"].dataType.simpleString())


_CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
  string_split(regexp_replace(hex(encode(doc_id::VARCHAR)), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda x: ('0x' || x)::UBIGINT)),
  lambda a, b: xor(crc_table[(xor(a, b) & 255)::BIGINT + 1], a >> 8)))"""

#: Levels as lists by recursion; a proof's steps as texts, first the side and then the sibling, folded from the leaf up.
SQL = f"""
WITH RECURSIVE bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS step FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crcs AS (SELECT list(c ORDER BY i) AS crc_table FROM bits WHERE step = 8),
parts AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS front, coalesce(strlen(text) || ':' || text, '-') AS back,
    doc_id IS NOT NULL AND {_CRC32} % 7 = 0 AS hit FROM documents, crcs),
leaves AS (SELECT doc_id, tree, sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
    sha256(front || coalesce(strlen((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT), '-') || back) AS used FROM parts),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
levels AS (SELECT tree, 0 AS h, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY tree
  UNION ALL SELECT tree, h + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda j: sha256(nodes[2 * j + 1] || coalesce(nodes[2 * j + 2], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS k FROM levels WHERE len(nodes) = 1),
tops AS (SELECT 0 AS h, list(subroot ORDER BY k) AS nodes FROM subroots
  UNION ALL SELECT h + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda j: sha256(nodes[2 * j + 1] || coalesce(nodes[2 * j + 2], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (SELECT tree, i, h, CASE WHEN (i >> h) % 2 = 1 THEN 'L' || nodes[i >> h] ELSE coalesce('R' || nodes[(i >> h) + 2], 'N') END AS step
  FROM placed JOIN levels USING (tree) WHERE len(nodes) > 1),
top_steps AS (SELECT tree, h, CASE WHEN (k >> h) % 2 = 1 THEN 'L' || nodes[k >> h] ELSE coalesce('R' || nodes[(k >> h) + 2], 'N') END AS step
  FROM subroots, tops WHERE len(nodes) > 1),
lower_paths AS (SELECT tree, i, list(step ORDER BY h) AS path FROM steps GROUP BY tree, i),
upper_paths AS (SELECT tree, list(step ORDER BY h) AS path FROM top_steps GROUP BY tree),
whole AS (SELECT p.doc_id, p.leaf, p.used, s.subroot,
    list_concat(coalesce(l.path, []::VARCHAR[]), coalesce(u.path, []::VARCHAR[])) AS path
  FROM placed p JOIN subroots s USING (tree) LEFT JOIN lower_paths l ON l.tree = p.tree AND l.i = p.i
  LEFT JOIN upper_paths u ON u.tree = p.tree),
folded AS (SELECT *, list_reduce(list_prepend(used, path), lambda a, s: CASE left(s, 1)
    WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root,
    (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root FROM whole)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(list_filter(path, lambda s: s <> 'N'), lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded
"""
