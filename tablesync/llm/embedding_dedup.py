"""Near copies among embeddings by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.components import components
from tablesync.llm.words import row_keyed, with_doc_id, written

#: Vectors of one class that are compared in one task. Larger classes take several blocks.
BLOCK = 1024
#: Vectors of one bucket that are ordered together.
CROWDED = 10_000


@dataclass(frozen=True)
class Settings:
    """Links of ``similarity`` or more, exact on what is compared.

    The first graph comes from ``tables`` random cuts of space, in each of which a vector
    meets the ``reach`` next ones of its bucket. Lists hold the best ``neighbours`` of ``floor`` or more. A
    list full of links is saturated and may grow to ``most_neighbours``. ``queries`` vectors are
    checked against all others. The search goes on with other cuts until these bring no new link between
    classes and ``recall`` of the audited links is found, among vectors of few links as among those of many.
    After ``rounds`` rounds each further one has twice the ``reach``, so that in the end whole buckets are compared.
    """

    similarity: float = 0.95
    tables: int = 12
    reach: int = 12
    neighbours: int = 8
    most_neighbours: int = 32
    floor: float = 0.7
    descents: int = 6
    queries: int = 1000
    recall: float = 0.999
    rounds: int = 4


def unit_vectors(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """The rows of a binary column of doubles as a matrix."""
    return np.frombuffer(b"".join(batch.column(at).to_pylist()), np.float64).reshape(batch.num_rows, -1)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, vectors = [], []
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.array(vector, np.float64)
            x = x / np.abs(x).max()  # neither overflow nor underflow in the squares
            keys.append(key)
            vectors.append((x / math.sqrt(float(x @ x)) + 0.0).tobytes())  # + 0.0: no negative zeros
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(vectors, pa.binary())], ["id", "vec"])


def comparable(vectors: DataFrame) -> DataFrame:
    """id and unit vector of what can be linked: no nulls, not zero, all components finite."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.where(F.col("embedding").isNotNull() & good & some).mapInArrow(_units, "id long, vec binary")


def _cuts(settings: Settings, turn: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            sizes = [len(v) for v in batch.column(1).to_pylist()]
            for i, size in enumerate(sizes):
                by_size.setdefault(size, []).append(i)
            for size, rows in by_size.items():
                part = batch.take(pa.array(rows))
                x = unit_vectors(part, 1)
                random = np.random.default_rng([turn, size])  # the same cuts in every task
                for cut in range(settings.tables):
                    planes, line = random.standard_normal((size // 8, bits)), random.standard_normal(size // 8)
                    code = ((x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))) * 100_003 + size
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), cut), pa.int32()), pa.array(code), pa.array(x @ line), part.column(0), part.column(1)],
                        ["cut", "bucket", "line", "id", "vec"],
                    )

    return run


def _next_ones(settings: Settings):
    """Compare each row with the next ones of its bucket, as rows stream by in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = held + list(zip(*[batch.column(c).to_pylist() for c in ("cut", "bucket", "salt", "id", "vec")], strict=True))
            yield _pairs_of(rows, len(held), settings)
            held = rows[-settings.reach :]

    return run


def _pairs_of(rows: list[tuple], old: int, settings: Settings) -> pa.RecordBatch:
    """Links and near links between rows at most ``reach`` apart; pairs of the ``old`` first rows were given before."""
    found = []
    size = [len(r[4]) for r in rows]
    start = 0
    while start < len(rows):
        stop = start
        while stop < len(rows) and size[stop] == size[start]:
            stop += 1
        part = rows[start:stop]
        x = np.frombuffer(b"".join(r[4] for r in part), np.float64).reshape(len(part), -1)
        _, key = np.unique([hash(r[:3]) for r in part], return_inverse=True)
        ids = np.array([r[3] for r in part])
        for step in range(1, min(settings.reach, len(part) - 1) + 1):
            i = np.flatnonzero((key[:-step] == key[step:]) & (np.arange(len(part) - step) + step + start >= old))
            similarity = np.einsum("ij,ij->i", x[i], x[i + step])
            good = similarity >= settings.floor
            found.append((ids[i[good]], ids[i[good] + step], similarity[good]))
        start = stop
    a, b, s = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64()), pa.array(s)], ["a", "b", "s"])


def first_graph(spark: SparkSession, units: DataFrame, settings: Settings, turn: int, n: int) -> DataFrame:
    """Pairs (a, b, s) of similar vectors that meet in some cut."""
    bits = max(4, min(24, int(math.log2(max(n, 2) / settings.reach))))
    coded = units.mapInArrow(_cuts(settings, turn, bits), "cut int, bucket long, line double, id long, vec binary")
    coded = written(spark, coded, "cuts")
    crowded = coded.groupBy("cut", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED)
    salts = F.coalesce(F.ceil(F.col("n") / CROWDED), F.lit(1))
    # other salts in every cut and turn, so that what one separates another joins
    salt = F.pmod(F.xxhash64("id", "cut", F.lit(turn)), salts).cast("int")
    salted = coded.join(crowded, ["cut", "bucket"], "left").withColumn("salt", salt)
    ordered = salted.repartition("cut", "bucket", "salt").sortWithinPartitions("cut", "bucket", "salt", "line", "id")
    pairs = ordered.select("cut", "bucket", "salt", "id", "vec").mapInArrow(_next_ones(settings), "a long, b long, s double")
    return pairs.where("a <> b").dropDuplicates(["a", "b"])


def classed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` with class_a and class_b; what is linked with nothing yet is its own class."""
    for end in ("a", "b"):
        of_end = classes.select(F.col("id").alias(end), F.col("component").alias("found"))
        pairs = pairs.join(of_end, end, "left").withColumn(f"class_{end}", F.coalesce("found", end)).drop("found")
    return pairs


def bridged(spark: SparkSession, classes: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """``classes`` (id, component) after further links (a, b), and whether any of these was between two classes.

    What is kept of the links is what they join: pairs of classes, each once. So no
    link is lost to the bounds of lists, and the table has one row per linked vector.
    """
    between = classed(links.select("a", "b"), classes).where("class_a <> class_b")
    between = between.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
    bridges = written(spark, between.distinct(), "bridges")
    if bridges.isEmpty():
        return classes, False
    joined = written(spark, components(spark, bridges), "joined-classes")
    least = joined.select(F.col("id").alias("component"), F.col("component").alias("least"))
    old = classes.join(least, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
    new = joined.join(classes, "id", "left_anti").select("id", "component")
    return written(spark, old.unionByName(new), "vector-classes"), True


def best_lists(pairs: DataFrame, classes: DataFrame, settings: Settings, widen: int) -> DataFrame:
    """Directed lists (a, b, s): the best of each a; a saturated one may hold ``widen`` times as many.

    As many further places are for the nearest of other classes, the best one of each. These are not
    links, or the classes would be one: links inside a class, however many, leave no foreign neighbour out.
    """
    known = classed(pairs.select("a", "b", "s"), classes)
    swapped = known.select(F.col("b").alias("a"), F.col("a").alias("b"), "s", F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b"))
    best = [F.desc("s"), "b"]
    line = Window.partitionBy("a").orderBy(*best)
    ranked = known.unionByName(swapped).repartition("a")
    of_class = F.row_number().over(Window.partitionBy("a", "class_b").orderBy(*best))
    ranked = ranked.withColumn("foreign", (of_class == 1) & (F.col("class_a") != F.col("class_b")))
    ranked = ranked.withColumn("rank", F.row_number().over(line)).withColumn("foreigners", F.count_if("foreign").over(line))
    limit = min(settings.neighbours * widen, settings.most_neighbours)
    # the further places are for links: they are taken only if all before them are links, too
    own = (F.col("rank") <= settings.neighbours) | ((F.col("rank") <= limit) & (F.col("s") >= settings.similarity))
    return ranked.where(own | (F.col("foreign") & (F.col("foreigners") <= settings.neighbours))).select("a", "b", "s")


def _local_join(settings: Settings):
    """Compare what is near one vector with each other; rows come ordered by that vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, ids, vectors = None, [], []

        def compared():
            order = np.array(ids, np.int64)
            x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(ids), -1)
            s = x @ x.T
            i, j = np.nonzero(np.triu(s >= settings.floor, 1))
            return np.minimum(order[i], order[j]), np.maximum(order[i], order[j]), s[i, j]

        def batch_of(parts):
            a, b, s = (np.concatenate(c) for c in zip(*parts, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], ["a", "b", "s"])

        for batch in batches:
            parts = []
            for a, b, vec in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if a != center and ids:
                    parts.append(compared())
                    ids, vectors = [], []
                center = a
                ids.append(b)
                vectors.append(vec)
            if parts:
                yield batch_of(parts)
        if ids:
            yield batch_of([compared()])

    return run


def descend(spark: SparkSession, units: DataFrame, pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The classes after the graph is refined until nothing changes: the neighbours of each vector are compared
    with each other. Every link that a turn measures joins classes, also if the next lists have no place for it.
    """
    marks = None
    for turn in range(settings.descents):
        lists = written(spark, best_lists(pairs, classes, settings, 2**turn), "neighbours")
        now = tuple(lists.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == marks:
            break
        marks = now
        near = lists.select("a", "b").join(units.select(F.col("id").alias("b"), "vec"), "b").select("a", "b", "vec")
        ordered = near.repartition("a").sortWithinPartitions("a", "b")
        found = ordered.mapInArrow(_local_join(settings), "a long, b long, s double")
        known = lists.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s")
        pairs = written(spark, known.unionByName(found).groupBy("a", "b").agg(F.max("s").alias("s")), "refined")
        classes, _ = bridged(spark, classes, pairs.where(F.col("s") >= settings.similarity))
    return classes


def audit(units: DataFrame, settings: Settings) -> DataFrame:
    """All links (a, b) of a bounded number of vectors, chosen by hash and compared with every vector."""
    rows = units.orderBy(F.xxhash64("id"), "id").limit(settings.queries).collect()
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(r["vec"]) for r in rows}:
        own = [r for r in rows if len(r["vec"]) == size]
        x = np.frombuffer(b"".join(bytes(r["vec"]) for r in own), np.float64).reshape(len(own), -1)
        by_size[size] = np.array([r["id"] for r in own], np.int64), x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1).to_pylist()])
            for size, (ids, x) in by_size.items():
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                if part.num_rows:
                    own = part.column(0).to_numpy()
                    i, j = np.nonzero(x @ unit_vectors(part, 1).T >= settings.similarity)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(own[j])], ["a", "b"])

    return units.select("id", "vec").mapInArrow(run, "a long, b long").where("a <> b")


def recalled(truth: DataFrame, classes: DataFrame) -> float:
    """The least mean recall of the audited links (a, b) over strata of vectors a with about as many links.

    A link is found if its ends share a class, as ``count_links`` then compares them. The recall is taken per
    vector, and vectors are set apart by the power of two of their links, so a hot group does not outvote
    isolated pairs. 1 if no audited vector has links.
    """
    met = F.avg((F.col("class_a") == F.col("class_b")).cast("double"))
    of_vector = classed(truth, classes).groupBy("a").agg(met.alias("found"), F.length(F.bin(F.count("*"))).alias("stratum"))
    least = of_vector.groupBy("stratum").agg(F.avg("found").alias("found")).agg(F.min("found")).first()[0]
    return 1.0 if least is None else least


def _count_links(settings: Settings):
    """Links of each vector of one or two blocks of a class, as sums of the copies they stand for."""

    def run(table: pa.Table) -> pa.Table:
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        copies = table.column("copies").to_numpy()
        x = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(len(ids), -1)
        linked = x @ x.T >= settings.similarity
        np.fill_diagonal(linked, False)
        if block.min() != block.max():
            linked &= block[:, None] != block[None, :]
        return pa.table({"id": ids, "n": (linked @ copies).astype(np.int64)})

    return run


def count_links(members: DataFrame, settings: Settings) -> DataFrame:
    """``id`` and ``n``: the copies behind the linked vectors of its class. ``members``: component, id, vec, copies.

    All vectors of a class are compared in blocks of bounded size; what is handed on is one
    count per vector and block, not pairs.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    keys = ["component", "low", "high"]
    counted = met.groupBy(*keys).applyInArrow(_count_links(settings), "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def near_copies(spark: SparkSession, vectors: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``id``, ``n_links`` and ``component`` of each row of ``vectors`` (id, embedding), whose ids are different.

    1. Equal unit vectors are one node that stands for its copies.
    2. ``first_graph`` gives similar pairs, ``descend`` refines them; every pair measured on the way that
       reaches the threshold joins two classes (``bridged``).
    3. The search goes on with other cuts of space until these find nothing new and ``audit``, which
       measures the recall on a bounded set of vectors, finds it high enough. Its links are added.
    4. Links are counted anew inside each class, all with all in blocks, so the lists' bounds
       leave no link of a class out.
    """
    settings = settings or Settings()
    units = written(spark, comparable(vectors.select("id", "embedding")), "unit-vectors")
    copies = units.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    nodes = written(spark, copies.select(F.col("rep").alias("id"), "vec", "copies"), "nodes")
    stands = written(spark, units.join(copies, "vec").select("id", "rep", "copies"), "copies")
    bare = nodes.select("id", "vec")
    n = nodes.count()
    truth = written(spark, audit(bare, settings), "audit")
    classes = spark.createDataFrame([], "id long, component long")
    turn = 0
    while True:
        wide = replace(settings, reach=settings.reach * 2 ** max(0, turn + 1 - settings.rounds))
        pairs = written(spark, first_graph(spark, bare, wide, turn, n), "first-graph")
        classes, more = bridged(spark, classes, pairs.where(F.col("s") >= settings.similarity))
        if turn and not more and recalled(truth, classes) >= settings.recall:
            break
        classes = descend(spark, bare, pairs, classes, settings)
        turn += 1
    classes, _ = bridged(spark, classes, truth)
    counts = count_links(classes.join(nodes, "id").select("component", "id", "vec", "copies"), settings)
    of_node = stands.join(classes.select(F.col("id").alias("rep"), "component"), "rep", "left").join(
        counts.withColumnRenamed("id", "rep"), "rep", "left"
    )
    # copies of a node are linked with each other
    linked = of_node.select(
        "id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    found_ids = vectors.select("id").join(linked, "id", "left")
    return found_ids.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def op3_nn_descent(spark: SparkSession, vectors: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Links and class of each vector; ``kept`` marks the least vec_id of a class.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, and neither do
    vectors of different lengths. A null vec_id counts as the least id. Rows repeated in full are one vector and each
    give a row; different vectors that share a vec_id, or have none, are compared each on its own, and a row
    is kept if its class bears its vec_id. An empty table gives no rows; other columns are not looked at.
    """
    single = vectors.groupBy(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("text")).agg(F.count("*").alias("times"))
    rows, names = row_keyed(spark, written(spark, single, "vectors"), "times")
    found = near_copies(spark, rows.select("id", F.col("text").alias("embedding")), settings)
    found = found.join(rows.select("id", F.sequence(F.lit(1), "times").alias("each")), "id").withColumn("each", F.explode("each"))
    named = with_doc_id(with_doc_id(found, names, "id", "vec_id"), names, "component", "component_id")
    return named.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS seen FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON vec_id = id LEFT JOIN n ON vec_id = a
"""
