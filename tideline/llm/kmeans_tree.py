"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and travels to the tasks with their code. Every vector goes to the leaf it
falls into. A query walks the tree with a priority queue: of all branches seen so far the one with the nearest
centre is opened next, and leaves come out in the order in which they are worth a visit. How many leaves a query
visits is calibrated: for a sample of the queries the true neighbours are found in blocks over all vectors, and
visits widen until those queries would have met enough of them. Queries then meet the vectors of their leaves in
blocks of bounded size, where distances are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import bitmaps
from tideline.session import written

#: Vectors that the tree is fitted on, at most; fewer if they would take more than SAMPLE_BYTES.
SAMPLE, SAMPLE_BYTES = 16_384, 1 << 26
#: Queries that visits are calibrated on, at most, and the share of their true neighbours to be met.
CALIBRATION, RECALL = 256, 0.95
#: Children of a node; sample vectors of a leaf, at most; rounds of k-means.
BRANCH, LEAF, ROUNDS = 12, 24, 8
#: Vectors and queries of a block, on average.
BLOCK_VECTORS, BLOCK_QUERIES = 2048, 512
#: Queries that one task walks the tree for, on average; rows are small, so their bytes would put too many in one.
WALKS = 64


class Tree:
    """Centres of all nodes, row by row; children of a node are successive rows, leaves are numbered."""

    def __init__(self, sample: np.ndarray):
        self.centres, self.children, self.leaf = [sample.mean(axis=0) if len(sample) else np.zeros(0)], [None], [None]
        self.leaves = 0
        waiting = [(0, sample)]
        while waiting:
            node, rows = waiting.pop()
            parts = _kmeans(rows, BRANCH) if len(rows) > LEAF else []
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            first = len(self.centres)
            self.children[node] = (first, first + len(parts))
            for i, part in enumerate(parts):
                self.centres.append(part.mean(axis=0))
                self.children.append(None)
                self.leaf.append(None)
                waiting.append((first + i, part))
        self.centres = np.array(self.centres)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Leaf that each row falls into, always going to the nearest centre."""
        out = np.zeros(len(rows), np.int32)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, of = waiting.pop()
            if self.children[node] is None:
                out[of] = self.leaf[node]
                continue
            first, end = self.children[node]
            nearest = _squares(rows[of], self.centres[first:end]).argmin(axis=1)
            waiting += [(first + i, of[nearest == i]) for i in np.unique(nearest)]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                out.append(self.leaf[node])
                continue
            first, end = self.children[node]
            away = self.centres[first:end] - query
            for i, d in enumerate(np.einsum("ij,ij->i", away, away).tolist()):
                heapq.heappush(queue, (d, first + i))
        return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances but for a constant of each row of ``a``; good for comparing, not for reporting."""
    return np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)


def _kmeans(rows: np.ndarray, k: int) -> list[np.ndarray]:
    """Non-empty clusters of the rows; the starting centres are spread over the rows' order."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        of = _squares(rows, centres).argmin(axis=1)
        centres = np.array([rows[of == i].mean(axis=0) for i in np.unique(of)])
    of = _squares(rows, centres).argmin(axis=1)
    return [rows[of == i] for i in np.unique(of)]


def _matrix(column: pa.Array, dtype: str = "<f8") -> np.ndarray:
    """Packed vectors of equal size as the rows of a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = b"".join(v.as_py() for v in column)
    return np.frombuffer(data, dtype).reshape(len(column), -1).astype(np.float64)


def _nearest(distance: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` smallest distances, the smaller least id first where they tie."""
    if len(distance) > 4 * k:
        bound = np.partition(distance, k - 1)[k - 1]
        of = np.flatnonzero(distance <= bound)
    else:
        of = np.arange(len(distance))
    return of[np.lexsort((least[of], distance[of]))[:k]]


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of rows that take part: an id, a vector not zero, its components neither null nor non-finite."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"))
    return rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~odd & some)


def _key(vector: str) -> Column:
    """128 bits that stand for a vector."""
    return F.struct(F.xxhash64(vector).alias("a"), F.xxhash64(F.lit(1), vector).alias("b"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of doubles as bytes, which cost no object per component later on."""
    for batch in batches:
        vectors = batch.column(batch.schema.get_field_index("vector"))
        data = np.asarray(vectors.values.slice(vectors.offsets[0].as_py() if len(vectors) else 0), "<f8")
        ends = np.asarray(vectors.offsets) - (vectors.offsets[0].as_py() if len(vectors) else 0)
        packed = [data[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        columns = [pa.array(packed, pa.binary()) if n == "vector" else c for n, c in zip(batch.schema.names, batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``key, vector, least, ids``: each different vector once, with the ``k + 1`` smallest of its ids.

    No more of them can be among anyone's ``k`` nearest, whatever the number of copies. Each task keeps ``k + 1`` rows
    a vector before copies meet.
    """
    rows = rows.withColumn("key", _key("vector"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    few = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1).drop("rank")
    grouped = few.groupBy("key").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.select("key", "vector", F.element_at("ids", 1).alias("least"), "ids")


def _brute(queries: np.ndarray, k: int):
    """The ``k`` nearest to every query within each task, as ``query, distance, least, vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in queries]
        for batch in batches:
            if not len(batch):
                continue
            packed, least = batch.column(0), np.asarray(batch.column(1))
            rows = _matrix(packed)
            away = np.maximum(_squares(queries, rows) + np.einsum("ij,ij->i", queries, queries)[:, None], 0)
            for held_by, distance in zip(held, away):
                held_by += [(float(distance[i]), int(least[i]), packed[int(i)].as_py()) for i in _nearest(distance, least, k)]
                held_by.sort(key=lambda r: r[:2])
                del held_by[k:]
        flat = [(i, *r) for i, of in enumerate(held) for r in of]
        columns = [list(c) for c in zip(*flat)] if flat else [[], [], [], []]
        types = (pa.int32(), pa.float64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query", "distance", "least", "vector"])

    return run


def calibrated(distinct: DataFrame, tree: Tree, queries: np.ndarray, k: int, recall: float) -> int:
    """Leaves to visit so that the given queries meet ``recall`` of their true ``k`` nearest vectors.

    A query's own vector, which it always meets, does not count.
    """
    if tree.leaves == 1 or not len(queries):
        return tree.leaves
    found = distinct.select("vector", "least").mapInArrow(_brute(queries, k + 1), "query int, distance double, least bigint, vector binary")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "least"))
    true = found.withColumn("rank", rank).filter(F.col("rank") <= k + 1).select("query", "vector").toArrow()
    leaf = tree.leaf_of(_matrix(true.column("vector")))
    place = np.zeros((len(queries), tree.leaves), np.int64)
    for i, query in enumerate(queries):
        place[i, tree.visits(query, tree.leaves)] = np.arange(tree.leaves)
    of = np.asarray(true.column("query"))
    other = (_matrix(true.column("vector")) != queries[of]).any(axis=1)
    needed = np.sort(place[of, leaf][other]) + 1
    visits = 1
    while np.searchsorted(needed, visits, "right") < recall * len(needed):
        visits += 1
    return visits


def _to_leaves(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vector")
            leaf = tree.leaf_of(_matrix(batch.column(at))) if len(batch) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return run


def _to_visits(tree: Tree, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(batch.schema.get_field_index("vector"))) if len(batch) else []
            leaves = [tree.visits(row, most) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=[*batch.schema.names, "leaves"])

    return run


def _search(k: int):
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        """The ``k + 1`` nearest of a block of vectors (``right``) to each query of a block (``left``)."""
        out: dict[str, list] = {"key": [], "distance": [], "ids": []}
        if len(left) and len(right):
            rows, least, ids = _matrix(right.column("vector")), np.asarray(right.column("least")), right.column("ids")
            for key, query in zip(left.column("key").to_pylist(), _matrix(left.column("vector"))):
                away = rows - query
                distance = np.sqrt(np.einsum("ij,ij->i", away, away))
                for i in _nearest(distance, least, k + 1).tolist():
                    out["key"].append(key)
                    out["distance"].append(float(distance[i]))
                    out["ids"].append(ids[i].as_py())
        key = pa.struct([("a", pa.int64()), ("b", pa.int64())])
        types = {"key": key, "distance": pa.float64(), "ids": pa.list_(pa.int64())}
        return pa.table({n: pa.array(v, types[n]) for n, v in out.items()})

    return run


def neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors found for each query, nearest first.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id. Rows under the query's own
    id are no candidates for it. Null ids, and vectors that are null, zero or hold null or non-finite
    components take no part, nor do vectors of another size than most have (the smaller of equally frequent
    sizes). Of several rows under one id the one with the least vector counts. Ids are long integers. Other columns are ignored. Without vectors or queries there are no rows.

    All vectors are indexed. The driver sees the sample for the tree, the calibration queries with their
    neighbours and the number of vectors and queries of each leaf, all bounded by the parameters of this module.
    """
    spark = vectors.sparkSession
    rows, asked = valid(vectors, id_col, vector_col), valid(queries, id_col, vector_col)
    rows, asked = (d.withColumn("id", F.col("id").cast("long")) for d in (rows, asked))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if sizes is None:
        return empty
    size = sizes["size"]
    rows, asked = (d.filter(F.size("vector") == size).groupBy("id").agg(F.min("vector").alias("vector")) for d in (rows, asked))
    distinct = _distinct(rows, k)
    kind = "key struct<a: bigint, b: bigint>, vector binary, least bigint, ids array<bigint>"
    distinct = written(distinct.mapInArrow(_packed, kind), "vectors")
    asked = asked.withColumn("key", _key("vector"))
    asked = written(asked.mapInArrow(_packed, "id bigint, vector binary, key struct<a: bigint, b: bigint>"), "queries")
    queries_once = asked.dropDuplicates(["key"]).select("key", "vector").repartition(asked.count() // WALKS + 1, "key")
    spread = F.xxhash64("key")
    most = max(1, min(sample, SAMPLE_BYTES // (8 * size)))
    fitted = distinct.orderBy(spread, "key").limit(most).select("vector").toArrow()
    tree = Tree(_matrix(fitted.column("vector")))
    trial = queries_once.orderBy(spread, "key").limit(min(CALIBRATION, most)).select("vector").toArrow()
    if not len(trial):
        return empty
    visits = calibrated(distinct, tree, _matrix(trial.column("vector")), k, recall)

    indexed = distinct.mapInArrow(_to_leaves(tree), f"{kind}, leaf int")
    indexed = written(indexed, "indexed")
    visited = queries_once.mapInArrow(_to_visits(tree, visits), "key struct<a: bigint, b: bigint>, vector binary, leaves array<int>")
    visited = written(visited.select("key", "vector", F.explode("leaves").alias("leaf")), "visits")

    # Blocks of a leaf: at most as many rows here as there are leaves.
    blocks = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    groups = visited.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("groups"))
    counts = F.broadcast(written(blocks.join(groups, "leaf"), "leaves"))

    def dealt(n: str) -> Column:
        return F.pmod(spread, F.col(n)).cast("int")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    right = indexed.join(counts, "leaf").select("leaf", dealt("blocks").alias("block"), each("groups").alias("group"), "vector", "least", "ids")
    left = visited.join(counts, "leaf").select("leaf", each("blocks").alias("block"), dealt("groups").alias("group"), "key", "vector")
    by = ["leaf", "block", "group"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_search(k), "key struct<a: bigint, b: bigint>, distance double, ids array<bigint>")

    # The k + 1 nearest ids of each different query, then those of each query's id without its own.
    order = Window.partitionBy("key").orderBy("distance", "id")
    nearest = found.select("key", "distance", F.explode("ids").alias("id")).withColumn("rank", F.row_number().over(order))
    nearest = nearest.filter(F.col("rank") <= k + 1).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("nearest"))
    sharing = asked.groupBy("key").agg(F.count("*").alias("sharing"))
    nearest = written(nearest.join(sharing, "key"), "nearest")
    answered = bitmaps.join_groups(asked.select("id", "key"), nearest, ["key"], "sharing", F.col("id")).filter("nearest is not null")
    others = F.slice(F.filter("nearest", lambda n: n["id"] != F.col("id")), 1, k)
    return answered.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "found")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("vec_id"), F.col("found.distance").alias("score")
    )
