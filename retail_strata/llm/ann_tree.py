"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

Largest inner product becomes least distance by one more component per vector, the root of what
its squared length lacks to the longest's. A tree of k-means centres is fitted on at most
``SAMPLE`` rows (those with the least hash of their vector); every row is then put in the leaf that
the tree leads it to. A query walks the tree best bin first: the nearest centre not yet opened is
taken from a priority queue, which yields the leaves in the order they should be visited. How many
to visit is calibrated: for ``CALIBRATION`` queries the true neighbours are found by comparing them
with every row, and visits are widened until ``RECALL`` of these lie in visited leaves.

Equal vectors are one point of the index, with the ``k + 1`` least ids that they carry, and equal
queries are searched once, so copies of a vector add nothing to the work. Leaves make up groups
of bounded size, and a large leaf is dealt to several. Queries are dealt to blocks of bounded size by
hash. Each group meets each block with a query that visits some of its leaves in a task of their
own and answers with the ``k + 1`` best points there; a query's answers are merged by key. Scores
are double-precision inner products of the original vectors; ties go to the smaller id.

Vectors that are null, of another length than most, zero, or with null or non-finite components
take no part, nor do rows without an id. Rows repeated with their id count once. Fewer candidates
than ``k`` are all returned. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import stage

#: Rows the tree is fitted on, children of a node, points of a leaf at most leaves, leaves at most.
SAMPLE, BRANCHES, LEAF_POINTS, MAX_LEAVES = 32_768, 16, 256, 4_096
#: Queries for which all neighbours are looked up, and the share of these that visits must reach.
CALIBRATION, RECALL = 256, 0.97
#: Points of a group, which one task compares with the queries that visit its leaves.
GROUP = 16_384
#: Queries of a block, on average, that meet a group in one task.
QUERY_BLOCK = 8_192


class Tree:
    """Centres by level; node ``i`` has the children ``children[i]``, a leaf none."""

    def __init__(self, centres: np.ndarray, children: list[list[int]]) -> None:
        self.centres, self.children = centres, children
        leaves = [i for i, c in enumerate(children) if not c]
        self.leaf_of = {node: k for k, node in enumerate(leaves)}
        self.leaves = len(leaves)

    @classmethod
    def fit(cls, points: np.ndarray, leaves: int, seed: int = 7) -> Tree:
        """Split the largest node into ``BRANCHES`` until there are as many leaves as wanted."""
        rng = np.random.default_rng(seed)
        centres, children = [points.mean(axis=0)], [[]]
        queue = [(-len(points), 0, np.arange(len(points)))]
        count = 1
        while queue and count < leaves:
            size, node, rows = heapq.heappop(queue)
            if -size < 2 * BRANCHES:
                break
            means, owner = kmeans(points[rows], BRANCHES, rng)
            if len(means) < 2:
                continue
            for k, mean in enumerate(means):
                children[node].append(len(centres))
                heapq.heappush(queue, (-int((owner == k).sum()), len(centres), rows[owner == k]))
                centres.append(mean)
                children.append([])
            count += len(means) - 1
        return cls(np.array(centres), children)

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf to which each point is led."""
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            below = self.children[node]
            if not below:
                out[rows] = self.leaf_of[node]
                continue
            nearest = squared(points[rows], self.centres[below]).argmin(axis=1)
            todo += [(child, rows[nearest == k]) for k, child in enumerate(below)]
        return out

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """Leaves in best-bin-first order: the nearest centre in the queue is opened next."""
        far = squared(query[None, :], self.centres)[0]
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf_of[node])
            for child in self.children[node]:
                heapq.heappush(queue, (float(far[child]), child))
        return found


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]


def kmeans(points: np.ndarray, k: int, rng, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), size=min(k, len(points)), replace=False)]
    for _ in range(rounds):
        owner = squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        sizes = np.bincount(owner, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    owner = squared(points, centres).argmin(axis=1)
    used = np.unique(owner)
    return centres[used], np.searchsorted(used, owner)


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes all of them as long as the longest."""
    rest = np.maximum(0.0, longest * longest - (vectors * vectors).sum(axis=1))
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)


def lift_queries(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Queries as long as the longest vector, which does not change the order of their neighbours."""
    length = np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    return np.concatenate([vectors * (longest / length), np.zeros((len(vectors), 1))], axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores of one query, ties to the smaller id."""
    if len(scores) > k:
        edge = -np.partition(-scores, k - 1)[k - 1]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(id, vector, key)`` of the rows that take part, the vector in double precision."""
    rows = df.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where("id is not null and vector is not null and size(vector) > 0")
    rows = rows.where(
        F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
        )
        & F.exists("vector", lambda x: x != 0)
    )
    # 0.0 and -0.0 are the same number: adding 0.0 makes them the same key.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("key", F.sha2(F.to_binary(F.concat_ws(",", F.col("vector").cast("array<string>")), F.lit("utf-8")), 256))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0))


def distinct_points(rows: DataFrame, k: int) -> DataFrame:
    """``(key, vector, ids)``: each vector once, with its ``k + 1`` least ids."""
    ranked = (
        rows.select("key", "id")
        .distinct()
        .withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("id")))
        .where(F.col("at") <= k + 1)
    )
    ids = ranked.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return rows.groupBy("key").agg(F.first("vector").alias("vector")).join(ids, "key")


def lay_out(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of every leaf.

    Neighbouring leaves share a group of ``GROUP`` points; a larger leaf is dealt to several.
    """
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    group, held = 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        parts[leaf] = max(1, -(-size // GROUP))
        if held and held + size > GROUP:
            group, held = group + 1, 0
        first[leaf] = group
        held += size
        if parts[leaf] > 1:
            group, held = group + int(parts[leaf]), 0
    return first, parts


def search_points(
    points: DataFrame, queries: DataFrame, k: int, longest: float, tree: Tree, visits: int
) -> DataFrame:
    """``(query, id, score)``: the best of the visited leaves of every group, for every query."""
    spark = points.sparkSession
    sizes = np.zeros(tree.leaves, dtype=np.int64)
    for row in points.groupBy("leaf").count().collect():  # a row for each leaf
        sizes[row["leaf"]] = row["count"]
    shared = spark.sparkContext.broadcast((tree, *lay_out(sizes)))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def visit(batches):
        bins, first, parts = shared.value
        for batch in batches:
            vectors = matrix(batch["vector"])
            lifted = lift_queries(vectors, longest) if len(vectors) else vectors
            for row in range(len(vectors)):
                groups: dict[int, list[int]] = {}
                for leaf in bins.best_bins(lifted[row], visits):
                    for group in range(first[leaf], first[leaf] + parts[leaf]):
                        groups.setdefault(int(group), []).append(leaf)
                at = pa.array([row] * len(groups), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(groups), pa.int64()),
                        batch["key"].take(at),
                        batch["vector"].take(at),
                        pa.array(list(groups.values()), pa.list_(pa.int64())),
                    ],
                    ["group", "query", "vector", "leaves"],
                )

    def deal(batches):
        _, first, parts = shared.value
        for batch in batches:
            leaf = batch["leaf"].to_numpy()
            group = first[leaf] + batch["hash"].to_numpy() % parts[leaf]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), batch["leaf"], batch["vector"], batch["ids"]],
                ["group", "leaf", "vector", "ids"],
            )

    asked = queries.select("key", "vector").mapInArrow(
        visit, "group bigint, query string, vector array<double>, leaves array<bigint>"
    )
    block = F.pmod(F.xxhash64("query", F.lit(2)), F.lit(query_blocks))
    asked = stage(asked.withColumn("block", block), "asked")
    dealt = points.select("leaf", "vector", "ids", F.xxhash64("key").alias("hash")).mapInArrow(
        deal, "group bigint, leaf bigint, vector array<double>, ids array<bigint>"
    )

    # A group's points go to each block of queries that visits it.
    visited = asked.select(F.col("group").alias("at"), F.col("block").alias("by")).distinct()
    dealt = dealt.join(visited, F.col("group") == F.col("at"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        query, found, scores = [], [], []
        if left.num_rows and right.num_rows:
            vectors = matrix(left["vector"])
            leaf = left["leaf"].to_numpy()
            ids = left["ids"].to_pylist()
            owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            every = np.array([i for x in ids for i in x], dtype=np.int64)
            names, asked_vectors = right["query"].to_pylist(), right["vector"].to_pylist()
            visited = right["leaves"].to_pylist()
            for start in range(0, len(names), 128):
                part = np.array(asked_vectors[start : start + 128], dtype=np.float64)
                for q, row in enumerate(part @ vectors.T, start):
                    seen = np.flatnonzero(np.isin(leaf[owner], visited[q]))
                    some = seen[best(row[owner[seen]], every[seen], k + 1)]
                    query += [names[q]] * len(some)
                    found += every[some].tolist()
                    # Added up pair by pair, so that a score does not depend on the block.
                    scores += (vectors[owner[some]] * part[q - start]).sum(axis=1).tolist()
        return pa.table(
            {
                "query": pa.array(query, pa.string()),
                "id": pa.array(found, pa.int64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    return (
        dealt.drop("group").groupBy("at", "by")
        .cogroup(asked.groupBy("group", "block"))
        .applyInArrow(answer, "query string, id bigint, score double")
    )


def calibrate(points: DataFrame, sample: DataFrame, k: int, longest: float, tree: Tree) -> int:
    """The least number of visits that reaches ``RECALL`` of the sample's true neighbours.

    The sample, of ``CALIBRATION`` queries at most, is compared with every point where these lie;
    each task passes on its ``k`` best for each query.
    """
    spark = points.sparkSession
    rows = sample.collect()
    if not rows:
        return tree.leaves
    queries = np.array([r["vector"] for r in rows], dtype=np.float64)
    own = [r["key"] for r in rows]
    shared = spark.sparkContext.broadcast((queries, own))

    def compared(batches):
        asked, names = shared.value
        heaps: list[list[tuple[float, int]]] = [[] for _ in names]
        for batch in batches:
            vectors, keys = matrix(batch["vector"]), batch["key"].to_pylist()
            leaves = batch["leaf"].to_numpy()
            places = {key: i for i, key in enumerate(keys)}
            scores = asked @ vectors.T
            for q, name in enumerate(names):
                row = scores[q]
                if name in places:
                    row[places[name]] = -math.inf
                for i in best(row, np.arange(len(row)), k):
                    if row[i] > -math.inf:
                        heaps[q].append((float(row[i]), int(leaves[i])))
                heaps[q] = sorted(heaps[q], reverse=True)[:k]
        flat = [(q, s, leaf) for q, heap in enumerate(heaps) for s, leaf in heap]
        columns = list(zip(*flat, strict=True)) if flat else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int32()),
                pa.array(columns[1], pa.float64()),
                pa.array(columns[2], pa.int64()),
            ],
            ["q", "score", "leaf"],
        )

    true = (
        points.select("key", "vector", "leaf")
        .mapInArrow(compared, "q int, score double, leaf bigint")
        .withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "leaf")))
        .where(F.col("at") <= k)
        .select("q", "leaf")
        .collect()  # CALIBRATION * k rows at most
    )
    lifted = lift_queries(queries, longest)
    orders = [
        {leaf: n + 1 for n, leaf in enumerate(tree.best_bins(q, tree.leaves))} for q in lifted
    ]
    needed = np.sort([orders[r["q"]][r["leaf"]] for r in true])
    if not len(needed):
        return tree.leaves
    return int(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)) - 1)])


def nearest(
    df: DataFrame, id_column: str, vector: str, is_query, k: int = 20
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest found for the rows where ``is_query``.

    ``is_query`` makes a condition of the id column.
    """
    spark = df.sparkSession
    rows = stage(usable(df, id_column, vector), "vectors")
    points = stage(distinct_points(rows, k), "points")
    count = points.count()
    longest = math.sqrt(
        points.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 1.0
    )
    queries = rows.where(is_query(F.col("id"))).select("id", "key", "vector")
    fitted_on = points.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector").toPandas()
    if not len(fitted_on):
        return spark.createDataFrame(
            [], f"query_id bigint, rank int, {id_column} bigint, score double"
        )
    sample = np.array(fitted_on["vector"].tolist(), dtype=np.float64)
    leaves = min(MAX_LEAVES, max(1, count // LEAF_POINTS))
    tree = Tree.fit(lift(sample, longest), leaves)
    shared = spark.sparkContext.broadcast(tree)

    def led(batches):
        for batch in batches:
            vectors = matrix(batch["vector"])
            leaf = shared.value.assign(lift(vectors, longest)) if len(vectors) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int64())], ["key", "vector", "ids", "leaf"]
            )

    indexed = stage(
        points.select("key", "vector", "ids").mapInArrow(
            led, "key string, vector array<double>, ids array<bigint>, leaf bigint"
        ),
        "indexed",
    )
    distinct = queries.groupBy("key").agg(F.first("vector").alias("vector"))
    some = distinct.orderBy(F.xxhash64("key", F.lit(1)), "key").limit(CALIBRATION)
    visits = calibrate(indexed, some, k, longest, tree)
    found = search_points(indexed, distinct, k, longest, tree, visits)
    nearest_first = [F.desc("score"), F.col("id")]
    by_query = Window.partitionBy("query").orderBy(*nearest_first)
    kept = found.withColumn("at", F.row_number().over(by_query)).where(F.col("at") <= k + 1)
    answers = kept.groupBy("query").agg(
        F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("i"))).alias("all")
    )  # k + 1 at most
    each = (
        queries.select(F.col("id").alias("query_id"), F.col("key").alias("query"))
        .distinct()
        .join(answers, "query")
        .withColumn(
            "all",
            F.slice(
                F.array_sort(F.filter("all", lambda x: x["i"] != F.col("query_id"))), 1, k
            ),
        )
    )
    return each.select("query_id", F.posexplode("all").alias("at", "x")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.i").alias(id_column),
        (-F.col("x.s")).alias("score"),
    )
