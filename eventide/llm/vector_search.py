"""Exact top-k inner products by dual cover trees.

Vectors fall into at most ``CELLS`` cells by their nearest pivot (from a bounded
sample), cells into blocks of about ``BLOCK`` rows by hash, and the queries of a
cell into groups of about ``GROUP``. A first pass holds each group against one block of
its own cell, which gives every query a kth score to beat. The second pass takes
the cells that may still beat the worst kth score of a group: a cell within radius
r of p and a group within s of q have no inner product above qp + s|p| + r|q| + rs.
Of these cells every block is searched, and results are merged by query.

In a task, queries and data are indexed by a cover tree each: a node's children lie within
a covering radius that shrinks by ``SHRINK`` a level, and stand apart by as much;
what is left over in small parts shares a leaf. The trees are descended together, pairs
of greater bound first, and a pair is dropped by the same bound against the worst kth
score of the query node. Leaves are compared by a matrix product.

Vectors are integers (``quantised``), so scores are exact and ties are real: a pair is
dropped only if its bound is below the kth score, and equal scores go to the smaller id.

Defined cases: rows that are null, hold null or non-finite components, are empty or
have no id take no part. Vectors are compared with those of the same dimension only. Rows
equal in id and vector count once, and a row never finds its own id. Fewer than k
candidates give fewer rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import prepare, saved

CELLS = 256
SAMPLE = 2048  # rows the pivots are chosen from
BLOCK = 4096
GROUP = 256
CHUNK = 16  # groups that meet a block in one task
LEAF = 64
SHRINK = 1.5

_VECTORS = "id long, dim int, v binary, cell int, far double"


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, null for vectors that take no part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(fine & (F.size(x) > 0), F.transform(x, lambda c: F.floor(c * scale)))


# --- cover trees --------------------------------------------------------------------


class Node:
    """Rows around a center, at most ``radius`` away; a leaf has no children."""

    __slots__ = ("rows", "center", "radius", "norm", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray, center: np.ndarray):
        self.rows, self.center = rows, center
        self.radius = float(np.sqrt(((x[rows] - center) ** 2).sum(1).max())) if len(rows) else 0.0
        self.norm = float(np.sqrt(center @ center))
        self.children: list[Node] = []


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, center: np.ndarray | None = None) -> Node:
    """Cover tree over the rows of ``x``."""
    rows = np.arange(len(x)) if rows is None else rows
    root = Node(x, rows, x[rows].mean(0) if center is None else center)
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            # Equal vectors cannot be told apart; leaves stay small all the same.
            if len(node.rows) > LEAF:
                parts = np.array_split(node.rows, -(-len(node.rows) // LEAF))
                node.children = [Node(x, part, node.center) for part in parts]
            continue
        reach, left, small = node.radius / SHRINK, node.rows, []
        far = np.sqrt(((x[left] - node.center) ** 2).sum(1))
        center = x[left[int(far.argmin())]]
        for _ in range(LEAF):
            if not len(left):
                break
            away = np.sqrt(((x[left] - center) ** 2).sum(1))
            inside = away <= reach
            mine, left = left[inside], left[~inside]
            if len(mine) > LEAF // 4:
                child = Node(x, mine, center)
                node.children.append(child)
                if len(mine) < len(node.rows):
                    waiting.append(child)
                else:  # the center is another one, but nothing was parted
                    half = mine[np.argsort(away[inside], kind="stable")]
                    node.children = [Node(x, half[: len(half) // 2], center), Node(x, half[len(half) // 2 :], center)]
                    waiting += node.children
            else:
                small.append(mine)
            if len(left):  # the next center stands apart from the last ones: the farthest row left
                center = x[left[int(away[~inside].argmax())]]
        rest = np.concatenate([*small, left])
        if len(rest):
            # Small parts and what no center reached: leaves around the node's own center, near rows together.
            rest = rest[np.argsort(((x[rest] - node.center) ** 2).sum(1), kind="stable")]
            parts = np.array_split(rest, -(-len(rest) // LEAF))
            node.children += [Node(x, part, x[part].mean(0)) for part in parts]
    return root


class Search:
    """Best k of every query so far."""

    def __init__(self, queries, query_ids, data, data_ids, k, floor):
        self.q, self.qid, self.x, self.xid, self.k = queries, query_ids, data, data_ids, k
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.floor = floor  # what a score must reach to matter
        self.products = 0  # inner products taken

    def worst(self, node: Node) -> float:
        rows = node.rows
        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    @staticmethod
    def bound(q: Node, x: Node) -> float:
        top = q.center @ x.center + q.radius * x.norm + x.radius * q.norm + q.radius * x.radius
        return float(top + 1e-9 * abs(top) + 1e-3)

    def compare(self, q: Node, x: Node) -> None:
        self.products += len(q.rows) * len(x.rows)
        score = self.q[q.rows] @ self.x[x.rows].T
        score[self.qid[q.rows][:, None] == self.xid[x.rows]] = -np.inf
        limit = np.maximum(self.scores[q.rows, -1], self.floor[q.rows])
        hit = np.flatnonzero((score.max(1) >= limit) & (score.max(1) > -np.inf))
        if not len(hit):
            return
        rows = q.rows[hit]
        scores = np.concatenate([self.scores[rows], score[hit]], 1)
        ids = np.concatenate([self.ids[rows], np.broadcast_to(self.xid[x.rows], (len(hit), len(x.rows)))], 1)
        order = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)

    def run(self, q: Node, x: Node) -> None:
        waiting = [(self.bound(q, x), q, x)]
        while waiting:
            bound, q, x = waiting.pop()
            if bound < self.worst(q):
                continue
            if not q.children and not x.children:
                self.compare(q, x)
                continue
            # Part the wider of the two.
            if x.children and (not q.children or x.radius >= q.radius):
                pairs = [(self.bound(q, child), q, child) for child in x.children]
            else:
                pairs = [(self.bound(child, x), child, x) for child in q.children]
            waiting += sorted(pairs, key=lambda p: p[0])  # the greatest bound is taken first


def _matrix(column, dim: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.int64).reshape(-1, dim)


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Floats if all sums of products are integers that floats hold, else Python integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    return (q.astype(float), x.astype(float)) if top < 2**52 else (q.astype(object), x.astype(object))


class _Task:
    """Queries (id, v, floor, dim) of one task against a block (id_, v_)."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        dim = left.column("dim")[0].as_py()
        q, x = _exact(_matrix(left.column("v"), dim), _matrix(right.column("v_"), dim))
        qid, xid = left.column("id").to_numpy(), right.column("id_").to_numpy()
        search = Search(q, qid, x, xid, self.k, left.column("floor").to_numpy().astype(float))
        if q.dtype == object:  # no trees: bounds need floats
            whole = Node(np.zeros((len(q), 1)), np.arange(len(q)), np.zeros(1))
            for rows in np.array_split(np.arange(len(x)), -(-len(x) // LEAF)):
                search.compare(whole, Node(np.zeros((len(x), 1)), rows, np.zeros(1)))
        else:
            search.run(cover_tree(q), cover_tree(x))
        found = search.scores > -np.inf
        rows = np.nonzero(found)[0]
        scores = [int(s) for s in search.scores[found]]
        return pa.table([pa.array(qid[rows]), pa.array(search.ids[found]), pa.array(scores, pa.int64())], schema=out)


# --- the operator -------------------------------------------------------------------


def _pivots(sample: list, count: int) -> dict[int, np.ndarray]:
    """Pivots by dimension, each the farthest from those before; a dimension not in the sample has the origin."""
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row.x), []).append(row.x)
    out = {}
    for dim, rows in by_dim.items():
        x = np.array(rows, float)
        n = max(1, min(len(x), round(count * len(x) / len(sample))))
        chosen, away = [0], ((x - x[0]) ** 2).sum(1)
        while len(chosen) < n and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
        out[dim] = x[chosen]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "vector",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best of each query; ``vector`` holds integers.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("x"))
    rows = rows.where("id IS NOT NULL AND x IS NOT NULL").dropDuplicates(["id", "x"])
    rows = saved(rows, "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id", "x"), "id").limit(SAMPLE).collect()
    pivots = _pivots(sample, max(1, min(CELLS, total // BLOCK)))

    def place(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for i, x in zip(batch.column("id").to_pylist(), batch.column("x").to_pylist(), strict=True):
                v = np.array(x, np.int64)
                centers = pivots.get(len(v), np.zeros((1, len(v))))
                away = ((centers - v) ** 2).sum(1)
                cell = int(away.argmin())
                values = (i, len(v), v.tobytes(), cell, float(np.sqrt(away[cell])))
                for kept, value in zip(out, values, strict=True):
                    kept.append(value)
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.float64()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["id", "dim", "v", "cell", "far"]
            )

    placed = saved(rows.mapInArrow(place, _VECTORS).withColumn("query", F.coalesce(is_query, F.lit(False))), "placed")
    # At most one row for each pivot.
    cells = placed.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.max("far").alias("radius"), F.sum(F.col("query").cast("long")).alias("queries")
    )
    cells = {(c.dim, c.cell): c for c in cells.collect()}
    if not any(c.queries for c in cells.values()):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sizes = spark.createDataFrame(
        [(d, c, -(-r.n // BLOCK), max(1, -(-r.queries // GROUP))) for (d, c), r in cells.items()],
        "dim int, cell int, blocks int, groups int",
    )
    named = placed.join(F.broadcast(sizes), ["dim", "cell"])
    blocks = named.select(
        "dim", "cell", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), "id", "v"
    )
    part = F.pmod(F.xxhash64("id", F.lit("group")), F.col("groups")).cast("int")
    queries = named.where("query").select("dim", F.col("cell").alias("home"), part.alias("part"), "blocks", "id", "v")

    def searched(asked: DataFrame) -> DataFrame:
        """``asked`` has a query's row for each block it is held against."""
        key = ["dim", "cell", "block", "chunk"]
        asked = asked.withColumn("chunk", F.expr(f"home * 4294967296 + part div {CHUNK}"))
        data = blocks.join(asked.select(*key).distinct(), key[:-1])
        data = data.select(*[F.col(c).alias(f"{c}_") for c in data.columns])  # both sides have one origin
        task = _Task(k)
        run = lambda left, right: task(left, right)
        left = asked.select(*key, "id", "v", "floor")
        return left.groupBy(*key).cogroup(data.groupBy(*[f"{c}_" for c in key])).applyInArrow(run, "query_id long, vec_id long, score long")

    nothing = float("-inf")
    first_block = F.pmod(F.col("part"), F.col("blocks")).cast("int")
    asked = queries.withColumns({"cell": F.col("home"), "block": first_block, "floor": F.lit(nothing)})
    first = saved(searched(asked), "first")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    floors = floors.select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("low").cast("double")).alias("low"))
    known = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("low", F.lit(nothing))).drop("low")
    known = saved(known, "queries")
    balls = [(d, c, pivots.get(d, np.zeros((1, d)))[c], r.radius) for (d, c), r in cells.items()]

    def reach(table: pa.Table) -> pa.Table:
        """Cells that may beat the worst kth score of a group."""
        dim = table.column("dim")[0].as_py()
        x = _matrix(table.column("v"), dim).astype(float)
        center = x.mean(0)
        radius, norm = float(np.sqrt(((x - center) ** 2).sum(1).max())), float(np.sqrt(center @ center))
        worst = min(table.column("floor").to_pylist())
        found = []
        for d, c, pivot, far in balls:
            if d == dim:
                top = center @ pivot + radius * np.sqrt(pivot @ pivot) + far * norm + radius * far
                if top + 1e-9 * abs(top) + 1e-3 >= worst:
                    found.append(c)
        head = {n: table.column(n)[0].as_py() for n in ("dim", "home", "part")}
        rows = [{**head, "cell": c} for c in found]
        return pa.Table.from_pylist(
            rows, pa.schema([("dim", pa.int32()), ("home", pa.int32()), ("part", pa.int32()), ("cell", pa.int32())])
        )

    groups = known.groupBy("dim", "home", "part").applyInArrow(
        lambda table: reach(table), "dim int, home int, part int, cell int"
    )
    pairs = groups.join(F.broadcast(sizes.select("dim", "cell", F.col("blocks").alias("m"))), ["dim", "cell"])
    pairs = pairs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).drop("m")
    second = known.join(pairs, ["dim", "home", "part"])
    second = second.where(~((F.col("cell") == F.col("home")) & (F.col("block") == first_block)))
    found = first.unionByName(searched(second))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
