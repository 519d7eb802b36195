"""Nearest neighbours by inner product through learned partitions.

A bounded sample of vectors gives a graph of nearest neighbours; the graph is cut into parts of equal size (recursive
spectral bisection, then moves along the edges within the size limit), and a small two-layer network learns to tell a
vector's parts from the vector. Every vector of the table is indexed in its most probable part. Parts that are still large
are cut in the same way, each from a sample of its own, so the parts form a tree of routers. A query goes down the tree to its
most probable leaves and is compared with every vector there, in double precision.

How many leaves a query needs is measured, not guessed: for ``ASKED`` queries the true neighbours in the whole table are
found by brute force, and the least number of leaves that holds ``RECALL`` of them is used for all. The same measure says
whether another level of the tree pays: it stays if queries then meet at most ``PAYS`` of the entries they met before. Vectors
without any structure need most leaves however fine they are, and more leaves would only multiply the rows that are sent.

Equal vectors are one entry of the index and share one score; of their ids only the smallest matter to a query, one
more than it wants (the one to spare is its own). So a vector that a third of all rows hold costs no more than another,
as an entry or as a query. Entries and queries of a leaf are dealt into blocks, and every pair of blocks is a group.

Bounds: a router is fitted on about ``SAMPLE`` vectors in one task; all routers together, which are broadcast, take at most
``ROUTER_BYTES``. Where a table needs more, leaves grow beyond ``LEAF``; the work grows, no neighbour is lost by it.

Defined cases: a vector that is null, zero, or holds a null or non-finite component takes no part; a shorter vector counts as
padded with zeros. Rows of one id are one row if they hold one vector; a query's own rows are all rows of its id. A row
without an id can be found, behind all ids of its score, but does not ask. No vectors or no queries: no rows.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Shipped, cut

TOP = 20                    # neighbours of a query
EVERY = 20                  # ids divisible by this ask
PARTS = 32                  # parts a router tells apart at most
LEAF = 256                  # entries of a leaf aimed at
SAMPLE = 4_096              # vectors a router is fitted on, about
NEAR = 10                   # neighbours of a vector in the graph
HIDDEN = 32
ROUTER_BYTES = 32 << 20
ASKED = 256                 # queries for which recall is measured
RECALL = 0.95
PAYS = 0.8
BLOCK = 4_096               # entries, or queries, of a block, about
ROOT = 1


# ------------------------------------------------------------------ one router, from a sample
def graph(x: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Edges, in both directions, from every vector to those with the largest inner product."""
    near = min(near, len(x) - 1)
    found = np.empty((len(x), near), np.int64)
    for first in range(0, len(x), 1_024):
        score = x[first:first + 1_024] @ x.T
        score[np.arange(len(score)), np.arange(first, first + len(score))] = -np.inf
        found[first:first + 1_024] = np.argpartition(-score, near - 1, axis=1)[:, :near]
    a, b = np.repeat(np.arange(len(x)), near), found.ravel()
    return np.r_[a, b], np.r_[b, a]


def balanced(n: int, a: np.ndarray, b: np.ndarray, parts: int, slack: float = 1.05, rounds: int = 5) -> np.ndarray:
    """A part for each of ``n`` nodes, few edges (a, b) between the parts and none much larger than another; ``parts`` a power of 2."""
    label = np.zeros(n, np.int64)
    rng = np.random.default_rng(7)
    for _ in range(parts.bit_length() - 1):
        inside = label[a] == label[b]
        u, v = a[inside], b[inside]
        degree = np.maximum(np.bincount(u, minlength=n), 1)
        side, weight = rng.standard_normal(n), np.bincount(label, degree)
        for _ in range(40):                       # the slowest wave on each part's edges splits it where few edges are cut
            side = side / 2 + np.bincount(u, side[v], n) / degree / 2
            side -= (np.bincount(label, side * degree) / weight)[label]
        order = np.lexsort((side, label))
        count = np.bincount(label)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
        label = 2 * label + (place >= count[label] // 2)
    size, limit = np.bincount(label, minlength=parts), slack * n / parts + 1
    for _ in range(rounds):
        seen = neighbours_in(n, a, b, label, parts)
        best = seen.argmax(axis=1)
        gain = seen[np.arange(n), best] - seen[np.arange(n), label]
        for i in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())]:
            if size[best[i]] + 1 <= limit:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
    return label


def neighbours_in(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray, parts: int) -> np.ndarray:
    return np.bincount(a * parts + label[b], minlength=n * parts).reshape(n, parts)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


#: a router: scale of the input, weights and offsets of the two layers
Router = list[np.ndarray]


def train(x: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, epochs: int = 40) -> Router:
    """A two-layer network from vectors to the shares ``target`` of their parts, by minibatches with adaptive steps."""
    rng, dims, parts = np.random.default_rng(11), x.shape[1], target.shape[1]
    scale = np.float32(1 / max(np.sqrt((x.astype(np.float64) ** 2).mean()), 1e-30))
    w = [rng.standard_normal((dims, hidden)) / np.sqrt(dims), np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden), np.zeros(parts)]
    x = x.astype(np.float64) * float(scale)
    mean, square, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for first in range(0, len(x), 256):
            rows, step = order[first:first + 256], step + 1
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            off = (np.exp(log_softmax(h @ w[2] + w[3])) - target[rows]) / len(rows)
            back = (off @ w[2].T) * (h > 0)
            for k, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ off, off.sum(0))):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] = w[k] - 0.01 * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return [scale, *[v.astype(np.float32) for v in w]]


def chances(router: Router, x: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of the parts."""
    scale, w0, b0, w1, b1 = router
    return log_softmax(np.maximum(x.astype(np.float32) * scale @ w0 + b0, 0) @ w1 + b1)


def fit(x: np.ndarray, parts: int) -> Router:
    a, b = graph(x.astype(np.float32))
    label = balanced(len(x), a, b, parts)
    seen = neighbours_in(len(x), a, b, label, parts) + np.eye(parts)[label]
    return train(x, seen / seen.sum(axis=1, keepdims=True))


# ------------------------------------------------------------------ the tree of routers
def child(node: np.ndarray, part: np.ndarray) -> np.ndarray:
    return node * (2 * PARTS) + part


def place(x: np.ndarray, tree: dict[int, Router]) -> np.ndarray:
    """The leaf in which each vector is indexed: the most probable part at every router."""
    node = np.full(len(x), ROOT, np.int64)
    rows = np.arange(len(x)) if ROOT in tree else np.empty(0, np.int64)
    while len(rows):
        order = rows[np.argsort(node[rows], kind="stable")]
        names, first = np.unique(node[order], return_index=True)
        for name, group in zip(names.tolist(), np.split(order, first[1:])):
            node[group] = child(node[group], chances(tree[name], x[group]).argmax(axis=1))
        rows = rows[[n in tree for n in node[rows].tolist()]]
    return node


def probable(x: np.ndarray, tree: dict[int, Router], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` most probable leaves of each query and the one it is indexed in: numbers of queries, leaves."""
    query, node, weight = np.arange(len(x)), np.full(len(x), ROOT, np.int64), np.zeros(len(x), np.float32)
    while True:
        inner = np.array([n in tree for n in node.tolist()], bool)
        if not inner.any():
            break
        queries, nodes, weights = [query[~inner]], [node[~inner]], [weight[~inner]]
        order = np.flatnonzero(inner)[np.argsort(node[inner], kind="stable")]
        names, first = np.unique(node[order], return_index=True)
        for name, group in zip(names.tolist(), np.split(order, first[1:])):
            chance = chances(tree[name], x[query[group]])
            n = chance.shape[1]
            queries.append(np.repeat(query[group], n))
            nodes.append(child(np.repeat(node[group], n), np.tile(np.arange(n), len(group))))
            weights.append((weight[group, None] + chance).ravel())
        query, node, weight = np.concatenate(queries), np.concatenate(nodes), np.concatenate(weights)
        order = np.lexsort((node, -weight, query))
        count = np.bincount(query, minlength=len(x))
        rank = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
        best = order[rank < width]
        query, node, weight = query[best], node[best], weight[best]
    pairs = np.unique(np.c_[np.r_[query, np.arange(len(x))], np.r_[node, place(x, tree)]], axis=0)
    return pairs[:, 0], pairs[:, 1]


def matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """The vectors of an Arrow column of their bytes."""
    n = len(column)
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(n, -1)


class Index:
    """Routers, and the vectors of a table as entries: ``key`` (128 bits of the vector), ``x`` (its bytes), ``low`` (smallest id)."""

    def __init__(self, df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, top: int = TOP,
                 recall: float = RECALL, asked: int = ASKED, leaf: int = LEAF, sample: int = SAMPLE, router_bytes: int = ROUTER_BYTES, block: int = BLOCK):
        self.spark, self.top, self.recall = df.sparkSession, top, recall
        self.leaf, self.sample, self.router_bytes, self.block = leaf, sample, router_bytes, block
        self.kind = np.dtype(np.float32 if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else np.float64)
        self.rows = self._rows(df, vec_id, vector)
        self.entries = cut(self.rows.groupBy("key").agg(F.first("x").alias("x"), F.min("id").alias("low")))
        self.ask = cut(self.rows.where(F.col("id") % every == 0).select("id", "key").distinct())
        self.per_key = self.ask.groupBy("key").agg(F.count("*").alias("n"))
        self.asking = self.entries.join(self.per_key, "key").select("key", "x")
        self.tree: dict[int, Router] = {}
        self._grow(*self._truth(asked))

    def _rows(self, df: DataFrame, vec_id: str, vector: str) -> DataFrame:
        """Id, key and bytes of the vectors that take part."""
        slim = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("v"))
        # NaN stands above infinity in Spark's order
        finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
        usable = slim.where(finite & F.exists("v", lambda x: x != 0))
        dims, kind = usable.agg(F.max(F.size("v"))).first()[0] or 1, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists, n = batch.column(1), batch.num_rows
                long = np.diff(lists.offsets.to_numpy())
                x = np.zeros((n, dims), kind)
                x[np.repeat(np.arange(n), long), np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)] = lists.flatten().to_numpy()
                held = [v.tobytes() for v in x + kind.type(0)]           # minus zero is zero
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(v) for v in held], pa.binary()),
                                                  pa.array(held, pa.binary())], names=["id", "key", "x"])

        return usable.mapInArrow(run, "id bigint, key binary, x binary")

    def _map(self, work, schema: str, df: DataFrame | None = None, **shipped) -> DataFrame:
        """``work(batch, vectors, tree)`` over the entries; it gives the columns of ``schema``."""
        held, kind = Shipped(self.spark, self.tree), self.kind
        names = [f.split()[0] for f in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(work(batch, matrix(batch["x"], kind), held.value), names=names)

        return (self.entries if df is None else df).mapInArrow(run, schema)

    def placed(self) -> DataFrame:
        """The entries with their leaf."""
        return self._map(lambda b, x, tree: [pa.array(place(x, tree)), b["key"], b["x"], b["low"]], "leaf bigint, key binary, x binary, low bigint")

    def sizes(self) -> dict[int, int]:
        """Entries per leaf; the routers bound the number of leaves."""
        leaves = self._map(lambda b, x, tree: [pa.array(place(x, tree))], "leaf bigint")
        return {r["leaf"]: r["n"] for r in leaves.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    def _grow(self, asked: np.ndarray, query: np.ndarray, near: np.ndarray) -> None:
        """Put routers on the leaves that are too large, level by level, while that pays and the routers' bytes last.

        Sets ``counts`` (entries per leaf), ``width`` (leaves to look into) and ``share`` (of the entries a query meets).
        """
        kind, whole, tried, before = self.kind, {ROOT: 0}, set(), None
        while True:
            self.counts = sizes = self.sizes()
            self.width, self.share = self._width(asked, query, near)
            if before is not None and before[0] and self.share > PAYS * before[3]:
                self.tree, self.counts, self.width, self.share = before
                return
            before = dict(self.tree), self.counts, self.width, self.share
            # a part that took almost all of its parent's vectors cannot be cut by a router
            large = sorted((n for n in sizes if sizes[n] > self.leaf and n < 1 << 54 and n not in tried
                            and (n == ROOT or 10 * sizes[n] < 9 * whole[n // (2 * PARTS)])), key=lambda n: (-sizes[n], n))
            each = max((len(pickle.dumps(r)) for r in self.tree.values()), default=0)
            if each:
                large = large[:max(0, self.router_bytes // each - len(self.tree))]
            if not large:
                return
            tried |= set(large)
            whole |= {n: sizes[n] for n in large}
            parts = {n: min(PARTS, 1 << (-(-sizes[n] // self.leaf) - 1).bit_length()) for n in large}
            share = {n: min(1.0, self.sample / sizes[n]) for n in large}

            def pick(batch: pa.RecordBatch, x: np.ndarray, tree: dict[int, Router]) -> list:
                leaf = place(x, tree)
                # the key is a hash: its first bytes are as good as a random number
                chance = np.array([int.from_bytes(k[:6], "big") for k in batch["key"].to_pylist()]) / 2.0 ** 48
                rows = pa.array(chance < np.array([share.get(n, 0.0) for n in leaf.tolist()]))
                return [pa.array(leaf).filter(rows), batch["key"].filter(rows), batch["x"].filter(rows)]

            def learn(rows: pd.DataFrame) -> pd.DataFrame:
                node = int(rows["leaf"].iloc[0])
                x = np.frombuffer(b"".join(rows.sort_values("key")["x"]), kind).reshape(len(rows), -1)
                n = min(parts[node], 1 << (len(x).bit_length() - 1))
                return pd.DataFrame({"node": [node], "router": [pickle.dumps(fit(x, n)) if n > 1 else b""]})

            picked = self._map(pick, "leaf bigint, key binary, x binary")
            learned = picked.groupBy("leaf").applyInPandas(learn, "node bigint, router binary").collect()
            new = {r["node"]: pickle.loads(r["router"]) for r in learned if r["router"]}
            if not new:
                return
            self.tree = self.tree | new

    # -------------------------------------------------------------- queries
    def _truth(self, asked: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``asked`` of the queries, and their true neighbours by brute force: vectors, numbers of the queries, neighbours."""
        some, top, kind = self.asking.orderBy("key").limit(asked).collect(), self.top, self.kind
        x = np.frombuffer(b"".join(r["x"] for r in some), kind).reshape(len(some), -1 if some else 1)
        own = np.array([r["key"] for r in some], object)
        held = Shipped(self.spark, (x.astype(np.float64), own))

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (q, own), best = held.value, None
            for batch in batches:
                if not batch.num_rows or not len(q):
                    continue
                y = matrix(batch["x"], kind)
                score = q @ y.T.astype(np.float64)
                score[own[:, None] == np.array(batch["key"].to_pylist(), object)[None, :]] = -np.inf
                found = np.broadcast_to(y, (len(q), *y.shape))
                if score.shape[1] > top:
                    at = np.argpartition(-score, top - 1, axis=1)[:, :top]
                    score, found = np.take_along_axis(score, at, 1), y[at]
                if best is not None:
                    score, found = np.concatenate([best[0], score], 1), np.concatenate([best[1], found], 1)
                    at = np.argsort(-score, axis=1, kind="stable")[:, :top]
                    score, found = np.take_along_axis(score, at, 1), np.take_along_axis(found, at[:, :, None], 1)
                best = score, found
            if best is not None:
                number = np.repeat(np.arange(len(q)), best[0].shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(best[0].ravel()), pa.array(
                    [v.tobytes() for v in best[1].reshape(-1, best[1].shape[2])], pa.binary())], names=["query", "score", "x"])

        first = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "x"))
        found = (self.entries.mapInArrow(nearest, "query bigint, score double, x binary").where(F.col("score") > float("-inf"))
                 .withColumn("rn", first).where(F.col("rn") <= top).toPandas())      # at most ``asked`` times ``top`` rows
        return x, found["query"].to_numpy(np.int64), np.frombuffer(b"".join(found["x"]), kind).reshape(len(found), -1 if len(found) else 1)

    def _width(self, asked: np.ndarray, query: np.ndarray, near: np.ndarray) -> tuple[int, float]:
        """The fewest leaves that hold ``recall`` of the true neighbours, and the share of the entries in them."""
        width, leaves, total = 1, max(1, len(self.counts)), max(1, sum(self.counts.values()))
        if not len(query):
            return leaves, 1.0
        true = list(zip(query.tolist(), place(near, self.tree).tolist()))
        while True:
            of, leaf = probable(asked, self.tree, width)
            pairs = set(zip(of.tolist(), leaf.tolist()))
            if width >= leaves or np.mean([p in pairs for p in true]) >= self.recall:
                return width, sum(self.counts.get(n, 0) for n in leaf.tolist()) / len(asked) / total
            width = min(leaves, width + max(1, width // 8))

    def search(self) -> DataFrame:
        """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest found for the ids that ask."""
        ask, per_key, top = self.ask, self.per_key, self.top
        best = cut(self._nearest(self.asking, self.width, top + 1))

        # of equal vectors the smallest ids matter, one more than wanted
        place_of = F.row_number().over(Window.partitionBy("key").orderBy(F.col("id").asc_nulls_last()))
        ids = (self.rows.select("key", "id").distinct().withColumn("rn", place_of).where(F.col("rn") <= top + 1)
               .groupBy("key").agg(F.collect_list("id").alias("ids"), F.count_if(F.col("id").isNull()).alias("unnamed")))
        named = best.join(ids, "key").select("query", "score", F.explode(
            F.when(F.col("unnamed") > 0, F.array_append("ids", F.lit(None).cast("bigint"))).otherwise(F.col("ids"))).alias("id"))
        ahead = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
        lists = (named.withColumn("rn", ahead).where(F.col("rn") <= top + 1).groupBy("query")
                 .agg(F.array_sort(F.collect_list(F.struct("rn", "id", "score"))).alias("near")))

        # a vector that many ids ask for is dealt over tasks; at most 1,000 such keys by construction
        hot = per_key.where(F.col("n") > F.lit(max(10_000, ask.count() // 1_000))).select("key", F.lit(64).alias("salts"))
        salted = ask.join(F.broadcast(hot), "key", "left").select(
            "id", "key", F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).alias("salt"))
        dealt = lists.join(F.broadcast(hot), F.col("query") == F.col("key"), "left").select(
            "query", "near", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)).cast("bigint") - 1)).alias("salt"))
        other = lambda x: ~x["id"].eqNullSafe(F.col("query_id"))
        return (salted.select("key", "salt", F.col("id").alias("query_id"))
                .join(dealt.withColumnRenamed("query", "key"), ["key", "salt"])
                .select("query_id", F.posexplode(F.slice(F.filter("near", other), 1, top)).alias("at", "hit"))
                .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score")))

    def _nearest(self, asking: DataFrame, width: int, top: int) -> DataFrame:
        """The ``top`` entries of the largest inner product in the leaves of every query: (query, key, score)."""
        kind, block = self.kind, self.block

        def route(batch: pa.RecordBatch, x: np.ndarray, tree: dict[int, Router]) -> list:
            query, leaf = probable(x, tree, width)
            at = pa.array(query)
            return [pa.array(leaf), batch["key"].take(at), batch["x"].take(at)]

        routed = self._map(route, "leaf bigint, query binary, q binary", asking)
        queries = {r["leaf"]: r["n"] for r in routed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        grid = self.spark.createDataFrame([(n, -(-self.counts[n] // block), -(-m // block)) for n, m in queries.items() if n in self.counts],
                                          "leaf bigint, row_blocks int, query_blocks int")        # a row per leaf
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = (self.placed().join(F.broadcast(grid), "leaf").withColumn("i", F.pmod(F.xxhash64("key"), F.col("row_blocks")).cast("int"))
                .withColumn("j", spread("query_blocks")).select("leaf", "i", "j", "key", "x", "low"))
        right = (routed.join(F.broadcast(grid), "leaf").withColumn("j", F.pmod(F.xxhash64("query"), F.col("query_blocks")).cast("int"))
                 .withColumn("i", spread("row_blocks")).select("leaf", "i", "j", "query", "q"))

        def compare(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            outs = []
            if len(entries) and len(asked):
                # in order of the smallest id, rows without one last: of equal scores the first is the right one
                entries = entries.sort_values(["low", "key"])
                x = np.frombuffer(b"".join(entries["x"]), kind).reshape(len(entries), -1).astype(np.float64)
                q = np.frombuffer(b"".join(asked["q"]), kind).reshape(len(asked), -1).astype(np.float64)
                for first in range(0, len(q), 256):
                    i, j, score = best_of(q[first:first + 256], x, top)
                    outs.append(pd.DataFrame({"query": asked["query"].to_numpy()[first + i], "key": entries["key"].to_numpy()[j],
                                              "low": entries["low"].astype("Int64").to_numpy()[j], "score": score}))
            return pd.concat(outs) if outs else pd.DataFrame({"query": [], "key": [], "low": [], "score": []})

        found = left.groupBy("leaf", "i", "j").cogroup(right.groupBy("leaf", "i", "j")).applyInPandas(
            compare, "query binary, key binary, low bigint, score double")
        ahead = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("low").asc_nulls_last(), "key"))
        return found.withColumn("rn", ahead).where(F.col("rn") <= top).select("query", "key", "score")


def best_of(q: np.ndarray, x: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the queries and of their ``top`` rows of ``x`` with the largest product, ties to the earlier row, and the products.

    Products of the whole block choose; those reported are summed apart, the same way for every pair.
    """
    rough = q @ x.T
    if x.shape[0] > top:
        least = np.partition(rough, -top, axis=1)[:, -top]
        near = rough >= (least - 1e-9 * (np.abs(q).max(axis=1) * np.abs(x).max() * x.shape[1] + 1e-300))[:, None]
    else:
        near = np.ones(rough.shape, bool)
    i, j = np.nonzero(near)
    score = np.einsum("nd,nd->n", q[i], x[j])
    order = np.lexsort((j, -score, i))
    i, j, score = i[order], j[order], score[order]
    count = np.bincount(i, minlength=len(q))
    first = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) < top
    return i[first], j[first], score[first]


def search(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, top: int = TOP, recall: float = RECALL) -> DataFrame:
    """The nearest rows found for every row whose id is divisible by ``every``; see ``Index.search``."""
    return Index(df, vec_id, vector, every, top, recall).search()
