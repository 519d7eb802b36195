"""SimHash near-duplicates by a binary trie self-join.

Every text gets a 64-bit fingerprint from its word shingles. The distinct fingerprints form a binary
trie. The join walks pairs of nodes together, adds up the bits in which the two differ, and drops a pair
as soon as they exceed the budget; pairs of single leaves are compared whole. To spread the walk, the
trie is cut below its first bits: every subtrie is joined with itself and with the fingerprints of the
later subtries whose first bits differ by no more than the budget. The bits are taken in the order in
which they split the corpus most evenly, so that even a large group of similar fingerprints, which agree
in many bits, is cut into many subtries. A subtrie sends out a spanning forest of its links only; the
components of all links are then found by alternating star contractions.

Defined cases: a null or empty text has the fingerprint zero, which links like any other; equal
fingerprints are one node, whatever the number of their documents; a component is named by its smallest
id that is not null (null if there is none); repeated rows share their component.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import columns_named, cut, map_rows, row_key, texts_of, whole, without

SHINGLE = 3
BITS = 2                # most differing bits of a link
SUBTRIE = 2_048         # fingerprints aimed at per subtrie
MOST_BITS = 24          # depth at which the trie is cut at most
FRONTIER = 2_000_000    # node pairs walked at once
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: a bit is 1 if it is set in over half of the hashes of the shingles, repeats included."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:].tolist() or [len(joined)])], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """64 bits, each 1 if it is set in over half of the hashes."""
    rows, ones = hashes.astype(">u8").view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for first in range(0, len(rows), 65_536):
        bits = np.unpackbits(rows[first:first + 65_536], axis=1).astype(np.float32)
        ones += (np.ones(len(bits), np.float32) @ bits).astype(np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, keep: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``bits``, the fingerprint as a signed 64-bit integer."""

    def work(column: pa.Array) -> dict[str, np.ndarray]:
        return {"bits": np.array([fingerprint(t, shingle) for t in texts_of(column)], np.uint64).view(np.int64)}

    return map_rows(docs, keep, T.StructType([T.StructField("bits", T.LongType())]), [text], work)


# ------------------------------------------------------------------ the walk
def walk(a: np.ndarray, b: np.ndarray | None, budget: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions of sorted distinct fingerprints within ``budget`` bits; ``b`` None joins ``a`` with itself.

    A node is the range of fingerprints below it. All pairs on the frontier are at the same depth.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    stack = [(63, np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([0]))]
    zeros: dict[tuple[int, int], np.ndarray] = {}

    def middle(side: int, bit: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        found = zeros.get((side, bit))
        if found is None:
            array = a if side == 0 or own else b
            found = zeros[side, bit] = np.r_[0, np.cumsum((array >> np.uint64(bit)) & np.uint64(1) == 0)]
        return low + found[high] - found[low]

    while stack:
        bit, al, ah, bl, bh, used = stack.pop()
        single = ((ah - al) == 1) & ((bh - bl) == 1) if bit >= 0 else np.ones(len(al), bool)
        if single.any():
            i, j = al[single], bl[single]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if own:
                near &= i < j
            if near.any():
                yield i[near], j[near]
        al, ah, bl, bh, used = (x[~single] for x in (al, ah, bl, bh, used))
        if not len(al):
            continue
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack += [(bit, al[:half], ah[:half], bl[:half], bh[:half], used[:half]),
                      (bit, al[half:], ah[half:], bl[half:], bh[half:], used[half:])]
            continue
        am, bm = middle(0, bit, al, ah), middle(1, bit, bl, bh)
        same = own & (al == bl) & (ah == bh)          # a node with itself has one mixed pair of children only
        children = []
        for left, right in ((0, 0), (1, 1), (0, 1), (1, 0)):
            l1, h1 = (al, am) if left == 0 else (am, ah)
            l2, h2 = (bl, bm) if right == 0 else (bm, bh)
            cost = used + (left != right)
            go = (l1 < h1) & (l2 < h2) & (cost <= budget)
            if (left, right) == (1, 0):
                go &= ~same
            if left == right:
                go &= ~(same & (h1 - l1 == 1))
            children.append([x[go] for x in (l1, h1, l2, h2, cost)])
        stack.append((bit - 1, *[np.concatenate(x) for x in zip(*children)]))


class Forest:
    """Union of positions by their smallest."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        up = self.up
        while len(i):
            i, j = self.root(i), self.root(j)
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(up, np.maximum(i, j), np.minimum(i, j))

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            step = self.up[x]
            if (step == x).all():
                return x
            x = self.up[step]


def reorder(bits: np.ndarray, order: Sequence[int]) -> np.ndarray:
    """The same fingerprints with the bits in another order, the first in ``order`` on top."""
    out = np.zeros_like(bits)
    for place, bit in enumerate(order):
        out |= ((bits >> np.uint64(bit)) & np.uint64(1)) << np.uint64(63 - place)
    return out


def masks(depth: int, budget: int) -> np.ndarray:
    """All numbers of ``depth`` bits with at most ``budget`` set."""
    out, layer = [0], {0}
    for _ in range(min(budget, depth)):
        layer = {x | 1 << k for x in layer for k in range(depth) if not x >> k & 1}
        out += sorted(layer)
    return np.array(out, np.int64)


def links(fingerprints: DataFrame, budget: int = BITS, subtrie: int = SUBTRIE) -> DataFrame:
    """Edges (a, b) whose components are those of all links; ``fingerprints`` has distinct ``bits``."""
    ones = fingerprints.agg(F.count("*").alias("n"), *[F.sum(F.getbit("bits", F.lit(i)).cast("bigint")).alias(f"b{i}") for i in range(64)]).first()
    n = ones["n"]
    depth = min(MOST_BITS, max(0, int(np.ceil(np.log2(max(n, 1) / subtrie)))))
    order = sorted(range(64), key=lambda i: (abs(2 * (ones[f"b{i}"] or 0) - n), -i))
    flips = masks(depth, budget)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = reorder(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), order)
            home = (own >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(own), np.int64)
            for first in range(0, len(own), 100_000):
                to = home[first:first + 100_000, None] ^ flips[None, :]
                row, flip = np.nonzero(to <= home[first:first + 100_000, None])
                yield pa.RecordBatch.from_arrays([pa.array(to[row, flip]), pa.array(own[first:first + 100_000][row].view(np.int64)),
                                                  pa.array(flip > 0)], names=["subtrie", "bits", "guest"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        at_home = np.sort(rows["bits"].to_numpy()[~rows["guest"].to_numpy()].view(np.uint64))
        guests = np.sort(rows["bits"].to_numpy()[rows["guest"].to_numpy()].view(np.uint64))
        every, forest = np.r_[at_home, guests], Forest(len(at_home) + len(guests))
        for i, j in walk(at_home, None, budget):
            forest.link(i, j)
        for i, j in walk(at_home, guests, budget):
            forest.link(i, j + len(at_home))
        down = np.flatnonzero(forest.up != np.arange(len(every)))
        back = [order.index(63 - k) for k in range(64)]         # undo the order of the bits
        undo = lambda x: reorder(x, [63 - p for p in back]).view(np.int64)
        return pd.DataFrame({"a": undo(every[down]), "b": undo(every[forest.root(down)])})

    sent = fingerprints.select("bits").mapInArrow(send, "subtrie bigint, bits bigint, guest boolean")
    return sent.groupBy("subtrie").applyInPandas(join, "a bigint, b bigint")


# ------------------------------------------------------------------ components
def components(edges: DataFrame) -> DataFrame:
    """Smallest node of the component of every node that has an edge: (node, root).

    Large-star and small-star in turn, until nothing changes: every node links its larger (then its
    smaller) neighbours to the smallest one. Minima are aggregated before the shuffle and joined back,
    so the neighbours of one node never meet in a task.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        # larger neighbours u of w go to the smallest neighbour of w, which may be w itself
        large = now.join(least, F.col("v") == F.col("w")).select("u", F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        # smaller neighbours v of u, and u itself, go to the smallest neighbour of u
        small = (large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = cut(small)
        after = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = after


def grouped(marked: DataFrame, doc_id: str = "doc_id", budget: int = BITS, subtrie: int = SUBTRIE) -> DataFrame:
    """Every row of ``marked`` (an id and ``bits``) with ``component_id``, the smallest id it can reach."""
    nodes = cut(marked.groupBy("bits").agg(F.min(doc_id).alias("first")))
    roots = components(links(nodes.select("bits"), budget, subtrie))
    linked = nodes.join(roots, F.col("bits") == F.col("node"))
    names = linked.groupBy("root").agg(F.min("first").alias("lowest"))
    named = nodes.join(roots.join(names, "root"), F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("lowest", "first").alias("component_id"))
    return marked.select(*columns_named(without(marked, ["component_id"]))).join(named, "bits")


def as_hex(bits: str = "bits") -> Column:
    return F.lower(F.lpad(F.hex(F.col(bits)), 16, "0"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BITS) -> DataFrame:
    """Id, fingerprint (16 hex digits) and component of every document."""
    marked = cut(with_fingerprint(docs, [doc_id], text, shingle))
    return grouped(marked, doc_id, budget).select(doc_id, as_hex().alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: of every group the row of the smallest id, ties broken by the text."""
    k1, k2 = row_key(doc_id, text)
    keyed = docs.select(F.struct(*columns_named(docs.columns)).alias("__row"), k1, k2, F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    marked = cut(with_fingerprint(keyed, ["k1", "k2", "__id"], "__text", shingle))
    lowest = F.min(F.struct(F.col("__id").isNull(), "__id", "k1", "k2"))
    heads = marked.groupBy("bits").agg(lowest.alias("head"))
    # group by fingerprint and root, not by component_id: that is null for groups without an id
    nodes = cut(heads)
    roots = components(links(nodes.select("bits"), budget))
    chosen = (nodes.join(roots, F.col("bits") == F.col("node"), "left").groupBy(F.coalesce("root", "bits").alias("root"))
              .agg(F.min("head").alias("head")).select("head.k1", "head.k2"))
    held = keyed.select("__row", "k1", "k2").join(chosen, ["k1", "k2"])
    # equal rows share the key: the first of them stays
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(1)))
    return held.withColumn("__copy", copy).where("__copy = 1").select("__row.*")
