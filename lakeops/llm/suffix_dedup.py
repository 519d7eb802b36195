"""Removal of repeated byte strings by sorted suffixes.

A byte goes when a string of ``LENGTH`` bytes over it also starts anywhere else. Suffixes are sorted only
where strings can agree: of all ``GRAM``-byte hashes inside a string the lowest is its anchor, which equal
strings share at the same offset, so every repeat shows at anchors. The strings with one anchor overlap;
together they are the anchor's stretch, and an anchor whose gram stands nowhere else is dropped.

1. Grams are hashed and counted over the cluster; anchors with a repeated gram stay.
2. Equal stretches (128-bit digest) are counted: one that occurs twice is repeated whole, in all copies.
3. Different stretches of one gram are sorted, both by what follows the anchor and, backwards, by what
   precedes it. The sort is deep-shallow: multikey quicksort down to ``SHALLOW`` bytes, then a blind trie
   for each group that still agrees. A string at offset o from its anchor is repeated when another stretch
   has the same class at depth o on the left and at depth LENGTH - o on the right, where classes are runs
   of neighbours in the two orders whose common prefixes reach that depth.
4. A gram with more than ``MOST`` different stretches is not sorted in one task: its strings are counted
   one by one over the cluster by 128-bit digest, with partial sums before the shuffle.

Every string is judged on the input. Nothing is sampled: windows without an anchor do not exist, since a
lowest hash always does, ties going to the left.

Defined cases: a null text is the empty text; texts shorter than LENGTH stay; rows with the same id and
text are copies of each other and both go; matches never cross documents.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import blocks, cut, map_rows, row_key, whole

LENGTH = 200
GRAM = 48
SHALLOW = 64              # depth, in bytes, at which multikey quicksort hands over to blind tries
BLOCK = 2_000_000         # bytes of text hashed at once
POSITION_BITS = 32        # the rest of a word ranks the grams; ties go to the left
MOST = 200_000            # different stretches of one gram that are sorted in a task
FLUSH = 50_000            # stretches sorted together


# ------------------------------------------------------------------ anchors
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or next(iter(_POWERS)) < n:
        _POWERS.clear()
        base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
        inverse = np.full(n, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
        base[0] = inverse[0] = 1
        _POWERS[n] = np.cumprod(base), np.cumprod(inverse)
    return next(iter(_POWERS.values()))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the gram at every position (the last gram - 1 positions have none)."""
    power, inverse = _powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * inverse[:len(data) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: text number, anchor, first and last string start (positions in ``data``), gram hash."""
    none = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    if len(data) < length:
        return none
    hashes = gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << POSITION_BITS) - 1)
    at = (lowest((hashes & ~low) | place, length - gram + 1) & low).astype(np.int64)
    start = np.arange(len(at))
    text = np.searchsorted(bounds, start, "right") - 1
    inside = start + length <= bounds[text + 1]
    start, at, text = start[inside], at[inside], text[inside]
    if not len(start):
        return none
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(text) != 0)])
    ends = np.r_[new[1:], len(start)] - 1
    return text[new], at[new], start[new], start[ends], hashes[at[new]]


def gram_column(column: pa.Array, length: int, gram: int) -> Iterator[tuple]:
    for first, data, bounds in blocks(column, BLOCK):
        yield first, data, bounds, *anchors(data, bounds, length, gram)


def repeated_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors whose gram is an anchor's elsewhere too: (k1, k2, gram, s1, s2, before, at, after).

    Stretches reach from ``before`` bytes ahead of the anchor ``at`` to ``after`` bytes on; s1, s2 is their digest.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, h in gram_column(batch.column("text"), length, gram):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["gram"])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            for first, data, bounds, text, at, low, high, h in gram_column(batch.column("text"), length, gram):
                raw = data.tobytes()
                digest = xxhash.xxh3_128_digest
                named = b"".join([digest(raw[a:b + length], c - a) for a, b, c in zip(low.tolist(), high.tolist(), at.tolist())])
                s = np.frombuffer(named, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[first + text], k2[first + text], h.view(np.int64), s[:, 0], s[:, 1], (at - low).astype(np.int32),
                                           (at - bounds[text]).astype(np.int64), (high + length - at).astype(np.int32))],
                    names=["k1", "k2", "gram", "s1", "s2", "before", "at", "after"])

    several = docs.select("text").mapInArrow(hashes, "gram bigint").groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    found = docs.select("k1", "k2", "text").mapInArrow(
        stretches, "k1 bigint, k2 bigint, gram bigint, s1 bigint, s2 bigint, before int, at bigint, after int")
    return cut(found.join(several, "gram"))


# ------------------------------------------------------------------ deep-shallow sort
def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - 1 - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() - 1) // 8


def blind_trie(strings: Sequence[bytes], group: list[int]) -> list[int]:
    """``group`` in order, through a trie that keeps the branching depths and bytes only."""
    # a node is [depth, {byte or -1 past the end: child}], a leaf the list of equal strings
    root: list | None = None
    for i in group:
        s = strings[i]
        if root is None:
            root = [None, [i]]
            continue
        # go down blindly: any leaf reached shares with s at least the depth at which s leaves the trie
        node = root
        while node[0] is not None:
            depth, children = node
            node = children.get(s[depth] if depth < len(s) else -1) or next(iter(children.values()))
        other = strings[node[1][0]]
        shared = common_prefix(s, other)
        if shared == len(s) == len(other):
            node[1].append(i)
            continue
        parent, key, node = None, None, root
        while node[0] is not None and node[0] < shared:
            parent, key = node, s[node[0]]
            node = node[1][key]
        own = s[shared] if shared < len(s) else -1
        if node[0] == shared:
            node[1][own] = [None, [i]]
        else:
            theirs = other[shared] if shared < len(other) else -1
            split = [shared, {theirs: node, own: [None, [i]]}]
            if parent is None:
                root = split
            else:
                parent[1][key] = split
    out: list[int] = []
    stack = [root] if root else []
    while stack:
        depth, below = stack.pop()
        if depth is None:
            out += below
        else:
            stack += [below[k] for k in sorted(below, reverse=True)]
    return out


def deep_shallow(strings: Sequence[bytes], shallow: int = SHALLOW, step: int = 8) -> list[int]:
    """Positions of the strings in order: multikey quicksort by ``step`` bytes to the depth ``shallow``, then blind tries."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            out += group
        elif depth >= shallow:
            out += blind_trie(strings, group)
        else:
            keys = [strings[i][depth:depth + step] for i in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(group, keys) if k < pivot]
            same = [i for i, k in zip(group, keys) if k == pivot]
            more = [i for i, k in zip(group, keys) if k > pivot]
            # a short pivot is the end of its strings: they are equal
            stack += [(more, depth), (same, depth + step if len(pivot) == step else shallow), (less, depth)]
    return out


def classes(strings: Sequence[bytes], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their grams, and the common prefix of each with the one before (-1 for another gram)."""
    order: list[int] = []
    bounds = np.flatnonzero(np.r_[True, np.diff(grams) != 0, True])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        order += [a + i for i in deep_shallow(strings[a:b])] if b - a > 1 else [a]
    prefix = [-1] * len(order)
    for k in range(1, len(order)):
        i, j = order[k - 1], order[k]
        if grams[i] == grams[j]:
            prefix[k] = common_prefix(strings[i], strings[j])
    return np.array(order), np.array(prefix)


def repeated_offsets(grams: np.ndarray, befores: np.ndarray, afters: np.ndarray, contents: Sequence[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per stretch the spans, relative to its anchor, that strings shared with another stretch of its gram cover.

    Rows must be in order of ``grams`` and differ within one.
    """
    n = len(contents)
    right_order, right = classes([c[b:] for c, b in zip(contents, befores.tolist())], grams)
    left_order, left = classes([c[:b][::-1] for c, b in zip(contents, befores.tolist())], grams)
    low, high = np.empty(n, np.int64), np.empty(n, np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for o in range(int(befores.max(initial=-1)), -1, -1):
        able = np.flatnonzero((befores >= o) & (afters >= length - o))
        if len(able) < 2:
            continue
        low[left_order] = np.cumsum(left < o)
        high[right_order] = np.cumsum(right < length - o)
        key = low[able] * (n + 1) + high[able]
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        for i in able[order[np.r_[False, same] | np.r_[same, False]]].tolist():
            mine = spans[i]
            if mine and mine[-1][1] >= -o:
                mine[-1] = mine[-1][0], length - o
            else:
                mine.append((-o, length - o))
    return spans


SPANS = "array<struct<start:int,stop:int>>"
SHARED = T.StructType([T.StructField("gram", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
                       T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])))])


def sort_stretches(contents: DataFrame, length: int) -> DataFrame:
    """Spans shared between different stretches of a gram; rows of a gram are in one task, at most MOST of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table) -> pa.RecordBatch:
            grams, s1, s2 = (rows.column(c).to_numpy() for c in ("gram", "s1", "s2"))
            spans = repeated_offsets(grams, rows.column("before").to_numpy(), rows.column("after").to_numpy(), rows.column("content").to_pylist(), length)
            some = [i for i, x in enumerate(spans) if x]
            shared = pa.array([[{"start": a, "stop": b} for a, b in spans[i]] for i in some],
                              pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            return pa.RecordBatch.from_arrays([pa.array(grams[some]), pa.array(s1[some]), pa.array(s2[some]), shared], names=["gram", "s1", "s2", "spans"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= FLUSH:
                rows = pa.Table.from_batches(held).combine_chunks()
                grams = rows.column("gram").to_numpy()
                whole_grams = int(np.searchsorted(grams, grams[-1], "left"))        # the last gram may go on
                if whole_grams:
                    yield flush(rows.slice(0, whole_grams))
                held = rows.slice(whole_grams).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
        if size:
            yield flush(pa.Table.from_batches(held))

    return contents.sortWithinPartitions("gram").mapInArrow(run, SHARED)


def count_strings(contents: DataFrame, length: int) -> DataFrame:
    """The same by counting every string; for grams with many different stretches."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows = batch.to_pylist()
            for first in range(0, len(rows), 1_000):
                out, named = [], []
                for r in rows[first:first + 1_000]:
                    for o in range(max(0, length - r["after"]), r["before"] + 1):
                        at = r["before"] - o
                        out.append((r["gram"], r["s1"], r["s2"], o))
                        named.append(digest(r["content"][at:at + length], o))
                w = np.frombuffer(b"".join(named), "<i8").reshape(-1, 2)
                g, s1, s2, o = zip(*out) if out else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(o, pa.int32()), pa.array(w[:, 0]), pa.array(w[:, 1])],
                    names=["gram", "s1", "s2", "o", "w1", "w2"])

    each = contents.mapInArrow(strings, "gram bigint, s1 bigint, s2 bigint, o int, w1 bigint, w2 bigint")
    several = each.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    span = F.struct((-F.col("o")).cast("int").alias("start"), (length - F.col("o")).cast("int").alias("stop"))
    return each.join(several, ["w1", "w2"]).groupBy("gram", "s1", "s2").agg(F.collect_list(span).alias("spans"))


# ------------------------------------------------------------------ the operator
def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and out[-1][1] >= a:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """Id, whole text and the spans (start, stop, in bytes; they may overlap) that go, per document."""
    k1, k2 = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), k1, k2, whole(text).alias("text"))
    found = repeated_anchors(rows, length, gram)
    where = F.struct("k1", "k2", "at", "before", "after")
    kinds = found.groupBy("gram", "s1", "s2").agg(F.count("*").alias("n"), F.min(where).alias("one"))
    grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    kinds = cut(kinds.join(grams, "gram", "left"))
    copied = kinds.where("n > 1").select("gram", "s1", "s2", F.array(F.struct(
        (-F.col("one.before")).alias("start"), F.col("one.after").alias("stop"))).cast(SPANS).alias("spans"))
    # of each kind that may share strings with another, one stretch is read; a document lists its own
    single = kinds.where("kinds > 1").select(
        F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2"),
        F.struct("gram", "s1", "s2", "kinds", F.col("one.at").alias("at"), F.col("one.before").alias("before"), F.col("one.after").alias("after")).alias("x"))
    wanted = single.groupBy("k1", "k2").agg(F.collect_list("x").alias("wanted"))
    held = rows.join(wanted, ["k1", "k2"])
    contents = cut(read_stretches(held))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-contents.count() // FLUSH))
    shared = sort_stretches(contents.where(F.col("kinds") <= most).repartition(parts, "gram"), length)
    if kinds.where(F.col("kinds") > most).limit(1).count():
        shared = shared.unionByName(count_strings(contents.where(F.col("kinds") > most), length))
    spans = copied.unionByName(shared.join(copied.select("gram", "s1", "s2"), ["gram", "s1", "s2"], "left_anti"))
    placed = found.join(spans, ["gram", "s1", "s2"]).select("k1", "k2", F.transform("spans", lambda s: F.struct(
        (F.col("at") + s["start"]).alias("start"), (F.col("at") + s["stop"]).alias("stop"))).alias("spans"))
    by_doc = placed.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return rows.join(by_doc, ["k1", "k2"], "left").select(F.col("doc_id").alias(doc_id), "text", "spans")


def read_stretches(held: DataFrame) -> DataFrame:
    schema = "gram bigint, s1 bigint, s2 bigint, kinds bigint, before int, after int, content binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                raw, want = batch.column("text")[n].as_py().encode("utf-8"), batch.column("wanted")[n].values
                at, before, after = (want.field(c).to_numpy(zero_copy_only=False) for c in ("at", "before", "after"))
                content = [raw[a - b:a + c] for a, b, c in zip(at.tolist(), before.tolist(), after.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[want.field(c) for c in ("gram", "s1", "s2", "kinds", "before", "after")], pa.array(content, pa.binary())],
                    names=["gram", "s1", "s2", "kinds", "before", "after", "content"])

    return held.select("text", "wanted").mapInArrow(run, schema)


DIGESTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])


def digests(spanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans and SHA-256 of the bytes that stay."""

    def work(texts: pa.Array, spans: pa.Array) -> dict[str, list]:
        rows = []
        for text, gone in zip(texts.to_pylist(), spans.to_pylist()):
            raw, gone = text.encode("utf-8"), merged(gone)
            stays, at = [], 0
            for a, b in gone:
                stays.append(raw[at:a])
                at = b
            kept = b"".join([*stays, raw[at:]])
            rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
        return dict(zip(DIGESTS.names, map(list, zip(*rows))))

    return map_rows(spanned, [doc_id], DIGESTS, ["text", "spans"], work)
