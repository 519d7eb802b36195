"""Near copies: documents whose sets of five-word shingles have a Jaccard likeness of at least 0.8, all of them.

Every set has a SimHash of its text's shingles, repeats included, and a binary trie self-join links the fingerprints that differ
in few bits (``simhash.links``). What it links is compared exactly. Alike texts often differ in ten bits, which no trie budget
finds among many texts; so the sets that the trie has not tied are joined by their shingles, and no fingerprint decides what stays.

Two sets that are alike enough share one of the first n - ceil(0.8 n) + 1 shingles of either, in whatever order all sets have in common (prefix filter). The order puts rare shingles first; how
often they occur is counted in a sample, which bears on the work only, not on the result. A posting is two 64-bit numbers, the
shingle and a short name of the set that begins with its size.

Pairs are found in two rounds. First, beside what the trie links, every set of a posting list is paired with the list's smallest one,
which ties large groups of near copies together in a linear number of pairs (a shingle common in the sample is dealt over salts, each
with a smallest set of its own). Then all pairs of a list are looked at whose sets are not tied yet. Before a text is read, a pair must
pass a bound. In a short list it is a count: the shingles that two prefixes share, and all that lies behind the prefix of either, must
be able to reach the likeness. A long list holds many sets that are almost alike enough, and a row for each pair would be too many: it
is dealt over pairs of blocks, and a block pair sends on what a bitmap allows. The bitmap of a set has 2 to 4 bits a shingle, each the
parity of the shingles that fall on it; two bitmaps differ in no more bits than the sets in shingles, so no pair that is alike enough
is lost. What passes is compared exactly, whole set against whole set. Near copies of near copies are one group.

Texts are not shuffled where it can be helped: the keys of the rows that are compared, and of the rows that may go, are broadcast
while there are at most ``KEYS`` of them.

Defined cases: a null or empty text has the empty set; a text of fewer than five words is one shingle; a text of any length
is read whole; equal sets are one node, whatever the number of their documents; of repeated rows one stays; a shingle is its
64-bit hash; no documents: no rows.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Shipped, columns_named, cut, give_back, map_rows, row_key, texts_of
from lakeops.llm.simhash import BITS, LOWER, Forest, components, links, majority

SHINGLE = 5
LIKE = (4, 5)           # least likeness, as a fraction
SAMPLE = 20_000         # documents in which shingles are counted, about
FREQUENT = 50_000       # commonest shingles known to the order
BLOCK = 512             # sets compared with one set in a task, about
HOT = 100_000           # postings of a shingle, as the sample tells, from which it is dealt over salts
LARGE = 1_000_000       # shingles compared at once after which a worker gives memory back
KEYS = 1_000_000        # row keys broadcast at most
LONG = 64               # sets of a posting list from which it is dealt over pairs of blocks


def hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles, repeats included; letters from A to Z in lower case."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:].tolist() or [len(joined)])], np.uint64)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(hashes(text, shingle))


def bitmap(found: np.ndarray) -> np.ndarray:
    """Parities of the shingles by their last bits: a power of two of bits, 2 to 4 a shingle, 64 at least."""
    size = max(64, 1 << (2 * len(found) - 1).bit_length()) if len(found) else 64
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row each) brought to ``words`` words: parities of what falls together."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


def frequent(docs: DataFrame, text: str, k1: str, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles of one of ``share`` documents, sorted, and how often they occur."""
    def run(batches):
        for batch in batches:
            found = [shingles(t) for t in texts_of(batch.column(0))]
            values, times = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
            often = times > 1                     # a shingle that is not even in two texts of a batch is not worth a row
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(times[often])], names=["shingle", "n"])
        give_back()

    some = docs.where(F.pmod(F.col(k1), F.lit(share)) == 0).select(text).mapInArrow(run, "shingle bigint, n bigint")
    rows = (some.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 2")
            .orderBy(F.col("n").desc(), "shingle").limit(FREQUENT).toPandas())
    values = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], rows["n"].to_numpy(np.int64)[order]


def prefix(found: np.ndarray, values: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The shingles of a set of which one is shared with every set that is alike enough, the rare ones first."""
    over, under = LIKE
    many = np.zeros(len(found), np.int64)
    if len(values):
        at = np.minimum(np.searchsorted(values, found), len(values) - 1)
        many = np.where(values[at] == found, times[at], 0)
    return found[np.lexsort((found, many))[:len(found) - -(-len(found) * over // under) + 1 if len(found) else 0]]


def with_set(docs: DataFrame, keep: list[str], text: str, common: Shipped) -> DataFrame:
    """The columns ``keep``, the 128-bit name of the set of shingles, its size, its short name, prefix, bitmap and fingerprint."""

    def work(column: pa.Array) -> dict:
        names, sizes, prefixes, maps, prints = [], [], [], [], []
        for t in texts_of(column):                # one set at a time
            every = hashes(t)
            s = np.unique(every)
            maps.append(bitmap(s).tobytes())
            prints.append(majority(every))
            names.append(xxhash.xxh3_128_digest(s.tobytes()))
            sizes.append(len(s))
            prefixes.append(prefix(s, *common.value).tobytes())
        n, low = np.array(sizes, np.int64), np.array([int.from_bytes(x[:6], "big") for x in names], np.int64)
        return {"node": names, "n": n, "short": size_code(n) << 48 | low, "prefix": prefixes, "map": maps,
                "bits": np.array(prints, np.uint64).view(np.int64)}

    fields = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("short", T.LongType()),
                           T.StructField("prefix", T.BinaryType()), T.StructField("map", T.BinaryType()), T.StructField("bits", T.LongType())])
    return map_rows(docs, keep, fields, [text], work)


def size_code(n: np.ndarray) -> np.ndarray:
    """A number below 2^15 that grows with ``n``, exact to a 256th of it."""
    return np.maximum((np.maximum(n, 1).astype(np.float32).view(np.int32) >> 15) - (127 << 8), 0).astype(np.int64)


def least_size(code: np.ndarray) -> np.ndarray:
    """The least size, nearly, with this code or a larger one."""
    return ((code + (127 << 8)) << 15).astype(np.int32).view(np.float32)


def postings(marked: DataFrame, common: Shipped, share: int, hot: int) -> DataFrame:
    """A row (shingle, salt, band, short) for each shingle of a prefix; equal ones of a batch are one.

    ``band`` numbers steps of size by a little over a quarter: sets whose sizes allow the likeness lie in one band or in two
    that follow one another.
    """
    def run(batches):
        for batch in batches:
            values, times = common.value
            prefixes = batch.column(0).to_pylist()
            shingle = np.frombuffer(b"".join(prefixes), np.uint64)
            short = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), [len(p) // 8 for p in prefixes])
            order = np.lexsort((short, shingle))
            shingle, short = shingle[order], short[order]
            new = np.r_[True, (shingle[1:] != shingle[:-1]) | (short[1:] != short[:-1])][:len(shingle)]
            shingle, short = shingle[new], short[new]
            salts = np.ones(len(shingle), np.int64)
            if len(values):
                at = np.minimum(np.searchsorted(values, shingle), len(values) - 1)
                salts = np.where(values[at] == shingle, 1 + times[at] * share // hot, 1)
            salt = np.where(salts > 1, (short & ((1 << 48) - 1)) % salts, -1).astype(np.int32)
            band = np.floor(np.log(least_size(short >> 48).astype(np.float64)) / np.log(1.26)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(salt), pa.array(band), pa.array(short)],
                                             names=["shingle", "salt", "band", "short"])
        give_back()

    return marked.select("prefix", "short").mapInArrow(run, "shingle bigint, salt int, band int, short bigint")


def lists(posted: DataFrame) -> DataFrame:
    """The postings of shingles that two sets or more post."""
    along = Window.partitionBy("shingle").orderBy("short")
    beside = posted.withColumns({"before": F.lag("short").over(along), "after": F.lead("short").over(along)})
    return beside.where("before IS NOT NULL OR after IS NOT NULL").select("shingle", "salt", "band", "short").distinct()


def size_of(short: Column, up: int = 0) -> Column:
    """The least size of a set of this short name; with ``up`` = 1 a size above its largest."""
    code = F.shiftright(short, 48) + up
    return F.pow(F.lit(2.0), F.shiftright(code, 8)) * (1 + code.bitwiseAND(F.lit(255)) / 256)


def able(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) that may be alike, of rows that each stand for a shared shingle of the prefixes.

    Of two prefixes one ends first in the common order; what the sets share up to there is counted, and behind it the set of that
    prefix has ceil(0.8 n) - 1 shingles left.
    """
    over, under = LIKE
    share, a, b = over / under, F.col("a"), F.col("b")
    most = F.col("c") + share * F.greatest(size_of(a, 1), size_of(b, 1))
    least = share / (1 + share) * (size_of(a) + size_of(b))
    fits = size_of(F.least("a", "b"), 1) >= share * size_of(F.greatest("a", "b"))
    return pairs.where(fits).groupBy("a", "b").agg(F.count("*").alias("c")).where(most >= least).select("a", "b")


def alike(sets: list[np.ndarray]) -> Forest:
    """Spanning forest of the pairs of sets alike enough. A set that is tied to all later ones already is not compared again."""
    over, under = LIKE
    sizes = np.array([len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(token, kind="stable")
    held, counts = owner[order], np.bincount(token)
    ends, first, forest = np.cumsum(counts), np.cumsum(sizes) - sizes, Forest(len(sets))
    every = np.arange(len(sets))
    for i in range(len(sets)):
        roots = forest.root(every[i:])
        if (roots == roots[0]).all():
            continue
        own = token[first[i]:first[i] + sizes[i]]
        n = counts[own]
        # the owners of each shingle stand in one run of ``held``
        at = np.repeat(ends[own] - np.cumsum(n), n) + np.arange(n.sum())
        shared = np.bincount(held[at], minlength=len(sets))
        near = shared * under >= (sizes + sizes[i] - shared) * over
        near[:i + 1] = False
        j = np.flatnonzero(near)
        forest.link(np.full(len(j), i), j)
    return forest


def compared(pairs: DataFrame, nodes: DataFrame, keyed: DataFrame, block: int = BLOCK, most_keys: int = KEYS) -> DataFrame:
    """Edges (a, b) between sets alike enough: at least those of ``pairs`` (short names); ``nodes``: node, short, k1, k2, copies."""
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    dealt = pairs.join(chunks, "a").select("a", F.col("b").alias("short"), F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    own = chunks.select("a", F.col("a").alias("short"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    wanted = cut(dealt.unionByName(own).join(nodes, "short").select("a", "chunk", "node", "k1", "k2", "copies"))
    text = keyed.select("k1", "k2", "__text").join(few(wanted.select("k1").distinct(), most_keys), "k1", "left_semi")
    # equal rows share the key: one text of them is enough
    one = text.join(wanted.where("copies > 1"), ["k1", "k2"]).groupBy("a", "chunk", "node").agg(F.first("__text").alias("text"))
    single = text.join(few(wanted.where("copies = 1"), most_keys), ["k1", "k2"]).select("a", "chunk", "node", F.col("__text").alias("text"))

    def join(rows):
        sets = [shingles(t) for t in rows["text"]]
        forest = alike(sets)
        if sum(map(len, sets)) > LARGE:
            give_back()
        node, down = rows["node"].to_numpy(), np.flatnonzero(forest.up != np.arange(len(rows)))
        return pd.DataFrame({"a": node[down], "b": node[forest.root(down)]})

    return single.unionByName(one).groupBy("a", "chunk").applyInPandas(join, "a binary, b binary")


def linked(nodes: DataFrame, budget: int = BITS) -> DataFrame:
    """Pairs (a, b) of short names that the trie join of the fingerprints links: of every link, and of equal fingerprints, one pair."""
    prints = cut(nodes.groupBy("bits").agg(F.min("short").alias("first")))
    first = lambda side: prints.select(F.col("bits").alias(side), F.col("first").alias("of_" + side))
    across = links(prints.select("bits"), budget).join(first("a"), "a").join(first("b"), "b").select("of_a", "of_b")
    equal = nodes.join(prints, "bits").select("first", "short")
    return across.unionByName(equal.toDF("of_a", "of_b")).select(
        F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).where("a != b").distinct()


def may_be_alike(a: np.ndarray, b: np.ndarray, maps_a: list[np.ndarray], maps_b: list[np.ndarray]) -> np.ndarray:
    """Which sets (short names, bitmaps) of one list may be alike enough to which of the other: no more bits differ than shingles may."""
    over, under = LIKE
    most = lambda short: least_size((short >> 48) + 1).astype(np.float64)
    fits = np.minimum.outer(most(a), most(b)) * under >= np.maximum.outer(least_size(a >> 48), least_size(b >> 48)).astype(np.float64) * over
    room = np.add.outer(most(a), most(b)) * (under - over) / (under + over)
    sizes_a, sizes_b = np.array([len(m) for m in maps_a]), np.array([len(m) for m in maps_b])
    for x in np.unique(sizes_a):
        for y in np.unique(sizes_b):
            i, j = np.flatnonzero(sizes_a == x), np.flatnonzero(sizes_b == y)
            if not fits[np.ix_(i, j)].any():
                continue
            words = min(x, y)
            other = folded(np.stack([maps_b[k] for k in j]), words)
            for k, row in zip(i, folded(np.stack([maps_a[k] for k in i]), words)):
                fits[k, j] &= np.bitwise_count(other ^ row).sum(axis=1, dtype=np.int64) <= room[k, j]
    return fits


def long_lists(parted: DataFrame, long: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Pairs (a, b) of the lists ``long`` (shingle, blocks) that are not tied and that the bitmaps allow."""
    own = parted.join(long, "shingle").withColumn("own", F.pmod(F.xxhash64("short"), F.col("blocks")))
    dealt = own.select("shingle", "short", "root", "own", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")).select(
        "shingle", "short", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def join(rows):
        maps = [np.frombuffer(m, np.uint64) for m in rows["map"]]
        short, home, root = rows["short"].to_numpy(np.int64), rows["own"].to_numpy(), rows["root"].tolist()
        left, right = np.flatnonzero(home == rows["i"].iloc[0]), np.flatnonzero(home == rows["j"].iloc[0])
        near = may_be_alike(short[left], short[right], [maps[k] for k in left], [maps[k] for k in right])
        number = {r: n for n, r in enumerate({r for r in root if r is not None})}
        tree = np.array([-1 - k if r is None else number[r] for k, r in enumerate(root)])
        x, y = np.nonzero(near & (tree[left][:, None] != tree[right][None, :]))
        x, y = short[left[x]], short[right[y]]
        return pd.DataFrame({"a": np.minimum(x, y)[x != y], "b": np.maximum(x, y)[x != y]}).drop_duplicates()

    return dealt.join(nodes.select("short", "map"), "short").groupBy("shingle", "i", "j").applyInPandas(join, "a bigint, b bigint").distinct()


def groups(posted: DataFrame, nodes: DataFrame, keyed: DataFrame, block: int = BLOCK, most_keys: int = KEYS, long: int = LONG) -> DataFrame:
    """Root of every set that is alike to another: (node, root)."""
    held = cut(lists(posted))
    smallest = F.first("short").over(Window.partitionBy("shingle", "salt", "band").orderBy("short").rowsBetween(Window.unboundedPreceding, 0))
    stars = held.select(smallest.alias("a"), F.col("short").alias("b")).where("a != b")
    near = cut(compared(cut(linked(nodes).unionByName(able(stars)).distinct()), nodes, keyed, block, most_keys))
    tied = components(near)
    # a short name of two sets is tied to nothing here
    known = tied.join(nodes, "node").groupBy("short").agg(F.first("root").alias("root"), F.count("*").alias("n")).where("n = 1")
    parted = cut(held.join(known, "short", "left").select("shingle", "short", "root"))
    untied = F.count_if(F.col("root").isNull()) + F.count_distinct("root")
    sized = cut(parted.groupBy("shingle").agg(F.count("*").alias("n"), untied.alias("trees")).where("trees > 1")
                .select("shingle", F.ceil(F.col("n") / block).alias("blocks"), (F.col("n") >= long).alias("long")))
    # a pair that meets in a long list is judged there, whatever short lists count of it
    some = parted.join(sized.where("NOT long").select("shingle"), "shingle", "left_semi")
    left, right = some.withColumnsRenamed({"short": "a", "root": "ra"}), some.withColumnsRenamed({"short": "b", "root": "rb"})
    rest = left.join(right, "shingle").where("a < b AND (ra IS NULL OR rb IS NULL OR ra != rb)").select("a", "b")
    found = able(rest).unionByName(long_lists(parted, sized.where("long").select("shingle", "blocks"), nodes, block)).distinct()
    return components(near.unionByName(compared(cut(found), nodes, keyed, block, most_keys)))


def few(keys: DataFrame, most: int) -> DataFrame:
    """The keys, marked for broadcast if there are at most ``most``."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, hot: int = HOT, most_keys: int = KEYS,
                long: int = LONG) -> DataFrame:
    """The rows of ``docs`` without near copies: of every group the row of the smallest id, ties broken by the text."""
    k1, k2 = row_key(doc_id, text)
    keyed = docs.select(F.struct(*columns_named(docs.columns)).alias("__row"), k1, k2, F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    share = max(1, docs.count() // SAMPLE)
    common = Shipped(docs.sparkSession, frequent(keyed, "__text", "k1", share))
    marked = cut(with_set(keyed, ["k1", "k2", "__id"], "__text", common))
    lowest = F.min(F.struct(F.col("__id").isNull(), "__id", "k1", "k2"))
    nodes = cut(marked.groupBy("node").agg(lowest.alias("head"), F.first("short").alias("short"), F.first("map").alias("map"),
                                           F.min("bits").alias("bits"), F.count("*").alias("rows")))
    repeated = marked.groupBy("k1", "k2").agg(F.count("*").alias("copies")).where("copies > 1")
    heads = cut(nodes.select("node", "short", "map", "bits", "head.k1", "head.k2").join(repeated, ["k1", "k2"], "left").na.fill(1, ["copies"]))
    roots = cut(groups(postings(marked, common, share, hot), heads, keyed, block, most_keys, long).withColumnRenamed("node", "linked"))
    chosen = (nodes.join(roots, F.col("node") == F.col("linked")).groupBy("root").agg(F.min("head").alias("first")))
    # the head that stays, for every node that has several rows or is near another; rows of other nodes stay as they are
    fate = (nodes.join(roots, F.col("node") == F.col("linked"), "left").join(chosen, "root", "left").where("rows > 1 OR root IS NOT NULL")
            .select("node", F.coalesce("first", "head").alias("first")))
    judged = marked.join(fate, "node").groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.first("first").alias("first")).select(
        "k1", "k2", ((F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))).alias("stays"), (F.col("copies") > 1).alias("many"))
    held = keyed.select("__row", "k1", "k2").join(few(cut(judged), most_keys), ["k1", "k2"], "left")
    # equal rows share the key: the first of them stays
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(1)))
    several = held.where("stays AND many").withColumn("__copy", copy).where("__copy = 1").select("__row.*")
    return held.where("stays IS NULL OR (stays AND NOT many)").select("__row.*").unionByName(several)
