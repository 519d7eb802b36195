"""Near copies of the pipeline against the likeness of every pair."""
import os
import random
import sys

import numpy as np
import pytest
from conftest import DOCS
from helpers_llm import WORDS

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from lakeops.llm import near_copies, simhash  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    words = WORDS((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_left(rows):
    """Ids that stay: the smallest of each component of the pairs with a Jaccard likeness of 0.8."""
    sets = [brute_set(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                up[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append((r[0] is None, r[0] or 0))
    return sorted(min(g) for g in groups.values())


def planted():
    """Near copies beside texts that stay just below the likeness, in groups, chains and under a common line."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, i = [], 0
    common = [word() for _ in range(12)]
    for length in (50, 80, 200, 900):
        for _ in range(6):
            base = [word() for _ in range(length)] + common
            for changes in (0, 1, 1, 2, 3, length // 60 + 1, length // 40 + 1, length // 20 + 1):
                words = list(base)
                for _ in range(changes):
                    words[rng.randrange(length)] = word().upper()
                rows.append((i, " ".join(words)))
                i += 1
            base = list(words)
    hub = [word() for _ in range(120)]
    for _ in range(40):                       # all near the hub's text, few near one another
        words = list(hub)
        for _ in range(2):
            words[rng.randrange(len(hub))] = word()
        rows.append((i, " ".join(words)))
        i += 1
    rows += [(i, " ".join(hub)), (i + 1, " ".join(hub).replace(" ", "\n")), (None, " ".join(hub))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{"block": 3}, {}, {"hot": 4}, {"hot": 12, "most_keys": 0}])
def test_all_near_copies_go(spark, how):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    left = near_copies.one_of_each(df, **how).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left) == brute_left(rows)


def test_the_stage_finds_copies_beyond_two_bits(spark):
    rows = planted()
    ids = {i: t for i, t in rows if i is not None}
    far = [(i, j) for i in ids for j in ids if i < j and 5 * len(brute_set(ids[i]) & brute_set(ids[j])) >= 4 * len(brute_set(ids[i]) | brute_set(ids[j]))
           and (simhash.fingerprint(ids[i]) ^ simhash.fingerprint(ids[j])).bit_count() > 2]
    assert len(far) > 50
    df = spark.createDataFrame([(i, t, "en", "a", len(t), "", "", "", "") for i, t in rows], DOCS)
    left = corpus_pipeline.near_copies(spark, df, "")
    assert left.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left.collect()) == brute_left(rows)


def test_odd_rows(spark, odd, none, rows):
    got = near_copies.one_of_each(odd)
    assert got.columns == odd.columns and near_copies.one_of_each(none).count() == 0
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == brute_left(rows)


def test_order_of_shingles_does_not_matter():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 62, 100, dtype=np.uint64))
    for gone in range(0, 23):
        a, b = base, base[gone:]
        common = np.sort(rng.choice(base, 40, replace=False))
        share = np.intersect1d(near_copies.prefix(a, common, np.arange(3, 43)), near_copies.prefix(b, common, np.arange(3, 43)))
        assert len(share) or 5 * len(b) < 4 * len(a)
    assert not len(near_copies.prefix(base[:0], base, base.view(np.int64)))


def test_sizes_within_the_likeness_lie_in_neighbouring_bands():
    n = np.r_[np.arange(1, 5_000), np.unique(np.geomspace(5_000, 1e9, 5_000).astype(np.int64))]
    code = near_copies.size_code(n)
    assert (np.diff(code) >= 0).all() and code.max() < 1 << 15
    band = lambda m: np.floor(np.log(near_copies.least_size(near_copies.size_code(m)).astype(np.float64)) / np.log(1.26))
    for m in (n, -(-n * 9 // 10), -(-n * 4 // 5)):
        assert (band(n) - band(m) <= 1).all()


def test_columns_with_dots(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y")], "doc_id long, text string, `a.b` string")
    assert [tuple(r) for r in near_copies.one_of_each(df).collect()] == [(1, "a b c d e f", "x")]


def variants(rng, n, length, changes):
    """Texts that share a base and differ from it in ``changes`` words each: near it, mostly not near one another."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    base = [word() for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for k in rng.sample(range(length), changes):
            words[k] = word()
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("how", [{"long": 2, "block": 7}, {"long": 30, "block": 40}])
def test_long_lists_lose_no_pair(spark, how):
    rng = random.Random(9)
    texts = variants(rng, 90, 300, 6) + variants(rng, 40, 60, 1) + [t for _, t in planted()]
    rows = list(enumerate(texts))
    left = near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **how).collect()
    assert sorted((False, r["doc_id"]) for r in left) == brute_left(rows)


def test_bitmaps_allow_what_is_alike_and_little_else():
    rng = np.random.default_rng(4)
    for n in (1, 5, 90, 700, 3_000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for gone in (0, n // 20, n // 10, n // 5, n // 2):
            other = np.unique(np.r_[base[gone:], rng.integers(0, 1 << 63, gone // 2, dtype=np.uint64)])
            sets = [base, other]
            short = near_copies.size_code(np.array([len(x) for x in sets])) << 48
            maps = [near_copies.bitmap(x) for x in sets]
            may = near_copies.may_be_alike(short[:1], short[1:], maps[:1], maps[1:])[0, 0]
            shared = len(np.intersect1d(*sets))
            likeness = shared / max(1, len(base) + len(other) - shared)
            assert may or likeness < 0.8
            assert not may or likeness > 0.6 or n < 90


def test_the_trie_links_fingerprints_within_its_bits(spark):
    nodes = [(10, 0b0000), (11, 0b0000), (12, 0b0011), (13, 0b1111), (14, 255 << 32)]
    got = near_copies.linked(spark.createDataFrame(nodes, "short long, bits long")).collect()
    up = {r["a"] for r in got} | {r["b"] for r in got}
    assert up == {10, 11, 12, 13} and len(got) == 3
