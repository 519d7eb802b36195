"""Spelling variants against brute force: made-up vocabularies, odd documents, hot halves, long words."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[k:] == b[k + 1:]


def vocabulary(seed, n, letters="abß", low=2, high=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)}
    words |= {"aaaaaa", "aaaaa", "aaaaaaa", "ababab", "bababa", "abababa"}
    return sorted(w for w in words if len(w) >= low)


def test_search_finds_all_words_one_edit_apart():
    for seed, letters in ((1, "ab"), (2, "abcdeéß"), (3, "abcdefghijklmnopqrstuvwxyzàáâ")):
        words = vocabulary(seed, 300, letters)
        index = spelling.Words(words)
        every = np.arange(len(words))
        got = set()
        for right in (True, False):
            a, b = index.near(every, right)
            got |= {(words[i], words[j]) for i, j in zip(a, b)}
        assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_wide_intervals_and_split_states(monkeypatch):
    monkeypatch.setattr(spelling, "WIDE", 1)
    monkeypatch.setattr(spelling, "STATES", 64)
    test_search_finds_all_words_one_edit_apart()


def test_intervals_of_a_pattern_and_its_mirror_image():
    rng, words = random.Random(4), vocabulary(5, 60, "abc")
    index = spelling.Words(words)
    text = "".join("#" + w for w in words) + "#"
    names = ["#", *map(chr, index.alphabet)]
    for _ in range(200):
        at = rng.randrange(1, len(text) - 8)
        low, mirror, size, pattern = np.array([0]), np.array([0]), np.array([len(text)]), ""
        left, right = at, at
        for _ in range(rng.randint(1, 6)):
            to_right = rng.random() < 0.5
            if to_right:
                c, right = text[right], right + 1
                pattern += c
            else:
                left, c = left - 1, text[left - 1]
                pattern = c + pattern
            low, mirror, size = index.extend(to_right, np.array([names.index(c)]), low, mirror, size)
            if left == 0 or "#" in pattern[1:-1]:
                break
        want = sorted(m.start() for m in re.finditer(f"(?={re.escape(pattern)})", text))
        assert sorted(index.order[low[0]:low[0] + size[0]].tolist()) == want


@pytest.mark.parametrize("how", [{}, {"symbols": 100}, {"block": 4}, {"symbols": 300, "block": 1}])
def test_links_over_shards(spark, how):
    words = vocabulary(7, 150) + ["aaaaaa" + x for x in "bcdefghij"]
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    got = {(r["word"], r["near"], r["near_n"]) for r in spelling.links(df, 2, **how).collect()}
    assert got == {(a, b, len(b)) for a in words for b in words if one_edit(a, b)}


def brute(rows, least, drop):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if drop and h % drop == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    out, form = [], {}
    for w, n in words.items():
        near = sorted((-words[v], v) for v in words if one_edit(w, v))
        form[w] = near[0][1] if near and -near[0][0] >= 5 * n else None
        out.append([w, n, len(near), form[w], words[form[w]] if form[w] else None])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row.append(root)
    return sorted(map(tuple, out))


def made(seed=9):
    rng, words = random.Random(seed), ["nation", "nätion", "Stationen", "connection", "ÀÉÎÖÙß", "repeated"]
    rows = [(1, None), (2, ""), (3, " \n"), (None, "Nation nation NATION"), (4, "x" * 5000 + " " + "x" * 4999), (4, "x" * 5000 + " " + "x" * 4999)]
    for i in range(10, 200):
        text = []
        for _ in range(40):
            w = list(rng.choice(words[:1 + int(6 * rng.random() ** 2)]))
            while rng.random() < 0.12:
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], [rng.choice("aé")], [w[k], w[k]]])
            text.append("".join(w))
        rows.append((i, rng.choice(" ,\n-").join(text)))
    return rows + rows[-30:]


@pytest.mark.parametrize("drop", [None, 7, 199])
def test_variants(spark, drop):
    rows = made()
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], "doc_id long, text string, word string, n string, `a.b` string").repartition(3)
    out = spelling.variants(df, min_count=2, drop=drop)
    got = sorted(map(tuple, out.select("word", "n", "n_near", "form", "form_n", "root").collect()))
    want = brute(rows, 2, drop)
    assert got == want
    assert any(r[3] for r in want)


def test_forms_of_forms(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("other", "w020")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w037" for w, _ in chain}


def test_no_words(spark, none):
    assert spelling.variants(none).collect() == []
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert spelling.variants(df).collect() == []
