"""Spelling variants: words one edit apart, found in a bidirectional FM-index by a search scheme.

Two words one edit apart share, to the letter, either the first or the second half of each of them. So the index is cut into
shards by hashes of halves, every shard holding whole words between delimiters. Inside a shard the intervals of suffix ranks
of a pattern and of its mirror image are kept together (a pattern grows to the left by the one, to the right by the other):
a query's half is matched exactly up to the delimiter, then the search turns and crosses the other half with exactly one
inserted, deleted or replaced letter, on to the delimiter there. All queries of a shard step together as arrays.

A half that very many words share is dealt into blocks of words and of queries, every pair of blocks apart, so a shard's size
is bounded whatever the words are; links are the same. Words are counted by Spark in built-in expressions; forms of forms
are followed by pointer doubling, a join a step.

Defined cases: a null or empty text has no words; a null id counts as the empty text in ``drop``; repeated rows count each;
of near words with equal counts the first in code-point order is the form; no documents: no rows. A word may be of any length.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import cut, whole

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5               # a form stands at least this many times as often as the word
SYMBOLS = 500_000       # letters sent to a shard, about
BLOCK = 20_000          # words, or queries, of one half in a shard at most, about
WIDE = 128              # suffixes of an interval up to which its letters are read, not tried
STEP = 32               # places between stored counts
STATES = 200_000        # states of the search held at once, about


# ------------------------------------------------------------------ words
def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                drop: int | None = None) -> DataFrame:
    """Words (runs of letters, A to Z in lower case) of enough letters and occurrences: ``word``, ``n``.

    With ``drop``, an occurrence whose hash of id and word it divides loses the letter at that hash: made-up misspellings.
    """
    runs = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(whole(f"`{text}`"), F.lit(LETTERS), F.lit(0))).alias("run"))
    words = runs.where(F.length("run") >= min_length).select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if drop:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod("h", F.length("word")).cast("int")
        cut_out = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.withColumn("h", h).select(F.when(F.pmod("h", F.lit(drop)) == 0, cut_out).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ the index
class Ranks:
    """Counts of the letters in front of any place of a Burrows-Wheeler transform, stored every ``STEP`` places."""

    def __init__(self, bwt: np.ndarray, letters: int):
        steps = len(bwt) // STEP + 1
        self.bwt = bwt
        self.blocks = np.full(steps * STEP, 255 if bwt.dtype == np.uint8 else np.iinfo(bwt.dtype).max, bwt.dtype)
        self.blocks[:len(bwt)] = bwt
        self.blocks = self.blocks.reshape(steps, STEP)
        held = np.bincount(np.arange(len(bwt)) // STEP * letters + bwt, minlength=steps * letters).reshape(steps, letters)
        self.below = np.zeros((steps, letters + 1), np.int32)             # of letters smaller than each, in front of the block
        np.cumsum((np.cumsum(held, axis=0) - held), axis=1, out=self.below[:, 1:])

    def smaller(self, letter: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Letters smaller than ``letter`` in front of ``place``."""
        block = place // STEP
        inside = (self.blocks[block] < letter[:, None]) & (np.arange(STEP) < (place % STEP)[:, None])
        return self.below[block, letter] + inside.sum(axis=1)


def suffix_order(text: np.ndarray, letters: int, depth: int) -> np.ndarray:
    """Starts of the suffixes, sorted by their first ``depth`` letters at least; behind the end stand delimiters."""
    bits = max(1, int(letters - 1).bit_length())
    packed, key = max(1, 62 // bits), np.zeros(len(text), np.int64)
    padded = np.r_[text.astype(np.int64), np.zeros(packed, np.int64)]
    for k in range(packed):
        key = key << bits | padded[k:k + len(text)]
    known = packed
    while True:
        order = np.argsort(key, kind="stable")
        if known >= depth:
            return order
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        ahead = np.zeros(len(text), np.int64)
        ahead[:max(0, len(text) - known)] = rank[known:] + 1
        key, known = rank * (len(text) + 1) + ahead, 2 * known


class Words:
    """Bidirectional FM-index over distinct words, each between delimiters (letter 0)."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        self.length = np.array([len(p) for p in points])
        self.alphabet = np.unique(np.concatenate([*points, np.empty(0, np.uint32)]))
        kind = np.uint8 if len(self.alphabet) < 254 else np.int32
        self.start = np.cumsum(self.length + 1) - self.length               # of each word; a delimiter stands in front
        self.text = np.zeros(int((self.length + 1).sum()) + 1, kind)
        inside = np.ones(len(self.text), bool)
        inside[np.r_[0, self.start + self.length]] = False
        self.text[inside] = np.searchsorted(self.alphabet, np.concatenate([*points, np.empty(0, np.uint32)])) + 1
        self.letters = len(self.alphabet) + 1
        self.first = np.cumsum(np.bincount(self.text, minlength=self.letters)) - np.bincount(self.text, minlength=self.letters)
        depth = int(self.length.max(initial=0)) + 3
        self.order, self.left = self._side(self.text, depth)                # letters on the left of a pattern
        _, self.right = self._side(self.text[::-1], depth)                  # and on its right, from the mirror image

    def _side(self, text: np.ndarray, depth: int) -> tuple[np.ndarray, Ranks]:
        order = suffix_order(text, self.letters, depth)
        return order, Ranks(text[order - 1], self.letters)

    def extend(self, right: bool, letter: np.ndarray, low: np.ndarray, mirror: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of the patterns longer by a letter: first rank, first rank of the mirror image, number of suffixes."""
        ranks, own, other = (self.right, mirror, low) if right else (self.left, low, mirror)
        n = len(letter)
        both = np.r_[letter, letter + 1]
        from_, to = (ranks.smaller(both, np.r_[x, x]) for x in (own, own + size))
        before = from_[n:] - from_[:n]
        own, size, other = self.first[letter] + before, to[n:] - to[:n] - before, other + to[:n] - from_[:n]
        return (other, own, size) if right else (own, other, size)

    def letters_of(self, right: bool, low: np.ndarray, mirror: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the interval, letter) of the letters, no delimiters, that may extend each interval."""
        bwt, at = (self.right.bwt, mirror) if right else (self.left.bwt, low)
        few = np.flatnonzero(size <= WIDE)
        owner = np.repeat(few, size[few])
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + np.repeat(at[few], size[few])
        read = np.unique(owner * self.letters + bwt[place])
        tried = np.flatnonzero(size > WIDE)
        pairs = np.r_[read, (tried[:, None] * self.letters + np.arange(1, self.letters)).ravel()]
        pairs = pairs[pairs % self.letters > 0]
        return pairs // self.letters, pairs % self.letters

    def near(self, query: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word), by their numbers, one edit apart; the edit lies in the second half (``right``) or in the first."""
        pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for first in range(0, len(query), STATES // 16):
            pairs += self._search(query[first:first + STATES // 16], right)
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])

    def _search(self, query: np.ndarray, right: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        half, length = self.length[query] // 2, self.length[query]
        low, mirror, size = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64), np.full(len(query), len(self.text), np.int64)
        # the exact half, from the middle outwards, and the delimiter behind it
        exact = half if right else length - half
        for k in range(int(exact.max(initial=0)) + 1):
            on = np.flatnonzero(k <= exact)
            place = self.start[query[on]] + (half[on] - 1 - k if right else half[on] + k)
            low[on], mirror[on], size[on] = self.extend(not right, self.text[place].astype(np.int64), low[on], mirror[on], size[on])
        # the other half, from the middle outwards, with one edit; ``done`` counts its letters passed
        whole_part, found = length - exact, []
        letter_at = lambda q, done: self.text[self.start[query[q]] + (half[q] + done if right else half[q] - 1 - done)].astype(np.int64)
        stack = [(np.arange(len(query)), np.zeros(len(query), np.int64), np.zeros(len(query), bool), low, mirror, size)]
        while stack:
            q, done, edited, low, mirror, size = stack.pop()
            if len(q) > STATES:
                stack += [tuple(x[:len(q) // 2] for x in (q, done, edited, low, mirror, size)), tuple(x[len(q) // 2:] for x in (q, done, edited, low, mirror, size))]
                continue
            alive = size > 0
            if not alive.any():
                continue
            q, done, edited, low, mirror, size = (x[alive] for x in (q, done, edited, low, mirror, size))
            grown = []
            # the edit is made: the next letter, or the delimiter (which stands where the letters end)
            late = np.flatnonzero(edited)
            if len(late):
                at_end = done[late] == whole_part[q[late]]
                longer = self.extend(right, letter_at(q[late], done[late]), low[late], mirror[late], size[late])
                hit = at_end & (longer[2] > 0)
                if hit.any():
                    word = np.searchsorted(self.start, self.order[longer[0][hit]] + 1)
                    found.append((query[q[late][hit]], word))
                on = ~at_end
                grown.append((q[late][on], done[late][on] + 1, edited[late][on], *(x[on] for x in longer)))
            early = np.flatnonzero(~edited)
            if len(early):
                inner = early[done[early] < whole_part[q[early]]]
                grown.append((q[inner], done[inner] + 1, np.ones(len(inner), bool), low[inner], mirror[inner], size[inner]))      # a letter left out
                number, letter = self.letters_of(right, low[early], mirror[early], size[early])
                of = early[number]
                longer = self.extend(right, letter, low[of], mirror[of], size[of])
                grown.append((q[of], done[of], np.ones(len(of), bool), *longer))                                                 # a letter put in
                on = np.flatnonzero(done[of] < whole_part[q[of]])
                same = letter[on] == letter_at(q[of[on]], done[of[on]])
                grown.append((q[of[on]], done[of[on]] + 1, ~same, *(x[on] for x in longer)))                                      # replaced, or the same
            stack.append(tuple(np.concatenate(x) for x in zip(*grown)))
        return found


# ------------------------------------------------------------------ shards
def halves(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Rows (side, half, word, n, asks): every word under each half by which a word one edit apart may know it.

    ``asks`` marks the halves of the word itself; the others are those of words a letter shorter or longer.
    """
    size = F.length("word")
    of_length = words.select("word", "n", F.explode(F.array(size - 1, size, size + 1)).alias("l")).where(F.col("l") >= min_length)
    half = F.floor(F.col("l") / 2).cast("int")
    both = F.array(F.struct(F.lit(True).alias("right"), F.substring("word", F.lit(1), half).alias("half")),
                   F.struct(F.lit(False).alias("right"), F.right("word", F.col("l") - half).alias("half")))
    return of_length.select("word", "n", "l", (F.col("l") == size).alias("asks"), F.inline(both))


def links(words: DataFrame, min_length: int = MIN_LENGTH, symbols: int = SYMBOLS, block: int = BLOCK) -> DataFrame:
    """Pairs of words one edit apart, in both directions: ``word``, ``near``, ``near_n``; a pair may come twice."""
    key = ["right", "l", "half"]
    sent = halves(words, min_length)
    hot = (sent.groupBy(*key).agg(F.count("*").alias("t"), F.count_if("asks").alias("q")).where(F.col("t") > block)
           .select(*key, F.ceil(F.col("t") / block).cast("int").alias("tb"), F.greatest(F.ceil(F.col("q") / block), F.lit(1)).cast("int").alias("qb")))
    dealt = sent.join(hot, key, "left").withColumns({"tb": F.coalesce("tb", F.lit(1)), "qb": F.coalesce("qb", F.lit(1))})
    mine = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # a word stands in its block of words beside every block of queries, and asks from its block of queries beside every block of words
    stands = dealt.select(*key, "word", "n", F.lit(False).alias("asks"), mine("tb").alias("i"), F.explode(every("qb")).alias("j"))
    asking = dealt.where("asks").select(*key, "word", "n", "asks", F.explode(every("tb")).alias("i"), mine("qb").alias("j"))
    total = words.agg(F.sum(6 * (F.length("word") + 1))).first()[0] or 0
    shards = max(1, -(-total // symbols))
    shard = F.pmod(F.xxhash64(*key, "i", "j"), F.lit(shards)).cast("int")
    rows = stands.unionByName(asking).select(shard.alias("shard"), "right", "word", "n", "asks")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        # queries are words of the index as well: a search reads their letters there
        number, names = pd.factorize(rows["word"], sort=True)
        names = names.to_numpy(object)
        held = np.zeros(len(names), bool)
        held[number[~rows["asks"].to_numpy()]] = True
        n = np.zeros(len(names), np.int64)
        n[number] = rows["n"].to_numpy()
        index, outs = Words(names.tolist()), []
        for right in (True, False):
            asks = np.unique(number[(rows["asks"] & (rows["right"] == right)).to_numpy()])
            word, near = index.near(asks, right)
            stands = held[near]
            outs.append(pd.DataFrame({"word": names[word[stands]], "near": names[near[stands]], "near_n": n[near[stands]]}))
        return pd.concat(outs).drop_duplicates()

    return rows.groupBy("shard").applyInPandas(search, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """The last of the forms of forms of every word in ``forms`` (word, form): ``word``, ``root``.

    Forms are more and more frequent, so there are no circles; every step doubles the distance.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = cut(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if after.where("moved").limit(1).count() == 0:
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = RATIO, drop: int | None = None) -> DataFrame:
    """Every word with ``n``, its near words (``n_near``), its ``form`` with ``form_n``, and ``root``, the last of the forms of forms."""
    words = cut(word_counts(docs, doc_id, text, min_length, min_count, drop))
    pairs = links(words, min_length).distinct()
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    stated = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    last = roots(stated.where(F.col("form").isNotNull()))
    return stated.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
