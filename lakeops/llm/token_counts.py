"""Unigram token counts by dynamic programming over a trie of the distinct words.

A piece has a score; a word is segmented so that the sum of the scores is highest, fewer pieces first
among equals. The best score of a prefix depends on that prefix alone, so the distinct words of a batch
are put into a trie and every node holds the best score and its number of tokens, computed once for all
words that share the prefix. The node at which a word ends holds the word's count; a document's count is
the sum over its words. Scores are whole numbers, so sums do not depend on their order.

The words stay in their task: a trie of all words would have to be shuffled back to every place a word
stands in, which is larger than the texts. The trie of a worker process serves its tasks in turn and
starts anew when it reaches ``TRIE_NODES``, which changes nothing but the speed.

Defined cases: a null or empty text has 0 words and 0 tokens. A character that no piece covers costs
its UTF-8 bytes as tokens, at a score below that of any piece.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.common import Shipped, map_rows, without, words_of

MARK = "▁"            # stands before a word
TRIE_NODES = 1_000_000    # nodes at which the trie of a worker starts anew
CACHE_WORDS = 500_000     # counted words that a worker keeps
CACHED_CHARS = 100
TOKEN_BITS = 40
FIELDS = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens")])


def zipf_scores(pieces: Sequence[str]) -> dict[str, int]:
    """Scores in millionths for pieces in order of frequency: the logarithm of a frequency of 1 / (rank + 2)."""
    return {p: -round(1e6 * math.log(rank + 2)) for rank, p in enumerate(pieces)}


def read_pieces(path: str) -> dict[str, int]:
    """Scores of the ordinary pieces of a sentencepiece model, which lists them by frequency."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return zipf_scores([model.id_to_piece(i) for i in range(model.get_piece_size())
                        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))])


class Trie:
    """Forward scores of all prefixes of the words inserted so far.

    A node is a number; ``best`` holds its score and, in the low bits, its tokens as a deduction, so that one
    comparison prefers the higher score and then fewer tokens.
    """

    def __init__(self, scores: dict[str, int], most: int = TRIE_NODES, words: int = CACHE_WORDS):
        self.most, self.words = most, words
        # what a piece can end with, and what it adds if it is a piece itself
        self.tails: dict[str, int | None] = {p[i:]: None for p in scores for i in range(len(p))}
        self.tails.update({p: (score << TOKEN_BITS) - 1 for p, score in scores.items()})
        self.unknown = (min(scores.values(), default=0) - 10_000_000) << TOKEN_BITS
        self.ends: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}           # (node, letter) as one number
        self.best: list[int] = [0]

    def count(self, word: str) -> int:
        """Tokens of a word that ``ends`` lacks; new nodes only where its prefix is new."""
        if len(self.best) > self.most:
            self.clear()
        marked, node, path = MARK + word, 0, [0]
        child, best, tails = self.child, self.best, self.tails.get
        for end, letter in enumerate(marked, 1):
            way = node << 21 | ord(letter)
            step = child.get(way)
            if step is None:
                top = best[node] + self.unknown - len(letter.encode("utf-8"))
                for start in range(end - 1, -1, -1):
                    own = tails(marked[start:end], 0)
                    if own is not None:
                        if own == 0:
                            break
                        reach = best[path[start]] + own
                        if reach > top:
                            top = reach
                step = child[way] = len(best)
                best.append(top)
            node = step
            path.append(node)
        tokens = -best[node] & (1 << TOKEN_BITS) - 1
        if len(word) <= CACHED_CHARS:
            if len(self.ends) >= self.words:
                self.ends.clear()
            self.ends[word] = tokens
        return tokens


def token_counts(docs: DataFrame, scores: dict[str, int], text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all), n_words and n_tokens of every whole text."""
    shipped = Shipped(docs.sparkSession, scores)

    def work(column: pa.Array) -> dict[str, np.ndarray]:
        trie = shipped.state("trie", lambda: Trie(shipped.value))
        flat, text = words_of(column)
        coded = flat.dictionary_encode()                       # the distinct words of the batch
        get, count = trie.ends.get, trie.count
        each = np.array([get(w) or count(w) for w in coded.dictionary.to_pylist()], np.int64)
        n = len(column)
        tokens = np.bincount(text, each[coded.indices.to_numpy()] if len(flat) else None, minlength=n)
        return {"n_words": np.bincount(text, minlength=n), "n_tokens": tokens.astype(np.int64)}

    return map_rows(docs, without(docs, FIELDS.names) if keep is None else keep, FIELDS, [text], work)
