"""BPE encoding and decoding with word ends, as the public tokenizer file defines it.

A text is cut at the special strings; each rest is normalised (NFC, white space to one space, lower
case), cut into words by the file's pattern, and every word is merged on its own. A short word is one
contiguous array of part boundaries and of the ranks of adjacent parts: scan for the lowest rank, delete
the boundary, refresh the two neighbouring ranks, until no pair has a rank. A long word does the same
through a heap, so that its cost stays near-linear. Encoded words are kept per worker in a bounded
cache, which changes nothing but the speed.

The decoded text is made from the ids alone.

Defined cases: a null text is the empty text, which has no tokens and decodes to the empty text; repeated rows are coded each;
a text of any length is coded whole, long words through the heap; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.common import Shipped, map_rows, texts_of, without

SHORT = 64                 # parts up to which a word is scanned; beyond, a heap
NONE = 1 << 60             # rank of a pair that does not merge
CACHE_WORDS = 200_000      # words kept per worker
CACHED_CHARS = 100         # longest word that is kept
#: the pattern of the words on ASCII text, and texts of Latin, Greek and Cyrillic letters and their signs, on which Unicode versions agree
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII).findall
COMMON = re.compile(r"[\x00-\u052f\u2010-\u2027\u2030-\u205e]*\Z").match

ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])
OUTPUT = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                       T.StructField("decoded", T.StringType())])
SEALED = T.StructType([OUTPUT["n_tokens"], OUTPUT["ids"], ENCODED["ids_sha256"], ENCODED["decoded_sha256"]])


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return [chr(c) for _, c in sorted([(b, b) for b in plain] + [(b, 256 + n) for n, b in enumerate(rest)])]


def read_vocabulary(path: str) -> dict:
    """What encoding needs of a tokenizer file; read by the driver and shipped (its size is that of the vocabulary)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"]:
        raise ValueError(f"{path} is not a byte-level BPE file with words in lower case")
    return {"vocab": model["vocab"], "merges": [tuple(m) for m in model["merges"]], "end": model["end_of_word_suffix"] or "",
            "pattern": pre[0]["pattern"]["Regex"], "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class Encoder:
    """Encodes and decodes texts; built once per worker from the shipped vocabulary."""

    def __init__(self, spec: dict):
        vocab, self.end = spec["vocab"], spec["end"]
        self.letters = byte_letters()
        # a pair of ids is one number; its value is its rank, which also names the id of the merged part
        self.pairs = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(spec["merges"])}
        self.made = [vocab[a + b] for a, b in spec["merges"]]
        self.inner = [vocab[c] for c in self.letters]
        self.last = [vocab[c + self.end] for c in self.letters]
        self.special = spec["special"]
        self.tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        # no special string can match where what they all begin with does not stand
        self.begins = os.path.commonprefix(list(self.special)) if self.special else None
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.words = regex.compile(spec["pattern"]).findall
        self.pattern = spec["pattern"]
        self.library = None
        self.cache: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8")
        inner = self.inner
        parts = [inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank, made = self.pairs.get, self.made
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)                      # the leftmost of equal ranks
            part = parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(part << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | part, NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        rank, n = self.pairs.get, len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a << 32 | b, NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            low, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j >= n or parts[i] != a or parts[j] != b:
                continue                              # one of its parts has been merged meanwhile
            parts[i], parts[j] = self.made[low], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] < n:
                    a, b = parts[k], parts[right[k]]
                    if (r := rank(a << 32 | b, NONE)) != NONE:
                        heapq.heappush(heap, (r, k, a, b))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of one word that the cache lacks."""
        found = array("I", self.merge(word)).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def cut_words(self, text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        if text.isascii():
            return ASCII_WORDS(text.lower())
        if COMMON(text):
            # lower case letter by letter: a capital sigma has one form wherever it stands
            return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        # which of the rarer characters are letters depends on the Unicode version, so the library says
        if self.library is None:
            from tokenizers import Regex, normalizers, pre_tokenizers

            self.library = (normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]),
                            pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True))
        normal, split = self.library
        return [w for w, _ in split.pre_tokenize_str(normal.normalize_str(text))]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the text they decode to."""
        ids = self.ids(text)
        return ids, self.decode(ids)

    def ids(self, text: str) -> bytes:
        get, word, found = self.cache.get, self.word, []
        special = self.begins is not None and self.begins in text
        for n, part in enumerate(self.cut.split(text)) if special else ((0, text),):
            if n % 2:
                found.append(array("I", [self.special[part]]).tobytes())
            elif part:
                found += [get(w) or word(w) for w in self.cut_words(part)]
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """Tokens of the ids, joined by spaces; ids without a token are passed over."""
        numbers = array("I", ids)
        try:
            return " ".join(map(self.tokens.__getitem__, numbers))
        except KeyError:
            return " ".join([self.tokens[i] for i in numbers if i in self.tokens])


def _coded(docs: DataFrame, path: str, text: str, keep: Sequence[str] | None, fields: T.StructType) -> DataFrame:
    spec = Shipped(docs.sparkSession, read_vocabulary(path))
    make = {"n_tokens": lambda ids, decoded: len(ids) // 4, "ids": lambda ids, decoded: ids, "decoded": lambda ids, decoded: decoded,
            "ids_sha256": lambda ids, decoded: hashlib.sha256(ids).hexdigest(),
            "decoded_sha256": lambda ids, decoded: hashlib.sha256(decoded.encode("utf-8")).hexdigest()}
    wanted = [make[f.name] for f in fields]

    def work(column: pa.Array) -> dict[str, list]:
        encoder = spec.state("encoder", lambda: Encoder(spec.value))
        rows = []
        for t in texts_of(column):
            ids, decoded = encoder.encode(t)
            rows.append([f(ids, decoded) for f in wanted])
        return dict(zip([f.name for f in fields], map(list, zip(*rows))))

    return map_rows(docs, without(docs, fields.names) if keep is None else keep, fields, [text], work)


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all), n_tokens, ids (little-endian 32-bit integers) and the decoded text."""
    return _coded(docs, path, text, keep, OUTPUT)


def digest(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """As ``encode``, but with SHA-256 of the ids and of the decoded text."""
    return _coded(docs, path, text, keep, ENCODED)


def sealed(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """As ``encode``, with the ids and both digests; the decoded text does not leave its worker."""
    return _coded(docs, path, text, keep, SEALED)
