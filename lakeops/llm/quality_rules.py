"""Quality rules whose cutoffs come with a bound on the clean documents they reject.

Every rule compares one statistic of a text with a cutoff. The labelled documents that pass the base
rule are split by a hash of their id. A quarter only chooses rules: those that catch a share ``gain``
of its bad documents at a cutoff that rejects hardly any of its good ones. The good documents of the
other three quarters only test them. Per stratum (a language by default) and chosen rule, cutoffs are tested from the
loosest to the tightest on its documents of good quality: with n of them, x beyond the cutoff, the
cutoff is safe if a false rejection rate of ``alpha`` / rules would give x or fewer with a probability
of at most ``delta`` / (rules * strata). That is the exact (Clopper-Pearson) binomial bound. Testing
stops at the first cutoff that is not safe, which needs no further correction along the cutoffs (fixed
sequence); rules and strata are corrected by Bonferroni. So with probability 1 - ``delta`` every
stratum loses at most ``alpha`` of its clean documents to the rules together. Among the safe cutoffs
the one is taken whose rejected bad documents exceed the good ones most, the loosest of equals; a rule
none of whose cutoffs rejects more bad than good documents gets none.

Strata with too few good labels for any cutoff of their own are tested together as one stratum, the
rest, to which strata without a label belong as well. Its bound holds for the rest as a whole and not
for each stratum in it. Where even the rest has too few labels, its documents stay.

Defined cases: a null or empty text has no words and fails the base rule; a null stratum is a stratum
of its own; labels with a null id or quality are not used; of repeated labels for one id the lowest
quality counts; without labels, good and bad ones, only the base rule rejects.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import columns_named, cut, map_rows, texts_of, without

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_bangs")
FIELDS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

#: statistic of a rule, as counts over counts
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "bangs": ("n_bangs", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
#: cutoffs from loose to tight
CUTOFFS = (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02, 0.01)

#: one in so many labelled documents chooses rules, the others test them
CHOOSING = 4
#: stands for the strata that have no cutoffs of their own
REST = ("rest",)


@dataclass(frozen=True)
class Risk:
    """``alpha``: share of a stratum's clean documents that may be rejected; ``delta``: probability that it is more;
    ``gain``: share of the bad documents that a rule must catch to be tested."""

    alpha: float = 0.05
    delta: float = 0.05
    gain: float = 0.05
    cutoffs: Sequence[float] = CUTOFFS


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()                       # splits at exactly the six white-space bytes
    spaces = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line and line.strip(" \t\x0b\x0c\r"):
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeated = 0
    triples = list(zip(words, words[1:], words[2:]))
    if len(set(triples)) < len(triples):
        times, upto = Counter(triples), 0
        for i, t in enumerate(triples):
            if times[t] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return (len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), dup, repeated, lines,
            len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")), text.count("!"))


def _work(column: pa.Array) -> dict[str, list[int]]:
    rows = [text_counts(t) for t in texts_of(column)]
    return dict(zip(COUNTS, map(list, zip(*rows))))


def with_counts(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the counts of every whole text."""
    return map_rows(docs, without(docs, COUNTS) if keep is None else keep, FIELDS, [text], _work)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistic(rule: str) -> Column:
    over, under = RULES[rule]
    return F.col(over) / F.greatest(F.col(under), F.lit(1))


def at_most(x: int, n: int, p: float) -> float:
    """P(X <= x) for X binomial with n draws of probability p."""
    if x >= n:
        return 1.0
    log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    top = max(log(k) for k in (x, 0, min(x, int(n * p))))
    return min(1.0, math.exp(top) * math.fsum(math.exp(log(k) - top) for k in range(x + 1)))


def choose_rules(good: dict[str, list[int]], bad: dict[str, list[int]], risk: Risk) -> list[str]:
    """Rules worth a test: ``good`` and ``bad`` hold per rule n and the numbers beyond each cutoff."""
    few = risk.alpha / len(RULES)
    return [r for r in RULES if r in good and r in bad
            and any(x <= few * good[r][0] and caught >= max(1, risk.gain * bad[r][0]) for x, caught in zip(good[r][1:], bad[r][1:]))]


def levels(rules: int, strata: int, risk: Risk) -> tuple[float, float]:
    """Rate and error probability of one test."""
    return risk.alpha / rules, risk.delta / (rules * max(1, strata))


def select_cutoff(good: list[int], bad: list[int], level: tuple[float, float], cutoffs: Sequence[float]) -> float | None:
    """The safe cutoff with most bad documents rejected, less the good ones, None without one; both lists hold n and the numbers beyond each cutoff."""
    rate, error = level
    best, chosen = 0, None
    for cutoff, x, caught in zip(cutoffs, good[1:], bad[1:]):
        # past the expected number the exact test cannot pass, whatever n is
        if x > good[0] * rate or at_most(x, good[0], rate) > error:
            break
        if caught - x > best:
            best, chosen = caught - x, cutoff
    return chosen


def calibrate(counted: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", quality: str = "quality",
              risk: Risk = Risk()) -> dict:
    """Cutoffs by rule per stratum, and of the rest under ``REST``, from the labelled documents that pass the base rule.

    What reaches the driver is the sums of the choosing part and two rows per stratum with enough labels
    for a cutoff, so at most twice labels / that number.
    """
    marks = (labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
             .groupBy(F.col(doc_id).alias("__id")).agg(F.min(quality).alias("__quality")))
    joined = (counted.where(~base_failed()).select(F.col(doc_id).alias("__id"), F.col(stratum).cast("string").alias("__stratum"), *COUNTS)
              .join(marks, "__id"))
    numbers = ["n", *[f"{r}_{j}" for r in RULES for j in range(len(risk.cutoffs))]]
    sums = [F.count("*").alias("n")]
    sums += [F.count_if(statistic(r) > c).alias(f"{r}_{j}") for r in RULES for j, c in enumerate(risk.cutoffs)]
    tests = F.crc32(F.col("__id").cast("string").cast("binary")) % CHOOSING != 0
    table = cut(joined.groupBy("__stratum", (F.col("__quality") >= 1).alias("__good"), tests.alias("__tests")).agg(*sums))
    total = lambda df, *by: df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in numbers])
    beyond = lambda row, r: [row["n"], *[row[f"{r}_{j}"] for j in range(len(risk.cutoffs))]]

    part = {row["__good"]: {r: beyond(row, r) for r in RULES} for row in total(table.where(~F.col("__tests")), "__good").collect()}
    rules = choose_rules(part.get(True, {}), part.get(False, {}), risk)
    if not rules:
        return {}
    level = levels(len(rules), table.select("__stratum").distinct().count(), risk)
    enough = math.ceil(math.log(level[1]) / math.log1p(-level[0]))
    own = (table.where(F.col("__good") & F.col("__tests") & (F.col("n") >= enough))
           .select(F.col("__stratum").alias("__s"), F.lit(True).alias("__own")))
    told = table.where(F.col("__tests") | ~F.col("__good")).join(own, F.col("__stratum").eqNullSafe(F.col("__s")), "left")
    good, bad = {}, {}
    for row in total(told, "__own", "__s", "__good").collect():
        (good if row["__good"] else bad)[row["__s"] if row["__own"] else REST] = row
    none = [0] * (len(risk.cutoffs) + 1)
    found = {s: {r: select_cutoff(beyond(row, r), beyond(bad[s], r) if s in bad else none, level, risk.cutoffs) for r in rules}
             for s, row in good.items()}
    return {s: {r: c for r, c in by.items() if c is not None} for s, by in found.items()}


def verdict(counted: DataFrame, cutoffs: dict, stratum: str = "lang") -> DataFrame:
    """Add ``base_failed`` and ``kept``; the strata with cutoffs of their own are joined and number at most labels / enough of them."""
    spark = counted.sparkSession
    schema = "__s string, __own boolean, " + ", ".join(f"__{r} double" for r in RULES)
    table = spark.createDataFrame([(s, True, *[by.get(r) for r in RULES]) for s, by in cutoffs.items() if s is not REST], schema)
    joined = counted.select(*columns_named(without(counted, ["base_failed", "kept"]))).join(
        F.broadcast(table), F.col(stratum).cast("string").eqNullSafe(F.col("__s")), "left")
    beyond = F.lit(False)
    for r in RULES:
        rest = F.lit(cutoffs.get(REST, {}).get(r)).cast("double")
        limit = F.when(F.col("__own"), F.col(f"__{r}")).otherwise(rest)
        beyond = beyond | F.coalesce(statistic(r) > limit, F.lit(False))
    return (joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~beyond)
            .drop("__s", "__own", *[f"__{r}" for r in RULES]))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id",
          risk: Risk = Risk()) -> DataFrame:
    """Id, stratum, counts, ``base_failed`` and ``kept`` of every document; the texts are read once."""
    counted = cut(with_counts(docs, text, [doc_id, stratum]))
    return verdict(counted, calibrate(counted, labels, stratum, doc_id, risk=risk), stratum)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id",
              risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns; no shuffle of texts."""
    cutoffs = calibrate(cut(with_counts(docs, text, [doc_id, stratum])), labels, stratum, doc_id, risk=risk)
    held = docs.select(F.struct(*columns_named(docs.columns)).alias("__row"), F.col(text).alias("__text"), F.col(stratum).alias("__lang"))
    return verdict(with_counts(held, "__text", ["__row", "__lang"]), cutoffs, "__lang").where("kept").select("__row.*")
