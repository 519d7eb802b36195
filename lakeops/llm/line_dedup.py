"""Line dedup: runs of lines that stand earlier in the corpus are deleted, in DataFrame functions only.

A document is the sequence of its lines that hold a word; each line has an id by its content. Prefix
doubling sorts the suffixes of all sequences by their first 1, 2, 4 ... lines: the pairs (name of the
suffix, name of the suffix 2**k lines on) are range-sorted over the cluster and their order names the
suffixes at depth 2**(k+1). A name that several suffixes share is an interval of the suffix array whose
longest common prefix reaches that depth; a name of its own ends the suffix's part in the doubling, so
the rounds shrink to what repeats. The names keep the order of the suffixes.

A run qualifies when it holds at least ``min_words`` words. Every longer run is a union of the shortest
qualifying runs that start at one of its lines and of those that end at one, so these two per line decide:
a run of w lines is named by the names at depth 2**k of its first and of its last 2**k lines, and all but
the first of the runs with that name (by id, then key of the text, then line) are later copies. Unions of
later copies are the maximal repeated runs, and go; blank lines inside them go too.

Because shortest qualifying runs have at most ``min_words`` lines, the doubling stops at that depth.

Defined cases: a null text has no lines and stays null; empty texts stay empty; a null id comes first; of
rows with the same id and text the first keeps its lines and the others are later copies of it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import columns_named, count_words, cut, row_key, whole

MIN_WORDS = 50


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per line with a word: id, k1, k2, seq (number among these), at (line number), h1, h2 (content), words."""
    k1, k2 = row_key(doc_id, text)
    numbered = F.transform(F.split(whole(text), "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    worded = F.filter(numbered, lambda s: s["line"].rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(F.col(doc_id).alias("id"), k1, k2, F.posexplode(worded).alias("seq", "s"))
    return split.select("id", "k1", "k2", "seq", F.col("s.at").alias("at"), F.xxhash64("s.line").alias("h1"),
                        F.xxhash64(F.lit("line"), F.col("s.line")).alias("h2"), count_words(F.col("s.line")).alias("words"))


def named(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Names for the pairs that occur more than once, ascending with them: (first, second, name)."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = pairs.groupBy(first, second).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return several.repartitionByRange(parts, first, second).sortWithinPartitions(first, second).withColumn(
        "name", F.monotonically_increasing_id())


def islands(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """Lines that occur more than once, with their place among neighbours: (id, k1, k2, at, seq, island, words, before, name).

    ``seq`` numbers a document's lines with words, ``before`` the words (at most min_words a line) ahead in the island.
    """
    lines = lines_of(docs, doc_id, text)
    names = named(lines, "h1", "h2")
    by_doc = Window.partitionBy("k1", "k2")
    repeated = lines.join(names, ["h1", "h2"]).select("id", "k1", "k2", "at", "seq", "words", "name")
    # equal rows send the same lines
    one = repeated.repartition(F.col("k1"), F.col("k2")).dropDuplicates(["k1", "k2", "seq"])
    island = F.col("seq") - F.row_number().over(by_doc.orderBy("seq"))
    inside = Window.partitionBy("k1", "k2", "island").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return one.withColumn("island", island).withColumn(
        "before", F.coalesce(F.sum(F.least("words", F.lit(min_words))).over(inside), F.lit(0)))


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs of at least ``min_words`` words that start, or end, at a line: (id, k1, k2, seq, w)."""
    part = Window.partitionBy("k1", "k2", "island")
    last = F.lead("seq").over(part.orderBy("seq")).isNull()
    # bounds between lines, one more than lines; capped words put the bound sought within min_words of the least one
    here = F.struct("seq", F.col("before"))
    end = F.struct((F.col("seq") + 1).alias("seq"), (F.col("before") + F.least("words", F.lit(min_words))).alias("before"))
    bounds = lines.withColumn("__last", last).select(
        "id", "k1", "k2", "island", F.explode(F.when(F.col("__last"), F.array(here, end)).otherwise(F.array(here))).alias("b")).select(
        "id", "k1", "k2", "island", F.col("b.seq").alias("seq"), F.col("b.before").alias("before"))
    along = part.orderBy("before")
    found = bounds.withColumns({
        "stop": F.min("seq").over(along.rangeBetween(min_words, 2 * min_words)),
        "start": F.max("seq").over(along.rangeBetween(-2 * min_words, -min_words))})
    run = F.explode(F.array_distinct(F.array_compact(F.array(
        F.when(F.col("stop").isNotNull(), F.struct(F.col("seq").alias("s"), F.col("stop").alias("e"))),
        F.when(F.col("start").isNotNull(), F.struct(F.col("start").alias("s"), F.col("seq").alias("e")))))))
    return (found.select("id", "k1", "k2", run.alias("r"))
            .select("id", "k1", "k2", F.col("r.s").alias("seq"), (F.col("r.e") - F.col("r.s")).alias("w")).distinct())


def later_copies(runs: DataFrame, names: DataFrame, depth: int) -> DataFrame:
    """Runs of depth to 2 * depth - 1 lines that stand earlier, too: (k1, k2, seq, w)."""
    near = runs.where((F.col("w") >= depth) & (F.col("w") < 2 * depth))
    head = names.select("k1", "k2", "seq", F.col("name").alias("head"))
    tail = names.select("k1", "k2", F.col("seq").alias("tail_seq"), F.col("name").alias("tail"))
    named_runs = (near.join(head, ["k1", "k2", "seq"]).withColumn("tail_seq", F.col("seq") + F.col("w") - depth)
                  .join(tail, ["k1", "k2", "tail_seq"]))
    place = F.struct(F.col("id"), F.col("k1"), F.col("k2"), F.col("seq"))
    firsts = named_runs.groupBy("head", "tail", "w").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    # the first is found before the join, so a run with many copies is no group in a task
    return named_runs.join(firsts, ["head", "tail", "w"]).where(place > F.col("first")).select("k1", "k2", "seq", "w")


def longer_names(pairs: DataFrame) -> DataFrame:
    """Names at twice the depth; a suffix whose name no other shares drops out."""
    names = named(pairs.select(F.col("name").alias("this"), "then"), "this", "then")
    return pairs.withColumnRenamed("name", "this").join(names, ["this", "then"]).select("k1", "k2", "seq", "name")


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Maximal runs of lines that go: (k1, k2, first, last), original line numbers, by row key."""
    lines = cut(islands(docs, doc_id, text, min_words))
    runs = cut(shortest_runs(lines, min_words))
    longest = runs.agg(F.max("w")).first()[0] or 0
    names, depth = lines.select("k1", "k2", "seq", "name"), 1
    copies = None
    while depth <= longest:
        found = later_copies(runs, names, depth)
        copies = found if copies is None else copies.unionByName(found)
        if 2 * depth <= longest:
            ahead = Window.partitionBy("k1", "k2").orderBy("seq").rangeBetween(depth, depth)
            pairs = names.withColumn("then", F.max("name").over(ahead)).where("then IS NOT NULL")
            names = cut(longer_names(pairs))
        depth *= 2
    if copies is None:
        copies = runs.select("k1", "k2", "seq", "w").where(F.lit(False))
    ends = copies.groupBy("k1", "k2", "seq").agg(F.max(F.col("seq") + F.col("w")).alias("stop"))
    ahead = Window.partitionBy("k1", "k2").orderBy("seq")
    reach = F.max("stop").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    apart = ends.withColumn("fresh", F.coalesce(F.col("seq") > reach, F.lit(True)).cast("int"))
    merged = (apart.withColumn("run", F.sum("fresh").over(ahead)).groupBy("k1", "k2", "run")
              .agg(F.min("seq").alias("seq"), F.max("stop").alias("stop")))
    place = lines.select("k1", "k2", "seq", "at")
    return (merged.join(place, ["k1", "k2", "seq"]).withColumnRenamed("at", "first").withColumn("end_seq", F.col("stop") - 1)
            .join(place.withColumnsRenamed({"seq": "end_seq", "at": "last"}), ["k1", "k2", "end_seq"]).select("k1", "k2", "first", "last"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with ``kept`` (the text that stays), n_lines, n_removed and n_runs."""
    runs = repeated_runs(docs, doc_id, text, min_words)
    spans = runs.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    k1, k2 = row_key(doc_id, text)
    keyed = docs.select(F.struct(*columns_named(docs.columns)).alias("row"), F.col(text).alias("text"), k1, k2)
    # of equal rows the first alone is not a copy of another
    copy = Window.partitionBy("k1", "k2").orderBy(F.lit(1))
    met = keyed.join(spans, ["k1", "k2"], "left").withColumn("copy", F.row_number().over(copy))
    met = met.withColumn("lines", F.split(whole(), "\n", -1))
    size = F.size("lines")
    all_lines = F.array(F.struct(F.lit(0).alias("first"), (size - 1).alias("last")))
    enough = (F.col("copy") > 1) & (count_words(whole()) >= min_words)
    met = met.withColumn("spans", F.when(enough, all_lines).otherwise(F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>"))))
    # what stays lies between the spans: each line is taken once
    stops = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get("spans", i - 1)["last"])
    between = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda i: F.slice(
        "lines", stops(i) + 2, F.coalesce(F.get("spans", i)["first"], size) - stops(i) - 1))
    met = met.withColumn("left", F.flatten(between))
    return met.select(
        "row", "k1", "k2",
        F.when(F.col("text").isNotNull(), F.array_join("left", "\n")).alias("kept"),
        size.cast("bigint").alias("n_lines"), (size - F.size("left")).cast("bigint").alias("n_removed"), F.size("spans").cast("bigint").alias("n_runs"))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: id, n_lines, n_removed, n_runs and SHA-256 of the text that stays."""
    return without_repeats(docs, doc_id, text, min_words).select(
        F.col("row")[doc_id].alias(doc_id), "n_lines", "n_removed", "n_runs",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
