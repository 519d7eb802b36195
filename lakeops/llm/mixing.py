"""Mix sources to target weights.

Every document gets a hash-random key. Within its source the keys put the documents in order; prefix
sums of their sizes along that order decide which of them the budget of the source still reaches, after
as many whole epochs as fit. The order is cut into 65,536 ranges of the key: totals per (source, range)
give the offset of each range, a running sum inside one range the rest, so a source with a third of all
documents is spread over all tasks.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null source is a source of its
own, last in order; repeated rows are separate documents whose order among themselves does not matter;
sources without any word have target 0; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import columns_named, count_words, whole, without

RANGE_DIGITS = 4          # hex digits of the key that name its range
OUT = ("size", "source_size", "target", "taken", "copies")


def targets(totals: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target per source from a table (source_key, source, source_size) of one row per source.

    Sources by code point, null last, weigh ``weights``, repeating, and share ``share`` times all sizes.
    A target stops at ``most`` times its source's size; the excess is shared again by weight until none
    is above. That ends at min(limit, level * weight) with one level for all, so the limits are met in
    the order of limit / weight, and the level is what is left over the weights that are left. One row
    per source goes through one task here.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    weighed = totals.withColumn("weight", pick).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    ranked = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, onward = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    levelled = weighed.withColumn("level", level).withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    # the level of the first source that stays below its limit holds for all that follow
    final = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(everything)
    return levelled.withColumn("target", F.when(F.col("full") | final.isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), final["level"] * F.col("weight")))).select("source_key", "source_size", "target")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "",
        doc_id: str = "doc_id", text: str | None = "text", source: str = "source", size: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target, taken and copies.

    ``taken`` is the number of words the mix takes of the document, epochs counted; at the cut it ends
    inside a document, so a source's taken words are its target rounded down. ``copies`` is the
    number of times a mix of whole documents holds it: the document at the cut goes whole.
    """
    size = count_words(whole(text)) if size is None else size
    plain = docs.select(*columns_named(without(docs, OUT)), size.alias("size"))
    keyed = plain.withColumns({
        "__source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
        "__key": F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))),
    }).withColumn("__range", F.substring("__key", 1, RANGE_DIGITS))
    parts = keyed.groupBy("__source", "__range").agg(F.sum("size").alias("n"))
    totals = parts.groupBy(F.col("__source").alias("source_key")).agg(F.sum("n").alias("source_size")).withColumn(
        "source", F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)")))
    offset = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("__offset", F.coalesce(F.sum("n").over(offset), F.lit(0))).drop("n").join(
        targets(totals, weights, share, most), F.col("__source") == F.col("source_key")).drop("source_key")
    inside = Window.partitionBy("__source", "__range").orderBy("__key", doc_id, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["__source", "__range"])
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0).cast("bigint")
    rest = budget - F.col("__epochs") * F.col("source_size") - F.col("__offset") - F.col("__inside")
    return (placed.withColumn("__epochs", epochs).withColumn("__rest", rest)
            .withColumn("taken", F.col("__epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("__rest"), F.col("size"))))
            .withColumn("copies", F.when(F.col("size") == 0, F.lit(0)).otherwise(
                F.col("__epochs") + F.when(F.col("__rest") > 0, 1).otherwise(0)).cast("int"))
            .select(*columns_named(without(docs, OUT)), *OUT))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as the mix holds it, with the columns of ``docs``."""
    held = docs.select(F.struct(*columns_named(docs.columns)).alias("__row"), F.col(how.pop("doc_id", "doc_id")).alias("doc_id"),
                       F.col(how.pop("source", "source")).alias("source"), count_words(whole(how.pop("text", "text"))).alias("__size"))
    mixed = mix(held, text=None, size=F.col("__size"), **how).where("copies > 0")
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
