"""Document fingerprints: Merkle trees over pieces, paragraphs and sections, in DataFrame functions only.

A text is cut into paragraphs (lines), a paragraph into pieces of 64 code points. A piece's hash is its
leaf; a paragraph is hashed from its pieces, a section from its paragraphs, the root from the sections
and the length. A section ends behind a paragraph whose hash ends in 0, so an edit moves the bounds
near it only. The fingerprint is the tree written down: root, sections, paragraphs per section, leaves.
Roots test equality; two trees are compared from the top, and only differing branches lead to edits.

Defined cases: a null text is the empty text, which has one paragraph with one empty piece; rows with
the same id and text follow one another, and the last of them is followed by the next id; a null id comes
after all others; the only row of a table follows itself.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import cut, row_key, whole

PIECE = 64
DIGITS = 12               # hex digits of a node below the root


def _node(content: Column) -> Column:
    return F.substring(F.md5(content), 1, DIGITS)


def _pieces(paragraph: Column) -> Column:
    return F.when(paragraph == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(paragraph, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: a struct of root, sections, paragraphs (hash, section number) and leaves (a list per paragraph)."""
    leaves = F.transform(F.split(F.col(text), "\n", -1), lambda p: F.transform(_pieces(p), _node))
    one = df.withColumn("__leaves", leaves).withColumn(
        "__paragraphs", F.transform("__leaves", lambda x: _node(F.concat_ws(",", x))))
    last = F.size("__paragraphs")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("__paragraphs", i).endswith("0") | (i == last))
    two = one.withColumn("__ends", ends)
    starts = lambda j: F.when(j == 0, F.lit(1)).otherwise(F.get("__ends", j - 1) + 1)
    sections = F.transform("__ends", lambda e, j: _node(F.concat_ws(",", F.slice("__paragraphs", starts(j), e - starts(j) + 1))))
    three = two.withColumn("__sections", sections)
    root = F.md5(F.concat_ws(",", F.length(text).cast("string"), F.concat_ws(",", "__sections")))
    return three.withColumn(name, F.struct(
        root.alias("root"), F.col("__sections").alias("sections"), F.col("__ends").alias("ends"),
        F.col("__paragraphs").alias("paragraphs"), F.col("__leaves").alias("leaves"))).drop(
        "__leaves", "__paragraphs", "__ends", "__sections")


def written(name: str) -> Column:
    """The tree as text: root:sections:paragraphs of each section:leaves of each paragraph."""
    t = F.col(name)
    return F.concat_ws(":", t["root"], F.concat_ws(",", t["sections"]), F.array_join(F.transform(t["ends"], lambda e: e.cast("string")), ","),
                       F.array_join(t["paragraphs"], ","), F.array_join(F.transform(t["leaves"], lambda x: F.array_join(x, "")), ","))


def leaves_of(fingerprint: Column) -> Column:
    """The distinct leaves of a written tree."""
    return F.array_distinct(F.regexp_extract_all(F.element_at(F.split(fingerprint, ":"), 5), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0)))


def likeness(left: Column, right: Column) -> Column:
    """Likeness of two written trees from 0 to 1: 1 where the roots agree, else twice the shared leaves over all leaves."""
    a, b = leaves_of(left), leaves_of(right)
    dice = 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))
    return F.when(F.substring_index(left, ":", 1) == F.substring_index(right, ":", 1), F.lit(1.0)).otherwise(dice)


def edits(left: str, right: str) -> tuple[Column, Column]:
    """Numbers (from 1) of the sections, and of the paragraphs in them, of tree ``left`` that tree ``right`` does not have."""
    l, r = F.col(left), F.col(right)
    sections = F.filter(F.sequence(F.lit(1), F.size(l["sections"])), lambda i: ~F.array_contains(r["sections"], F.element_at(l["sections"], i)))
    below = lambda i: F.sequence(F.when(i == 1, F.lit(1)).otherwise(F.get(l["ends"], i - 2) + 1), F.element_at(l["ends"], i))
    paragraphs = F.filter(F.flatten(F.transform(sections, below)), lambda p: ~F.array_contains(r["paragraphs"], F.element_at(l["paragraphs"], p)))
    return (F.when(l["root"] == r["root"], F.array().cast("array<int>")).otherwise(sections),
            F.when(l["root"] == r["root"], F.array().cast("array<int>")).otherwise(paragraphs))


def followed(rows: DataFrame, order: Sequence[Column], key: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """``key`` of every distinct row beside ``next_`` + key and ``next_`` + carry of the next in order, the first after the last.

    The rows are range-partitioned along the order; each part looks ahead by itself, and what follows the
    last row of a part is the first row of the next part that has one: a table with a row per part.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [*key, *carry]
    # the part numbers are written down, so that a lost executor cannot deal the rows out anew
    dealt = cut(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    along = Window.partitionBy("__part").orderBy(*order)
    ahead = dealt.withColumns({"__next": F.lead(F.struct(*cols)).over(along), "__no": F.row_number().over(along)})
    firsts = ahead.where("__no = 1").select(F.col("__part").alias("__at"), F.struct(*cols).alias("__first"))
    by_part = Window.orderBy("__at")
    turn = F.first("__first").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = firsts.select("__at", F.coalesce(F.lead("__first").over(by_part), turn).alias("__after"))
    joined = ahead.join(F.broadcast(after), F.col("__part") == F.col("__at"))      # a row per part
    nxt = F.coalesce("__next", "__after")
    return joined.select(*cols, *[nxt[c].alias(f"next_{c}") for c in cols])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, and of the text whose last third comes from the next document (descending id).

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    next_doc_id, edited_sections and edited_paragraphs (numbers, from 1, in the edited text). A next
    document sends only the start that is used of it, with its fingerprint. Whole texts are shuffled once:
    both joins read the same columns by the same key, so Spark reuses the exchange.
    """
    k1, k2 = row_key(doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), k1, k2, whole(text).alias("text"))
    keys = rows.select("doc_id", "k1", "k2", F.length("text").alias("n_chars")).groupBy("k1", "k2", "doc_id").agg(F.first("n_chars").alias("n_chars"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    ahead = cut(followed(keys, order, ["k1", "k2"], ["doc_id", "n_chars"]))
    # what each document sends to the one before it
    wanted = ahead.select(F.col("next_k1").alias("k1"), F.col("next_k2").alias("k2"), F.col("k1").alias("to1"), F.col("k2").alias("to2"),
                          F.floor(F.col("n_chars") / 3).cast("int").alias("want"))
    sent = with_tree(rows.join(wanted, ["k1", "k2"]).select("doc_id", "to1", "to2", "text", "want"), "text", "tree").select(
        F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.expr("substring(text, 1, want)").alias("start"),
        written("tree").alias("next_fingerprint"), F.col("doc_id").alias("next_doc_id"))
    sent = sent.groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ("start", "next_fingerprint", "next_doc_id")])
    met = rows.join(sent, ["k1", "k2"])
    # all but the last of equal rows are followed by their like
    copy = Window.partitionBy("k1", "k2").orderBy("doc_id")
    met = met.withColumn("last", F.lead(F.lit(1)).over(copy).isNull())
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    start = F.when(F.col("last"), F.col("start")).otherwise(F.substring(F.col("text"), F.lit(1), third))
    both = met.withColumn("n_chars", n.cast("bigint")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), start))
    both = with_tree(with_tree(both, "text", "tree"), "edited", "edited_tree")
    sections, paragraphs = edits("edited_tree", "tree")
    out = both.select(
        F.col("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written("tree").alias("fingerprint"),
        written("edited_tree").alias("edited_fingerprint"), sections.alias("edited_sections"), paragraphs.alias("edited_paragraphs"),
        F.col("last"), "next_fingerprint", F.when(F.col("last"), F.col("next_doc_id")).otherwise(F.col("doc_id")).alias("next_doc_id"))
    return (out.withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
            .withColumn("near_next", F.when(F.col("last"), likeness(F.col("fingerprint"), F.col("next_fingerprint"))).otherwise(F.lit(1.0)))
            .drop("last", "next_fingerprint").withColumnRenamed("doc_id", doc_id))
