"""Chat formatting from reply trees.

Messages of a conversation form trees by their parent. Iterative self-joins double the distance to the
ancestor a message knows, so a tree of depth d takes log2(d) joins and no message carries its path. They
give every message its depth, its root and the score of its branch; the leaves of a tree are ranked by
that score, and the chosen leaves walk up again through the same jumps, which lists every message of
their path once. Each path becomes one formatted conversation.

Template: every turn stands between an opening and a closing mark of its role. In texts and role names
``\\``, ``<`` and ``[`` are escaped (``\\\\``, ``\\l``, ``\\b``), in role names ``>`` as well (``\\g``), so no mark and no control
string can be formed by a text or a role, and both come back exactly.

Defined cases: a null text or role is empty; a message whose parent is missing or null is a root; turns
with the same number are ordered by role and text, nulls first; rows with a null conversation form one
conversation; repeated rows are separate turns. A cycle of parents raises.
"""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import cut, map_rows

#: opening and closing marks of the known roles; any other role is named in its marks
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "b": "[", "g": ">"}.get(m[1], m[1]), text, flags=re.S)


def marked(role: Column, text: Column) -> Column:
    """One turn in the template."""
    named = F.replace(escaped(role), F.lit(">"), F.lit("\\g"))
    out = F.concat(F.lit("<<ROLE "), named, F.lit(">>"), escaped(text), F.lit("<</ROLE>>"))
    for name, (start, end) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(start), escaped(text), F.lit(end))).otherwise(out)
    return out


#: a turn: its opening mark, the text, the closing mark of the same role; escaped texts hold neither < nor [, escaped roles no > either
_TURN = re.compile(r"\[INST\] ([^<\[]*) \[/INST\]|<s>([^<\[]*)</s>|<<SYS>>([^<\[]*)<</SYS>>|<<ROLE ([^<\[>]*)>>([^<\[]*)<</ROLE>>", re.S)
_ROLES = {1: "user", 2: "assistant", 3: "system"}


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text and span of the escaped text of every turn."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        at, k = m.end(), m.lastindex
        out.append((_ROLES.get(k) or unescape(m[4]), unescape(m[k]), m.start(k), m.end(k)))
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return out


# ------------------------------------------------------------------ trees
def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages (conv, node, parent, score, role, text) of conversations that are plain sequences of turns."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text")))
    plain = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), r, t)
    node = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("bigint")
    return plain.withColumn("node", node).select(
        "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Messages of the ``branches`` best root-to-leaf paths per tree: (conv, leaf, rank, place, node).

    A branch's score is the sum of the scores on its path; ties go to the smaller leaf. ``place`` counts
    from the root, 0 first.
    """
    # null conversations are one conversation, so the key is made non-null
    links = messages.select(F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("c"), "node", "parent",
                            F.coalesce("score", F.lit(0.0)).alias("score"))
    known = links.select("c", F.col("node").alias("parent"))
    whole = links.join(known.withColumn("there", F.lit(True)), ["c", "parent"], "left")
    jump = cut(whole.select("c", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.col("score").alias("sum"),
                            F.lit(0).cast("bigint").alias("depth"), F.col("node").alias("root")))
    # level k: the ancestor 2**k above (or null past the root), with the score from here to below it
    levels, size = [jump], jump.count()
    while levels[-1].where("up IS NOT NULL").limit(1).count():
        low = levels[-1]
        if 2 ** (len(levels) - 1) > size:
            raise ValueError("the parents of some messages form a cycle")
        high = low.select("c", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("sum").alias("sum2"), F.col("depth").alias("depth2"),
                          F.col("root").alias("root2"))
        reach = F.lit(2 ** (len(levels) - 1)).cast("bigint")
        # messages that have reached their root are settled and join no more
        further = low.where("up IS NOT NULL").join(high, ["c", "up"]).select(
            "c", "node", F.col("up2").alias("up"), (F.col("sum") + F.col("sum2")).alias("sum"),
            (reach + F.col("depth2")).alias("depth"), F.col("root2").alias("root"))
        levels.append(cut(low.where("up IS NULL").select("c", "node", "up", "sum", "depth", "root").unionByName(further)))
    leaves = levels[-1].join(links.where("parent IS NOT NULL").select("c", F.col("parent").alias("node")).distinct(), ["c", "node"], "left_anti")
    best = Window.partitionBy("c", "root").orderBy(F.col("sum").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    path = chosen.select("c", F.col("node").alias("leaf"), "rank", F.col("depth").alias("place"), "node")
    # going down the levels, a path gains the ancestors that lie 2**k above those it has
    for k in range(len(levels) - 2, -1, -1):
        up = levels[k].where("up IS NOT NULL").select("c", "node", "up")
        path = cut(path.unionByName(path.join(up, ["c", "node"]).select(
            "c", "leaf", "rank", (F.col("place") - 2 ** k).alias("place"), F.col("up").alias("node"))))
    return path


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One formatted conversation per chosen path: (conv, leaf, rank, formatted, loss_spans).

    ``loss_spans`` are the positions, in code points of ``formatted``, of the assistant texts.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("c")
    said = messages.select(key, "conv", "node", marked(F.col("role"), F.col("text")).alias("out"),
                           (F.col("role") == "assistant").alias("learn"), F.length(escaped(F.col("text"))).alias("n"))
    turns = paths(messages, branches).join(said, ["c", "node"])
    gathered = turns.groupBy("c", "leaf", "rank").agg(
        F.first("conv").alias("conv"), F.sort_array(F.collect_list(F.struct("place", "out", "learn", "n"))).alias("turns"))
    ends = F.expr("aggregate(turns, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,stop:int>>)), (s, t) -> named_struct("
                  "'at', s.at + length(t.out), 'spans', if(t.learn, concat(s.spans, array(named_struct("
                  f"'start', s.at + {len(MARKS['assistant'][0])}, 'stop', s.at + {len(MARKS['assistant'][0])} + t.n))), s.spans))).spans")
    return gathered.select("conv", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
                           ends.alias("loss_spans"))


DIGESTS = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                        T.StructField("formatted_chars", T.LongType())])


def digests(formatted: DataFrame) -> DataFrame:
    """Conversation id and digests, read back from the formatted text and its loss spans."""

    def work(texts: pa.Array, spans: pa.Array) -> dict[str, list]:
        rows = []
        for text, mask in zip(texts.to_pylist(), spans.to_pylist()):
            turns = read_back(text)
            said = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t, _, _ in turns).encode("utf-8")).hexdigest()
            learnt = "".join(unescape(text[s["start"]:s["stop"]]) for s in mask)
            rows.append((len(turns), said, len(learnt), hashlib.sha256(learnt.encode("utf-8")).hexdigest(), len(text)))
        return dict(zip(DIGESTS.names, map(list, zip(*rows))))

    return map_rows(formatted, ["conv"], DIGESTS, ["formatted", "loss_spans"], work).withColumnRenamed("conv", "conv_id")
