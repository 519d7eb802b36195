"""The pipeline on whole tables against a brute-force version, and the queries against their SQL."""
import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import WORDS
from test_near_copies import brute_left
from test_operators import brute_counts, brute_lines, sha

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from lakeops.llm import queries as Q  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def brute_mix(docs):
    """Copies per document (id, text, source): order by hash of the id within the source, the one at the cut goes whole."""
    by = defaultdict(list)
    for d in docs:
        by[d[2]].append((hashlib.md5(str(d[0]).encode()).hexdigest(), d[0], len(WORDS(d[1]))))
    size = {s: sum(x[2] for x in rows) for s, rows in by.items()}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by, key=lambda s: (s is None, (s or "").encode())))}
    target, free, left = {}, set(by), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over} if over else {s: level * weight[s] for s in free}
        left -= sum(2 * size[s] for s in over)
        free = free - over if over else set()
    copies = {}
    for s, rows in by.items():
        epochs, rest = divmod(int(target[s]), size[s])
        for _, i, n in sorted(rows):
            copies[i] = epochs + (rest > 0)
            rest -= n
    return copies


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    kept = []
    for d in docs:
        n, *_, repeated = brute_counts(d[1])
        if n >= 50 and 100 * repeated <= 50 * n:           # too few labels for a cutoff
            kept.append(d)
    texts = brute_lines(kept, 50, texts=True)
    left = [(d[0], texts[d[0]], d[2]) for d in kept if WORDS(texts[d[0]])]
    staying = {i for _, i in brute_left(left)}
    left = [d for d in left if d[0] in staying]
    copies, library = brute_mix(left), Tokenizer.from_file(Q.tokenizer("word_bpe_49k.json"))
    want = Counter()
    for i, text, _ in left:
        ids = library.encode(text, add_special_tokens=False).ids
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False))] += copies[i]
    out = corpus_pipeline.run(spark, SMALL)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect()) == +want


def test_stages_return_the_columns_of_documents_and_take_odd_rows(spark, odd, none):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == odd.columns, name
        assert stage(spark, none, SMALL).count() == 0
        rows = out.collect()
        docs = spark.createDataFrame(rows, odd.schema)
    assert rows and corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, none, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_queries_equal_their_sql(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import oracle

    status, _, _, note = oracle.compare(name, spark, SMALL, oracle.connect(SMALL), Q.QUERIES, Q.ORACLES)
    assert status == "ok", note


def test_chat_escapes_and_reads_back(spark):
    from lakeops.llm import chat

    rows = [(1, 0, "system", "<<SYS>> \\b [x] <"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "\\l<s>é\n"), (1, 3, "too[l", None),
            (1, 3, None, "x"), (None, 1, "user", "a"), (None, None, "assistant", ""), (2, 5, "assistant", "only"), (1, 4, "assistant", "\\\\")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    made = chat.conversations(chat.numbered(df)).collect()
    back = {r["conv"]: [(role, text) for role, text, _, _ in chat.read_back(r["formatted"])] for r in made}
    assert back[1] == [("system", "<<SYS>> \\b [x] <"), ("user", "</s>[INST] ok [/INST]"), ("assistant", "\\l<s>é\n"), ("", "x"), ("too[l", ""), ("assistant", "\\\\")]
    assert back[None] == [("assistant", ""), ("user", "a")] and back[2] == [("assistant", "only")]
    one = next(r for r in made if r["conv"] == 1)
    assert [chat.unescape(one["formatted"][s["start"]:s["stop"]]) for s in one["loss_spans"]] == ["\\l<s>é\n", "\\\\"]
    assert chat.digests(chat.conversations(chat.numbered(df.limit(0)))).count() == 0


def test_any_role_and_text_come_back(spark):
    from lakeops.llm import chat

    rng = random.Random(8)
    pieces = ["\\", "<", "[", ">", ">>", "]", "l", "b", "g", "a", " ", "\n", "</s>", "<<ROLE ", "<</ROLE>>", "[INST] ", " [/INST]", "<s>", "<<SYS>>", "é"]
    make = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", "a>", "a>>b", make()]), make()) for c in range(60) for t in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    formatted = chat.conversations(chat.numbered(df)).cache()
    want = defaultdict(list)
    for c, _, role, text in rows:
        want[c].append((role, text))
    assert {r["conv"]: [(role, text) for role, text, _, _ in chat.read_back(r["formatted"])] for r in formatted.collect()} == want
    for r in chat.digests(formatted).collect():
        turns = want[r["conv_id"]]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)))
        assert r["loss_sha256"] == sha("".join(text for role, text in turns if role == "assistant"))


def test_stages_take_columns_with_dots(spark, odd):
    docs = odd.withColumnsRenamed({"kept": "a.b", "k1": "__key", "bits": "__source"}).limit(30)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert {"a.b", "__key", "__source"} <= set(out.columns), name
        assert {r[0] for r in out.select("`a.b`").collect()} == {"clash"}, name


def test_ids_decide_the_decoded_text():
    from lakeops.llm import bpe

    encoder = bpe.Encoder(bpe.read_vocabulary(Q.tokenizer("word_bpe_49k.json")))
    a, b = encoder.ids("a house<|endoftext|>"), encoder.ids("a mouse")
    assert encoder.decode(a + b) == encoder.decode(a) + " " + encoder.decode(b)
    assert encoder.decode(a[-4:]) == "<|endoftext|>" and encoder.decode(b"\xff\xff\xff\x7f" + b) == encoder.decode(b)


def test_reply_trees(spark):
    from lakeops.llm import chat

    # 0 is the root of 1, 2; 1 of 3; 2 of 4, 5; 6 has a parent that is missing; a chain of 70 below 100
    rows = [("t", 0, None, 0.0), ("t", 1, 0, 5.0), ("t", 2, 0, 1.0), ("t", 3, 1, -1.0), ("t", 4, 2, 1.0), ("t", 5, 2, 3.5), ("t", 6, 99, None)]
    rows += [(None, 100 + i, 99 + i if i else None, 1.0) for i in range(70)]
    df = spark.createDataFrame([(*r, "user", str(r[1])) for r in rows], "conv string, node long, parent long, score double, role string, text string")
    got = defaultdict(list)
    for r in chat.paths(df, branches=2).orderBy("c", "leaf", "place").collect():
        got[r["c"], r["leaf"], r["rank"]].append((r["place"], r["node"]))
    walk = lambda *nodes: list(enumerate(nodes))
    assert got == {("=t", 5, 1): walk(0, 2, 5), ("=t", 3, 2): walk(0, 1, 3), ("=t", 6, 1): walk(6), ("", 169, 1): walk(*range(100, 170))}
    cycle = spark.createDataFrame([("c", 1, 2, 0.0, "user", ""), ("c", 2, 1, 0.0, "user", "")], df.schema)
    with pytest.raises(ValueError):
        chat.paths(cycle)


def test_sealed_equals_encoded(spark):
    from pyspark.sql import functions as F

    from lakeops.llm import bpe

    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "An  ÄPFEL 12 <|endoftext|>", "x"), (3, "w" * 9_000, None)],
                                 "doc_id bigint, text string, decoded string")
    path = Q.tokenizer("word_bpe_49k.json")
    plain, sealed = bpe.encode(docs, path, keep=["doc_id"]), bpe.sealed(docs, path, keep=["doc_id"])
    want = plain.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256), F.sha2(F.col("decoded").cast("binary"), 256))
    assert sealed.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, sealed.collect())) == sorted(map(tuple, want.collect()))
    assert bpe.sealed(docs.limit(0), path).count() == 0
