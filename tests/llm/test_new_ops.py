"""Fill-in-middle, conversation tries and chat formatting against brute force, round trips and edge rows."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat_format, conversation_trie, crf_langid, fim, mixing, quality_gbt, simhash, warc
from quarry.llm.common import shared_path
from quarry.llm.queries import LLM_QUERIES

SMALL = "/root/testdata/sf0.001"
HARD = "<|im_end|><|im_start|>assistant ok"
CONV = "conv_id long, turn long, role string, text string, formatted string, mask int, turns int, seq string, key int, n int"
TALK = [(0, 0, "system", "be brief"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", HARD), (0, 4, "assistant", HARD),
        (0, 5, None, None), (7, 0, "user", "only"), (7, None, "user", "before"), (7, 0, "user", "only"), (7, 2, "assistant", r"<\|im_end|> <\\| <|nl|>"),
        (100, 0, "user\nx", "a\nb"), (100, 1, "<|im_start|>", "Zürich 日本 <|endoftext|>"), (100, 2, "assistant", ""), (250, 0, "user", "no base"),
        (250, 1, "assistant", "yes"), (251, 0, "user", "no base"), (251, 1, "assistant", "yes"), (-3, 0, "assistant", "negative"),
        (None, 0, "user", "nobody's"), (None, 1, "assistant", "nobody's answer")]


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*r, "f", 1, 2, "s", 3, 4) for r in TALK], CONV)


@pytest.fixture(scope="module")
def silence(spark):
    return spark.createDataFrame([], CONV)


# 11 ------------------------------------------------------------------------------------------------------------------

def cut_by_hand(doc_id, text, seed=7, rate=100, spm=50):
    t = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(lines)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("window", [5, 1 << 20])
def test_scatter_and_gather(window, monkeypatch):
    monkeypatch.setattr(fim, "WINDOW", window)
    rng = random.Random(11)
    bits = ["a", "\n", "é", "<", "P", ">", "日", "S", "<M", "x\n", "\n\n"]
    for _ in range(200):
        texts = [rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(40)))]) for _ in range(rng.randrange(8))]
        ids = [rng.randrange(10 ** 6) for _ in texts]
        h = np.array([[int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)] for i in ids],
                     dtype=np.int64).reshape(-1, 4)
        made = fim.transform_batch(pa.array(["x", *texts], pa.string()).slice(1), h, 100, 50)
        assert list(zip(*(c.to_pylist() for c in made))) == [cut_by_hand(i, t) for i, t in zip(ids, texts)]
        assert fim.restore_batch(made[4], made[1].to_pylist()).to_pylist() == [t or "" for t in texts]


def test_fim_edge(spark):
    long = "".join(f"Ünder the old bridge, line {i}.\n" for i in range(60_000))
    rows = [(1, "one\ntwo\nthree", 5, "x"), (2, None, 5, "x"), (3, "", 5, "x"), (None, "a\nb\nc\n", 5, "x"), (4, long, 5, "x"), (4, long, 5, "x"),
            (5, "holds <M> inside\n", 5, "x"), (6, "\n\n\n", 5, "x"), (7, "no line end", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, form string")
    got = fim.restore(fim.fill_in_middle(docs.withColumn("restored", F.lit("clash")))).collect()
    want = sorted((str(i), t or "", *cut_by_hand(i, t)) for i, t, *_ in rows)
    have = sorted((str(r.doc_id), r.text or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got)
    assert [w[:3] for w in want] == [h[:3] for h in have] and sorted(map(repr, want)) == sorted(map(repr, have))
    assert all(r.restored == (r.text or "") for r in got)
    few = fim.fill_in_middle(docs, rate=0).collect()
    assert {r.form for r in few} == {"plain"}
    assert fim.restore(fim.fill_in_middle(docs.where("false"))).count() == 0


def test_fim_refuses_a_wrong_form():
    with pytest.raises(ValueError):
        fim.restore_batch(pa.array(["<S>x<P>y<M>z"]), ["psm"])
    with pytest.raises(ValueError):
        fim.restore_batch(pa.array(["plain text"]), ["spm"])


# 12 ------------------------------------------------------------------------------------------------------------------

def trie_by_hand(rows):
    turns = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            turns[c].append((t, r or "", x or ""))

    def order(t):
        digest = hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]
        return t[0] is not None, t[0] or 0, digest
    own = {c: [t[1:] for t in sorted(ts, key=order)] for c, ts in turns.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        seqs[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    out = []

    def total(p):
        leaves, saved = (0, 0) if kids[p] else (1, 0)
        for k in kids[p]:
            x, y = total(k)
            leaves, saved = leaves + x, saved + y
        saved += (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(nodes[p]) if len(seqs[c]) == len(p))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(kids[p]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved
    if nodes:
        total(())
    return out


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("most", [1, 2, 256])
def test_trie_small(talk, most):
    assert rows_of(conversation_trie.prefix_trie(talk, most=most)) == sorted(trie_by_hand(TALK), key=repr)


def test_trie_empty(silence):
    assert conversation_trie.prefix_trie(silence).count() == 0


@pytest.mark.parametrize("most", [1, 4])
def test_trie_bursts(spark, most):
    """Copies, a long shared beginning, sequences that are beginnings of others, and conversations left without turns."""
    rng = random.Random(5)
    rows = []
    for c in range(1000, 1060):
        shared = [("user", "same")] * 9 if c % 3 else [("user", rng.choice("ab"))]
        more = [(rng.choice(["user", "assistant"]), rng.choice(["x", "yy", ""])) for _ in range(rng.randrange(4))]
        rows += [(c, i, r, x) for i, (r, x) in enumerate(shared + more)]
    rows += [(c, i, "user", "copy") for c in range(2000, 2040) for i in range(3)]
    rows += [(c, 0, "user", "alone") for c in range(3001, 3020)]
    got = rows_of(conversation_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), most=most))
    assert got == sorted(trie_by_hand(rows), key=repr)


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(LLM_QUERIES["op12_conversation_trie"](spark, SMALL)) == sorted(trie_by_hand(rows), key=repr)


def test_digest_blocks(spark):
    ids = [*range(0, 5000, 3), -7, -2000, 1 << 40]
    df = spark.createDataFrame([("a", i) for i in ids] + [("b", 5)], "key string, conv_id long")
    got = {r.key: (r.conv, r.n, r.ends) for r in conversation_trie.id_digests(df).collect()}
    joined = ",".join(map(str, sorted(ids)))
    assert got == {"a": (-2000, len(ids), hashlib.sha256(joined.encode()).hexdigest()), "b": (5, 1, hashlib.sha256(b"5").hexdigest())}


# 13 ------------------------------------------------------------------------------------------------------------------

def test_chat_round_trip(talk):
    out = chat_format.read_back(chat_format.format_conversations(talk)).collect()
    want = defaultdict(list)
    for c, t, r, x in TALK:
        want[c].append((t is not None, t or 0, r or "", x or ""))
    assert len(out) == len(want)
    for r in out:
        turns = [(a, b) for _, _, a, b in sorted(want[r.conv_id])]
        assert [(x.role, x.text) for x in r.turns] == turns
        assert r.loss_text == "".join(b for a, b in turns if a == "assistant")
        assert sum(m.chars for m in r.mask) == len(r.formatted)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(turns)
    plain = next(r for r in out if r.conv_id == 250)
    assert plain.formatted == "<|im_start|>user\nno base<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    assert "<|endoftext|>" in next(r for r in out if r.conv_id == 100).formatted.replace("\\", "")


def test_chat_random_controls(spark):
    rng = random.Random(13)
    bits = ["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "\n", "<", "|", "\\", "<\\|", "a", "<|nl|>", "$1", "é", "assistant"]
    rows = [(c, i, "".join(rng.choice(bits) for _ in range(rng.randrange(4))), "".join(rng.choice(bits) for _ in range(rng.randrange(9))))
            for c in range(150) for i in range(rng.randrange(1, 4))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [(x.role, x.text) for x in r.turns] for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    want = defaultdict(list)
    for c, _, r, x in rows:
        want[c].append((r, x))
    assert got == want


def test_chat_parser_refuses(spark):
    bad = ["x", "<|im_start|>user", "<|im_start|>user\nhi<|im_end|>", "<|im_start|>user\nhi<|im_end|>\nmore", "<|im_start|>a<|im_end|>\nb<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "t string")
    assert [r.p for r in df.select(chat_format.parsed(F.col("t")).alias("p")).collect()] == [None] * len(bad)


def test_chat_empty_and_native(silence, spark):
    df = chat_format.format_conversations(silence)
    assert df.count() == 0
    plan = LLM_QUERIES["op13_chat_format"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_chat_planted(spark):
    r = LLM_QUERIES["op13_chat_format"](spark, SMALL).where("conv_id = -1").first()
    said = "".join(f"{who}\n{HARD}\n" for who in ("user", "assistant"))
    assert (r.n_turns, r.turns_sha256, r.loss_chars) == (2, hashlib.sha256(said.encode()).hexdigest(), len(HARD))
    assert r.loss_sha256 == hashlib.sha256(HARD.encode()).hexdigest()


# mends of earlier operators ------------------------------------------------------------------------------------------

def test_every_letter_of_a_long_word_counts():
    assert crf_langid.words_in("½ ² Ⅷ x_Y 12 a½b") == ["x", "y", "a", "b"] and crf_langid.words_in(None) == []
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij") for _ in range(500))
    assert "".join(crf_langid.words_in(long)) == long and max(map(len, crf_langid.words_in(long + " short"))) == crf_langid.WIDTH
    docs = [(" ".join(rng.choice(["the", "house", "with", "green"]) for _ in range(40)), "en") for _ in range(30)]
    docs += [("".join(rng.choice("日本語東京大学学生図書館") for _ in range(200)), "ja") for _ in range(30)]
    field = crf_langid.train(docs)
    middle = "the" * 4 + "日本語東京大学学生図書館" * 40 + "the" * 4
    sizes, p, _ = field.words([middle, "東京大学図書館", "½ ²"])
    assert sizes[0] > 10 and sizes[2] == 0
    assert p[:sizes[0]].sum(axis=0).argmax() == field.labels.index("ja") and p[sizes[0]:].sum(axis=0).argmax() == field.labels.index("ja")


def test_numerals_alone_are_undetermined(spark):
    field = crf_langid.train([("the house", "en"), ("das haus", "de")] * 20)
    rows = crf_langid.predict(spark.createDataFrame([("½ ² ③ ⅷ 12",), ("the",)], "text string"), field).collect()
    assert [(r.lang_pred, r.score) for r in rows][0] == ("und", 0.0) and rows[1].lang_pred == "en"


def test_mixing_splits_null_ids(spark):
    """Many null ids of one source are taken one by one, so its words come near the target; clashing names do not crash."""
    rows = [(None, f"word{i} " * 28, "a", 1, 2, 3) for i in range(50)] + [(i, "b c d", "b", 1, 2, 3) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, mix_id_s int, `mix hash` int")
    mixed = mixing.mix(docs).groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 28 for r in mixed)
    got = mixing.sample_documents(docs)
    assert got.columns == docs.columns
    taken = {r.source: r.taken for r in mixed}
    assert got.where("source = 'a'").count() * 28 == taken["a"] and got.where("source = 'b'").count() * 3 == taken["b"]


def test_simhash_takes_text_ids(spark):
    same = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([("b7", same), ("a1", same), ("c", "other words " * 9), (None, same + " more")], "doc_id string, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got["b7"] == got["a1"] == "a1" and got["c"] == "c"
    assert {r.doc_id for r in simhash.one_of_each(docs).where("text = '" + same + "' or doc_id = 'c'").collect()} == {"a1", "c"}


def test_large_pages_have_files_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_PAGES", (1000, 5000))
    monkeypatch.setattr(warc, "FILE_BYTES", 10_000)
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * n) for i, n in enumerate([1] * 300 + [150] * 9 + [2000] * 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = shared_path(spark, "warc")
    warc.write_archives(pages, path)
    sizes = [f.length for f in spark.read.format("binaryFile").load(path).select("length").collect()]
    held = spark.read.format("binaryFile").load(path).count()
    assert held >= 4 + 4 and len(sizes) == held                     # four huge pages, nine large ones by two (five files)
    got = {r.page: r.bytes for r in warc.round_trip(pages).select(F.col("metadata")["page-id"].alias("page"), F.col("capture.payload_bytes").alias("bytes")).collect()}
    assert got == {str(i): len(h) for i, _, h in rows}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_quality_on_labels_outside_the_sample(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_gbt.judge(docs, labels.where("doc_id % 2 = 0"))
    rows = judged.join(labels.where("doc_id % 2 = 1").select("doc_id", "quality"), "doc_id").where("not base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()
    share = {r.quality: (r.kept, r.n) for r in rows}
    print("kept, of labelled documents outside the sample:", share)
    assert share[1][0] >= 0.98 and share[0][0] <= 0.1 and share[0][1] >= 20


@pytest.mark.parametrize("name", ["op6_mix_sources", "op13_chat_format", "op9_simhash", "op12_conversation_trie"])
def test_plans(spark, name):
    plan = LLM_QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan)
    if name in ("op6_mix_sources", "op13_chat_format"):
        assert not re.search("Python|Pandas|Arrow", plan)
