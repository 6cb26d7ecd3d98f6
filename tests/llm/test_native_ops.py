"""Sharding, chat formatting and quality rules against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import fieldcraft.llm.queries as Q
from fieldcraft.llm import chat, quality, sharding

SMOKE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check_shards(got, docs, shards):
    assert sorted((r.doc_id or -1) for r in got) == sorted((d[0] or -1) for d in docs)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    # every source is spread evenly: each shard holds its share, to within two rows
    total = Counter(r.source for r in got)
    for rs in by.values():
        for source, n in Counter(r.source for r in rs).items():
            assert abs(n - total[source] * len(rs) / len(got)) <= 2
    text = dict((d[0], d[1]) for d in docs)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_shards_query(spark):
    docs = [(r.doc_id, r.text) for r in Q.table(spark, SMOKE, "documents").collect()]
    check_shards(Q.op1(spark, SMOKE).collect(), docs, 16)


def test_shards_odd_rows(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["é", None, "", "xy"]), r.choice(["a"] * 6 + ["b", None]), 3) for i in range(157)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int")
    got = sharding.interleave(df, 7).collect()
    check_shards(got, rows, 7)
    assert [tuple(x) for x in sharding.interleave(df.repartition(5), 7).orderBy("doc_id").collect()] == \
        [tuple(x) for x in sorted(got, key=lambda x: x.doc_id)]
    assert sharding.interleave(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a", "s", 0)] * 5 + [(None, "a", "s", 0)], df.schema)
    check_shards(sharding.interleave(twice, 2).collect(), [(1, "a")] * 5 + [(None, "a")], 2)


def escape(t):
    return re.sub(r"([<\[\\])", r"\1" + "\\\\", t)


MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ORDERS = {None: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}


def chat_expected(turns):
    turns = [(t, r or "", x or "") for t, r, x in turns]
    turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(x for _, r, x in turns if r == "assistant")
    out, state, ok = "", None, True
    for _, r, x in turns:
        a, b = MARKS.get(r, (f"<role {r.encode().hex().upper()}>", "</role>"))
        out += a + escape(x) + b
        ok = ok and r in ORDERS.get(state, ())
        state = r
    return (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss), len(out),
            ok and state == "assistant"), out


def test_chat(spark):
    r = random.Random(4)
    bits = ["a", "é😀", "</s>", "[INST]", "\\", "<\\", "[/INST]", "<<SYS>>", "\n", "<role 41>", "$1", "\\\\", "<s", ">"]
    rows = []
    for c in range(60):
        for t in range(r.randrange(1, 7)):
            rows.append((c, t, r.choice(["user", "assistant", "system"] if c % 2 else [["user", "assistant"][t % 2]]),
                         "".join(r.choice(bits) for _ in range(r.randrange(6))), "x"))
    rows += [(100, 0, None, "t", "x"), (100, 0, "tool>é", None, "x"), (100, None, "user", "u", "x"),
             (101, 0, "user", "<s>" * 40000, "x"), (101, 1, "assistant", "[" * 50000, "x"),
             (102, 1, "assistant", "b", "x"), (102, 0, "user", "a", "x"), (102, 0, "user", "a", "x"),
             (None, 0, "user", "n", "x"), (-1, 0, "user", Q.PROBE, "x"), (-1, 1, "assistant", Q.PROBE, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df)
    got = {x.conv_id: tuple(x)[1:] for x in chat.conversation_digests(made).collect()}
    text = {x.conv_id: x for x in made.collect()}
    want = {}
    for c, *x, _ in rows:
        want.setdefault(c, []).append(tuple(x))
    assert set(got) == set(want)
    for c, turns in want.items():
        digests, out = chat_expected(turns)
        assert text[c].formatted == out == "".join(s.text for s in text[c].segments)
        assert got[c] == digests, c
    assert chat.format_conversations(df.limit(0)).count() == 0


def base(t):
    t = t or ""
    w = WORD.findall(t)
    tri = Counter(zip(w, w[1:], w[2:]))
    cov = {p for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cov),
            len(w) < 50 or 100 * len(cov) > 50 * len(w))


ODD = [None, "", " \t\n\x0b\x0c\r", "a b c", "a b c a b c", " x\n\nx \n x\n", "a|b ## <x> &&é",
       "a b " * 30000, "\n".join(["one two three"] * 60), "w " * 49, "w " * 50, " ".join(f"w{i}" for i in range(80)),
       "é ß " + " ".join(f"ü{i % 60}" for i in range(120)), "x\x1cy z\x85q"]


def test_quality_base_counts(spark):
    r = random.Random(1)
    texts = ODD + [" ".join(r.choice("abc") for _ in range(r.randrange(40))) + "\n" * r.randrange(3) for _ in range(200)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, __grams int, kept string")
    labels = spark.createDataFrame([(11, 1), (11, 1), (12, 0), (None, 1), (999, None)], "doc_id long, quality int")
    got = quality.judge(df, labels).collect()
    assert len(got) == len(texts)
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == base(texts[x.doc_id])
        assert not (x.base_failed and x.kept)
    kept = {x.doc_id for x in got if x.kept}
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns and {x.doc_id for x in out.collect()} == kept
    assert quality.judge(df.limit(0), labels).count() == 0
    assert quality.judge(df, labels.limit(0)).count() == len(texts)


def test_quality_ratio(spark):
    """Weights and scores against counts made by hand, over the words that
    Spark's own hash puts into the same bucket."""
    import math
    texts = ["a b a", "a c", "d d d", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    n, prior = 1 << 12, 0.01
    got = {x.doc_id: x.llr for x in quality.judge(df, labels, buckets=n, prior=prior).collect()}
    hashed = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("d", "d")], "x string, y string").select(
        "x", "y", F.xxhash64("x").alias("h"), F.xxhash64(F.xxhash64("x"), F.xxhash64("y")).alias("p"),
        F.xxhash64("y").alias("k")).collect()
    one = {r.x: r.h % n for r in hashed} | {r.y: r.k % n for r in hashed}
    two = {(r.x, r.y): r.p % n for r in hashed}
    bag = lambda t: [one[w] for w in (t or "").split()] + [two[p] for p in zip((t or "").split(), (t or "").split()[1:])]
    raw, good = Counter(g for t in texts for g in bag(t)), Counter(bag(texts[0]))
    mass, every, target = prior * n, sum(raw.values()), sum(good.values())
    for i, t in enumerate(texts):
        own = int(i == 0)
        want = []
        for g in bag(t):
            p = (raw[g] - 1) / (every - 1)
            want.append(math.log((max(good[g] - own, 0) + mass * p) / ((target - own + mass) * p)) if p else 0.0)
        assert got[i] == pytest.approx(sum(want) / len(want) if want else 0.0, abs=1e-9)


def test_quality_on_documents(spark):
    """Labelled documents: planted junk goes, what is labelled good stays."""
    d = "/root/testdata/sf0.01"
    rows = (Q.op7(spark, d).join(Q.table(spark, d, "labels"), "doc_id")
            .filter(~F.col("base_failed")).select("quality", "kept").collect())
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_at_other_sizes(spark):
    """Junk of one kind goes from a small and from a large table, and scores
    alike in both."""
    r, means = random.Random(5), []
    for n in (60, 600):
        words = lambda tail: " ".join(f"g{int(400 * r.random() ** 2)}{tail}" for _ in range(120))
        texts = [words("") for _ in range(n)] + [words("%%%") for _ in range(n // 5)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        labels = df.selectExpr("doc_id", f"IF(doc_id < {n}, 1, 0) AS quality").filter("doc_id % 2 = 0")
        got = quality.judge(df, labels).collect()
        good, bad = [x.kept for x in got if x.doc_id < n], [x.llr for x in got if x.doc_id >= n]
        assert sum(good) >= 0.9 * n and not any(x.kept for x in got if x.doc_id >= n)
        means.append(sum(bad) / len(bad))
    assert means[0] == pytest.approx(means[1], rel=0.3) and means[1] < -0.5


def test_quality_target_is_whole(spark):
    """Every document labelled good counts, however many there are."""
    rows = spark.range(20_500).select(F.col("id").alias("__id"), F.lit("x").alias("__text"))
    labels = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.flag_good(rows, quality.good_ids(labels)).filter("__in").count() == 20_500


def test_quality_flags_without_broadcast(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "__id long, __text string")
    good = spark.createDataFrame([(1,), (7,)], "__good long")
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    try:
        for limit in (old, "-1"):
            spark.conf.set(name, limit)
            got = {x["__text"]: x["__in"] for x in quality.flag_good(rows, good).collect()}
            assert got == {"a": True, "b": True, "c": False, "d": False}
    finally:
        spark.conf.set(name, old)


def test_quality_of_few_documents(spark):
    """A table of 200 documents: planted junk goes, what is labelled good stays."""
    d = "/root/testdata/sf0.001"
    rows = Q.op7(spark, d).join(Q.table(spark, d, "labels"), "doc_id").filter(~F.col("base_failed")).collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_cut_is_the_exact_rank_of_all_good_documents(spark):
    n = 30_000  # more than were once sampled
    rows = spark.range(n).select(F.col("id").alias("__id"), F.when(F.col("id") % 3 < 2, (F.col("id") * 7919 % n).cast("double")).alias("__inside"))
    good = spark.range(n).filter("id % 3 = 1").select(F.col("id").alias("__good"))
    scores = sorted(i * 7919 % n for i in range(n) if i % 3 == 1)
    assert quality.label_cut(rows, good) == scores[len(scores) * 5 // 1000 - 1]
    assert quality.label_cut(rows.limit(0), good) == -math.inf
    one = rows.filter("__id = 4")
    assert quality.label_cut(one, good) == one.first()["__inside"]
