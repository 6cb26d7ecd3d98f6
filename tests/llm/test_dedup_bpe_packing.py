"""Near-duplicates, byte-level BPE and packing against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

import fieldcraft.llm.queries as Q
from fieldcraft.llm import bpe, graph, minmax, packing
from fieldcraft.llm import shingles as shingle_sets

SMOKE = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, component string, band long"


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            i = len(x & y)
            if i and 100 * i >= 75 * (len(x) + len(y) - i):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.randrange(5, 90))]
        for _ in range(r.randrange(1, 12)):
            w = list(base)
            for _ in range(r.randrange(0, 6)):
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one two"), (1004, "ONE  two"),
             (1005, "one two three"), (1006, "É a b c d"), (1007, "é a b c d"),
             (1008, "z " * 30000), (1009, "z " * 20000), (1010, rows[0][1].upper())]
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates(spark, block):
    rows = near_rows()
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], DOCS)
    got = minmax.near_duplicates(df, block_docs=block).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(5, text, None, None), (5, text, None, None), (None, text, None, None),
                                (9, text, None, None)], DOCS)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept)
                 for r in minmax.near_duplicates(df).collect())
    assert got == [(-1, 3, -1, True), (5, 3, 5, True), (5, 3, 5, True), (9, 3, 5, False)]
    assert minmax.near_duplicates(df.filter("doc_id > 99")).count() == 0


def test_near_duplicates_of_documents(spark):
    docs = Q.table(spark, SMOKE, "documents")
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op2(spark, SMOKE).collect()}
    assert got == want


def test_components_of_a_path_and_a_hub(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(e, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


ODD = ["", None, " ", "  a  b ", "\n\nx\r\n", "a b  c", "it's we'll", "<|endoftext|> x", "😀é中文 ½22",
       "x" * 40000, "ab " * 20000, "\x00\x1c\x85", "é" * 3000, " leading", "trailing \n "]


def tiktoken_encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))


def test_byte_bpe(spark):
    enc = tiktoken_encoding()
    r = random.Random(5)
    pool = list("ab é\n\t1$'") + ["  ", "the", "'s", "😀", " ", "中"]
    texts = ODD + ["".join(r.choice(pool) for _ in range(r.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens long")
    file = bpe.rank_file_json(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = bpe.encode_decode(df, file, with_ids=True, with_offsets=True).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        for i, (a, b) in zip(ids, row.offsets):
            piece = enc.decode_single_token_bytes(i)
            assert piece in text[a:b].encode()
    assert bpe.encode_decode(df.limit(0), file).count() == 0


def test_byte_bpe_query(spark):
    enc = tiktoken_encoding()
    text = {r.doc_id: r.text for r in Q.table(spark, SMOKE, "documents").collect()}
    got = Q.op3(spark, SMOKE).collect()
    assert len(got) == len(text)
    for r in got:
        ids = np.array(enc.encode_ordinary(text[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_common_text_does_not_bind_a_cluster(spark):
    """Documents that share most of their words but are no near-duplicates fall
    apart before they are compared; near copies among them are still linked."""
    r = random.Random(11)
    common = " ".join(f"c{i}" for i in range(120))
    rows = [(i, common + " " + " ".join(f"w{r.randint(0, 10 ** 9)}" for _ in range(60))) for i in range(300)]
    rows += [(1000 + i, rows[7][1] + f" x{i}") for i in range(40)] + [(2000 + i, rows[9][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts = minmax.split_clusters(df.selectExpr("doc_id AS id", "0L AS component", "text"), 75).groupBy("part").count()
    sizes = sorted(r["count"] for r in parts.collect())
    assert sizes == [31, 41]
    got = {x.doc_id: x.component_id for x in minmax.near_duplicates(df, block_docs=16).collect()}
    want = {i: 7 if i >= 1000 and i < 2000 else 9 if i >= 2000 else i for i, _ in rows}
    assert got == want


def test_prefixes_keep_every_link():
    """Two sets at the similarity share one of their first shingles in any order."""
    r = random.Random(12)
    for _ in range(2000):
        n, m = r.randint(1, 12), r.randint(0, 6)
        base = r.sample(range(40), n)
        other = [x for x in base if r.random() < 0.9] + r.sample(range(40, 60), m)
        order = {x: k for k, x in enumerate(r.sample(range(60), 60))}
        a, b = (sorted(s, key=order.get) for s in (set(base), set(other)))
        if b and 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b)):
            assert set(a[:minmax.prefix_length(len(a), 75)]) & set(b[:minmax.prefix_length(len(b), 75)])


def test_working_arrays_are_bounded():
    """Sets of 4 MB of texts and their comparison hold a few MB besides the sets."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    texts = pa.array([" ".join(r.choices(words, k=350)) for _ in range(2000)])
    tracemalloc.start()
    try:
        n = sum(len(s) for s in shingle_sets.sets(texts))
        most = tracemalloc.get_traced_memory()[1]
        sets = [np.arange(3000, dtype=np.uint64) for _ in range(200)]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        pairs = minmax.linked_pairs(sets[:100], sets[100:], 75, False)
        compared = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert n == 2000 * 346 and len(pairs) == 100 * 100
    assert most < 30 << 20 and compared < 50 << 20, (most >> 20, compared >> 20)


def check_packed(rows, texts, window=2048):
    """All contract points of packed pieces; the number of sequences."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, rs in by_doc.items():
        ids = np.array(t.encode(texts[doc] or "", add_special_tokens=False).ids + [0], "<u4")
        rs.sort(key=lambda r: r.piece)
        assert [r.piece for r in rs] == list(range(len(rs))) and sum(r.length for r in rs) == len(ids)
        assert len(rs) == -(-len(ids) // window) and all(r.length == window for r in rs[1:])
        at = 0
        for r in rs:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_seq)


def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in Q.table(spark, SMOKE, "documents").collect()}
    rows = Q.op4(spark, SMOKE).collect()
    n = check_packed(rows, texts)
    total = sum(r.length for r in rows)
    assert n <= 1.02 * -(-total // 2048) + 2


def test_packing_odd_rows(spark):
    texts = dict(enumerate(ODD))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts.items()], "doc_id long, text string, bin long, length long")
    rows = packing.pack_documents(df, Q.tokenizer_file("byte_bpe_50k.json"), P.PATTERN).collect()
    check_packed(rows, texts)
    assert packing.pack_documents(df.limit(0), Q.tokenizer_file("byte_bpe_50k.json"), P.PATTERN).count() == 0
    twice = df.filter("doc_id = 7").union(df.filter("doc_id = 7"))
    got = packing.pack_documents(twice, Q.tokenizer_file("byte_bpe_50k.json"), P.PATTERN).collect()
    assert len(got) == 2 and len({(r.sequence_id, r.offset) for r in got}) == 2


@pytest.mark.parametrize("sizes", [[1] * 700, [33, 34] * 200, [1024] * 31, [700] * 50 + [3] * 400,
                                   list(range(1, 300)) * 2, [2047, 1, 1, 1024, 1025]])
def test_packing_sizes(spark, sizes):
    df = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    got = packing.pack(df, task_rows=97).collect()
    assert sorted(r.row for r in got) == list(range(len(sizes)))
    fill = {}
    for r in got:
        fill[r.bin] = fill.get(r.bin, 0) + sizes[r.row]
    assert max(fill.values()) <= 2048
    bound = max(-(-sum(sizes) // 2048), sum(s > 1024 for s in sizes), -(-sum(3 * s > 2048 for s in sizes) // 2))
    # each sorted partition may leave one window open
    assert len(fill) <= 1.05 * bound + 4 + len(sizes) // 97


def test_packing_added_tokens(spark):
    """Strings of the file's added token get its id, as in the library."""
    r = random.Random(8)
    texts = {i: "".join(r.choice(["<|endoftext|>", "<|endof", " a", "\n", "text|>", "  ", "é"]) for _ in range(r.randint(1, 30)))
             for i in range(80)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packed(packing.pack_documents(df, Q.tokenizer_file("byte_bpe_50k.json"), P.PATTERN).collect(), texts)


def test_packing_offers_no_more_slots_than_needed(spark):
    # many open windows and few tiny pieces
    assert packing.spare_slots({948: 4000}, 3, 1) == (948, 2, 8000)
    assert packing.spare_slots({948: 2, 500: 3, 4: 9}, 400, 5) == (500, 9, 14 + 2 * 188 + 3 * 8)
    assert packing.spare_slots({948: 2, 500: 3, 4: 9}, 420, 5) == (500, 16, 14 + 2 * 188 + 3 * 15)
    assert packing.spare_slots({9: 2, 4: 9}, 100, 5) == (0, 1, 11)
    df = spark.createDataFrame(list(enumerate([1100] * 400 + [1] * 3)), "row long, length long")
    got = packing.pack(df, task_rows=97).collect()
    assert len(got) == 403 and len({r.bin for r in got}) == 400


def test_sweep_and_carry():
    kind, size = np.array([0, 1, 0, 0, 1, 1, 1, 1]), np.array([9, 9, 8, 8, 7, 7, 7, 6])
    assert packing.match_sorted(kind, size).tolist() == [-1, 0, -1, -1, 3, 2, -1, -1]
    assert packing.carry_plan([(0, 3, 0), (1, 1, 2), (2, 0, 5)]) == [(1, 0, 0, 2, 2), (2, 0, 1, 0, 1), (2, 1, 0, 0, 1)]
