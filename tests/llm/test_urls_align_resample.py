"""URL rules, token alignment and resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import fieldcraft.llm.queries as Q
from fieldcraft.llm import align, resample, urls

SMOKE = "/root/testdata/sf0.001"


# --- url rules --------------------------------------------------------------

def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return (re.sub("[A-Z]", lambda m: m.group().lower(), host),
            re.match(r"[^?#]*", rest[len(host):]).group())


def brute_rule(url, rules):
    host, path = split_url(url)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


def check_urls(spark, pages, rules, parts=5):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(pages, "page_id long, url string, host string, labels string")
        got = urls.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    real = [(h.lower(), p or "", v) for h, p, v in rules if h is not None and v is not None]
    want = Counter((p[0], *brute_rule(p[1], real)) for p in pages)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want


def test_url_query(spark):
    got = Q.op11(spark, SMOKE).collect()
    pages = Q.table(spark, SMOKE, "pages").collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == \
        sorted((p.page_id, *brute_rule(p.url, Q.URL_RULES)) for p in pages)
    assert {r.verdict for r in got} == {"allow", "block"}


def test_url_odd_rows(spark):
    odd = [None, "", "no scheme", "a://", "a://com", "http://com/", "http://COM/x", "http://www.example.com/en/a?b#c",
           "http://example.com?x/en/", "http://x.example.com/en", "x://é.example.com/en/ü", "http://a..com/en/",
           "http://example.com./en/", "http://u@example.com:80/en/", "http://notexample.com/en/",
           "http://example.com/en/" + "y" * 200_000, "http://" + "a." * 3000 + "example.com/en/", "://example.com/en/z",
           "http://a?b://example.com/en/", "http://example.com/en/\nq"]
    pages = [(i, u, "h", "l") for i, u in enumerate(odd)] + [(None, "http://com/", None, None)] * 3
    rules = [*Q.URL_RULES, ("com", None, "block"), ("com", "/", "block"), ("Example.com", "/en/a", "allow"),
             (None, "/", "block"), ("org", "/", None), ("", "", "block")]
    check_urls(spark, pages, rules[:5])
    # equal rules: the largest verdict
    check_urls(spark, pages, [*Q.URL_RULES[1:], ("com", None, "block"), ("com", "/", "block"),
                              ("Example.com", "/en/a", "allow"), (None, "/", "block"), ("org", "/", None),
                              ("", "", "block")])
    assert urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string, host string, labels string").limit(0),
                           spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    check_urls(spark, pages, [(None, "/", "x")])


def test_url_rules_cross_partitions(spark):
    r = random.Random(4)
    name = lambda n: "".join(r.choice("ab") for _ in range(n))
    host = lambda: ".".join(name(r.randint(0, 2)) for _ in range(r.randint(1, 4)))
    path = lambda: "/" + "/".join(name(r.randint(0, 2)) for _ in range(r.randint(0, 3)))
    rules = list({(h, p): (h, p, r.choice(["allow", "block", "watch"]))
                  for h, p in [(host(), path()[:r.randint(0, 5)]) for _ in range(150)]}.values())
    pages = [(i, f"x://{host()}{path()}", "", "") for i in range(1500)]
    pages += [(i, "x://a.b.a/a/b", "", "") for i in range(900)]  # one url is a third of the rows
    check_urls(spark, pages, rules, 13)


def test_url_sweep_and_carry():
    rows = [("a", None, 1), ("a", 10, 0), ("ab", None, 2), ("abc", 11, 0), ("ac", 12, 0), ("b", 13, 0), ("bz", None, 3)]
    out, left = [], []

    def run():
        left.extend((yield from urls.sweep(rows)))
    out = list(run())
    assert [(r, rule) for r, _, rule in out] == [(10, 1), (11, 2), (12, 1), (13, None)] and left == [("bz", 3)]
    edges = [(0, urls.FIRST, "a"), (0, urls.OPEN, "ab", "r1"), (2, urls.FIRST, "abc"), (2, urls.OPEN, "abd", "r2"),
             (3, urls.FIRST, "abe"), (5, urls.FIRST, "b")]
    assert urls.carried(edges) == [(2, "ab", "r1"), (3, "ab", "r1")]


# --- alignment ---------------------------------------------------------------

@pytest.fixture(scope="module")
def files():
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        return Q.tokenizer_file("byte_bpe_50k.json"), P.PATTERN, f.read()


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute_spans(text, tokenizers):
    """Ids and byte ranges of both sides from the libraries; None: no tokens."""
    t, sp = tokenizers
    if not text:
        return None
    whole = " " + text
    from fieldcraft.llm.bpe import byte_characters
    back = {c: b for b, c in enumerate(byte_characters())}
    a = t.encode(whole, add_special_tokens=False)
    sides = [[(i, bytes(back[c] for c in p)) for i, p in zip(a.ids, a.tokens)],
             [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
               else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]]
    out = []
    for side in sides:
        if b"".join(p for _, p in side) != whole.encode():
            return None
        at, spans = 0, []
        for i, p in side:
            spans.append((i, at, at + len(p)))
            at += len(p)
        out.append(spans)
    return out


def brute_align(texts, tokenizers):
    spans = [brute_spans(t, tokenizers) for t in texts]
    count, links = Counter(), []
    for s in spans:
        mine = []
        if s:
            a, b = s
            lo = 0
            for i, x, y in a:
                while b[lo][2] <= x:
                    lo += 1
                k = lo
                while k < len(b) and b[k][1] < y:
                    mine.append((i, b[k][0]))
                    k += 1
        links.append(mine)
        count.update(mine)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for s, mine in zip(spans, links):
        if not s:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        both = {y for _, _, y in s[0]} & {y for _, _, y in s[1]}
        groups, cur = [], ([], [])
        todo = sorted([(y, 0, i) for i, _, y in s[0]] + [(y, 1, i) for i, _, y in s[1]], key=lambda z: z[0])
        for n, (y, side, i) in enumerate(todo):
            cur[side].append(str(i))
            if y in both and (n + 1 == len(todo) or todo[n + 1][0] > y):
                groups.append(",".join(cur[0]) + "|" + ",".join(cur[1]))
                cur = ([], [])
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((len(s[0]), len(s[1]), len(groups), len(mine), sum(count[x] == best[x[1]] for x in mine),
                    sum(count[x] for x in mine), sha))
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check_align(got, ids, texts, tokenizers):
    want = Counter(zip(ids, brute_align(texts, tokenizers)))
    assert Counter((r.doc_id, tuple(r[c] for c in NAMES)) for r in got) == want


ODD = [None, "", " ", "a", "a  b  ", "\n\t x", "<|endoftext|>", "</s><s>[INST]", "▁literal", "x▁", "é ü ﬁ Å", "日本語 テキスト",
       "🙂🙃 ok", "\x00\x01 b", "it's we'll   DON'T", "a" * 3000, "  ".join(["ab c"] * 40), "e\u0301 \u0301x"]


def test_align_query(spark, tokenizers):
    docs = Q.table(spark, SMOKE, "documents").collect()
    check_align(Q.op12(spark, SMOKE).collect(), [d.doc_id for d in docs], [d.text for d in docs], tokenizers)


@pytest.mark.parametrize("hot", [1 << 17, 40, 0])
def test_align_odd_rows(spark, files, tokenizers, hot):
    r = random.Random(1)
    texts = ODD + ODD[3:5] + ["".join(r.choice(["a", "the", " ", "  ", "é", "🙂", "\n", "1", "ly", "'s"])
                                      for _ in range(r.randint(1, 60))) for _ in range(60)]
    ids = [None, 7, 7, *range(3, len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, texts, ids)), "doc_id long, text string, pairs string, row long")
    check_align(align.align(df.repartition(3), *files, hot=hot).collect(), ids, texts, tokenizers)
    assert align.align(df.limit(0), *files, hot=hot).count() == 0


def test_align_long_texts(spark, files, tokenizers):
    r = random.Random(3)
    words = ["the", "of", "naïve", "x1", "running", "(a)", "\n", " ", "--", "don't", "ﬁn", "日本"]
    long = " ".join(r.choice(words) for _ in range(150_000))
    texts = [long, long[:400_000] + " ▁ bad", "short one", "q" * 300_000]
    assert len(align.Aligner(*[files[0], files[1], files[2]]).pieces(long)) > 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_align(align.align(df, *files).collect(), range(4), texts, tokenizers)


def test_overlaps_and_groups_by_brute_force():
    import numpy as np
    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 12)
        cut = lambda: np.array(sorted({n, *[r.randint(1, n) for _ in range(r.randint(0, 8))]}))
        a, b = cut(), cut()
        spans = lambda e: list(zip([0, *e[:-1]], e))
        want = [(i, j) for i, (x, y) in enumerate(spans(a)) for j, (u, v) in enumerate(spans(b)) if x < v and u < y]
        assert list(zip(*map(list, align.overlaps(a, b)))) == want
        both = sorted(set(a) & set(b))
        ga, gb = align.coalesce(a, b)
        assert [sum(c < e for c in both) for e in a] == list(ga) and [sum(c < e for c in both) for e in b] == list(gb)


# --- resampling --------------------------------------------------------------

def brute_resample(docs, target, buckets=10_000, least=20, share=25, seed=7):
    def feats(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return w, [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]
    all_docs = [(i, *feats(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in all_docs for b in f), Counter(b for x in target for b in feats(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets))))
    out, can = [], []
    for i, w, f in all_docs:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(w) >= least:
            can.append(out[-1])
    can.sort(key=lambda x: (-x[3], math.inf if x[0] is None else x[0], x[1], x[2]))
    for k, x in enumerate(can[:share * len(can) // 100]):
        x[4] = k + 1
    return Counter(map(tuple, out))


def as_rows(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect())


def test_resample_query(spark):
    docs = [(d.doc_id, d.text) for d in Q.table(spark, SMOKE, "documents").collect()]
    target = [b.text for b in Q.table(spark, SMOKE, "benchmark").collect()]
    got = as_rows(Q.op13(spark, SMOKE))
    assert got == brute_resample(docs, target)
    assert sum(r[4] is not None for r in got) > 20


def test_resample_odd_rows(spark):
    r = random.Random(6)
    texts = [None, "", " -- ", "One", "É É two-two", "a\x00b", "x" * 50_000, "日本 日本", "{curly}~tilde^"]
    texts += [" ".join(r.choice(["Ab", "c", "d9", "é", "-", "日本"]) for _ in range(r.randint(1, 60))) for _ in range(150)]
    texts += ["a b c d e " * 10] * 40 + ["the " * 100_000]
    docs = [(i // 2 if i % 5 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, t, i) for i, t in docs], "doc_id long, text string, weight string, pos long")
    target = spark.createDataFrame([("c d9 c d9 é", "x"), (None, "y")], "text string, score string")
    got = as_rows(resample.resample(df.repartition(4), target))
    assert got == brute_resample(docs, ["c d9 c d9 é", None])
    assert as_rows(resample.resample(df, target.limit(0))) == brute_resample(docs, [])
    assert resample.resample(df.limit(0), target).count() == 0
    assert as_rows(resample.resample(df, target, buckets=7, min_words=5, share=50, seed=3)) == \
        brute_resample(docs, ["c d9 c d9 é", None], 7, 5, 50, 3)
