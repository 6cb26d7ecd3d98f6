"""Embedding-table queries (N01-N07). The weights table is ``embeddings``
(all dimensions); a (field, value) maps to row ``pmod(value*31 + slot, n)``.
Vector results are reported per row (or row and field pair) as the sum of
their elements, the sum of squares and the sum of elements times positions, so
one row per vector still tells a changed, reordered or transposed one; unit
tests compare small vectors element by element."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcraft.operators import embed as N
from fieldcraft.plans.common import is_train, merged, round_doubles
from fieldcraft.plans.registry import register
from fieldcraft.sources import fixtures as fx

FM_FIELDS = ["aid", "lbs", "ability", "creativeSize"]
PAIR_FIELDS = ["aid", "lbs", "ability"]


def _emb(spark, d):
    w = N.weights(fx.table(spark, d, "embeddings"))
    return w, w.count()


def _pmod(expr, slot):
    return f"(((CAST({expr} AS BIGINT) * 31 + {slot}) % ne.n) + ne.n) % ne.n"


BASE = """
, ne AS (SELECT count(*) AS n FROM embeddings),
el AS (SELECT vec_id, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""


def _rv(fields):
    rf = " UNION ALL ".join(
        f"SELECT row_id, {i} AS fno, '{f}' AS fname, {_pmod(f, i)} AS vid FROM m, ne" for i, f in enumerate(fields))
    return BASE + f""",
rf AS ({rf}),
rv AS (SELECT rf.row_id, rf.fno, rf.fname, el.d, el.x FROM rf JOIN el ON el.vec_id = rf.vid)"""


# ------------------------------------------------------------------ N02
@register("fm_second_order", sql=_rv(FM_FIELDS) + """,
so AS (SELECT row_id, d, 0.5 * (sum(x) * sum(x) - sum(x * x)) AS v FROM rv GROUP BY row_id, d)
SELECT row_id, round(sum(v), 6) AS vsum, round(sum(v * v), 6) AS vsq, round(sum(v * (d + 1)), 6) AS vpos FROM so GROUP BY row_id
""")
def fm_second_order(spark, d):
    emb, n = _emb(spark, d)
    out = N.fm_interaction(merged(spark, d), emb, FM_FIELDS, n)
    return round_doubles(out.select("row_id", *N.summarize(F.col("fm"))))


# ------------------------------------------------------------------ N03 / N04 / N07
PAIRS_SQL = _rv(PAIR_FIELDS) + """,
pj AS (SELECT a.row_id, a.fname || '_' || b.fname AS pair, a.d, a.x AS xa, b.x AS xb
       FROM rv a JOIN rv b ON a.row_id = b.row_id AND a.d = b.d AND a.fno < b.fno)"""


def _pairwise(spark, d, op):
    emb, n = _emb(spark, d)
    return round_doubles(N.pairwise_sums(merged(spark, d), emb, PAIR_FIELDS, n, op))


@register("pairwise_hadamard", sql=PAIRS_SQL + """
SELECT row_id, pair, round(sum(xa * xb), 6) AS vsum, round(sum(xa * xb * xa * xb), 6) AS vsq,
  round(sum(xa * xb * (d + 1)), 6) AS vpos FROM pj GROUP BY ALL
""")
def pairwise_hadamard(spark, d):
    return _pairwise(spark, d, N.hadamard_rows)


@register("pairwise_outer", sql=PAIRS_SQL + """
SELECT row_id, pair, round(sum(xa) * sum(xb), 6) AS vsum, round(sum(xa * xa) * sum(xb * xb), 6) AS vsq,
  round(count(*) * sum(d * xa) * sum(xb) + sum(xa) * sum((d + 1) * xb), 6) AS vpos
FROM pj GROUP BY ALL
""")
def pairwise_outer(spark, d):
    return _pairwise(spark, d, N.outer_rows)


@register("pair_diff", sql=PAIRS_SQL + """
SELECT row_id, pair, round(2 * sum(xa), 6) AS vsum,
       round(sum(xa * xa) + sum((xa - xb) * (xa - xb)) + sum(xb * xb), 6) AS vsq,
  round(sum((d + 1) * xa + (dd + d + 1) * (xa - xb) + (2 * dd + d + 1) * xb), 6) AS vpos
FROM pj, (SELECT max(len(embedding)) AS dd FROM embeddings) GROUP BY row_id, pair
""")
def pair_diff(spark, d):
    return _pairwise(spark, d, N.pair_diff_rows)


# ------------------------------------------------------------------ N05
def _ffm_sql():
    nf = len(PAIR_FIELDS)
    rf = " UNION ALL ".join(
        f"SELECT row_id, {i} AS i, {k} AS k, {_pmod(f, i * nf + k)} AS vid FROM m, ne"
        for i, f in enumerate(PAIR_FIELDS) for k in range(nf))
    return BASE + f""",
rf AS ({rf}),
rv AS (SELECT rf.row_id, rf.i, rf.k, el.d, el.x FROM rf JOIN el ON el.vec_id = rf.vid),
pr AS (SELECT a.row_id, a.d, sum(a.x * b.x) AS v FROM rv a JOIN rv b
       ON a.row_id = b.row_id AND a.d = b.d AND a.i = b.k AND a.k = b.i AND a.i < a.k GROUP BY a.row_id, a.d)
SELECT row_id, round(sum(v), 6) AS vsum, round(sum(v * v), 6) AS vsq, round(sum(v * (d + 1)), 6) AS vpos FROM pr GROUP BY row_id
"""


def _ffm_fields_sql():
    head = _ffm_sql().split("pr AS (")[0]
    return head + """pr AS (SELECT a.row_id, a.i, a.d, sum(a.x * b.x) AS v FROM rv a JOIN rv b
       ON a.row_id = b.row_id AND a.d = b.d AND a.i = b.k AND a.k = b.i AND a.i <> a.k GROUP BY a.row_id, a.i, a.d)
SELECT row_id, CAST(i AS INT) AS field_no, round(sum(v), 6) AS vsum, round(sum(v * v), 6) AS vsq,
  round(sum(v * (d + 1)), 6) AS vpos FROM pr GROUP BY row_id, i
"""


@register("ffm_interaction", sql=_ffm_sql())
def ffm_interaction(spark, d):
    emb, n = _emb(spark, d)
    out = N.ffm_interaction(merged(spark, d), emb, PAIR_FIELDS, n)
    return round_doubles(out.select("row_id", *N.summarize(F.col("ffm"))))


@register("ffm_per_field", sql=_ffm_fields_sql())
def ffm_per_field(spark, d):
    emb, n = _emb(spark, d)
    out = N.ffm_interaction(merged(spark, d), emb, PAIR_FIELDS, n, per_field=True)
    long = out.select("row_id", F.posexplode(F.array(*[f"ffm_{f}" for f in PAIR_FIELDS])).alias("field_no", "v"))
    return round_doubles(long.select("row_id", "field_no", *N.summarize(F.col("v"))))


# ------------------------------------------------------------------ N02, first order, by vocabulary
@register("fm_vocab_score", sql=BASE + """,
val AS (SELECT DISTINCT field, value FROM (
  SELECT 'advertiserId' AS field, advertiserId AS value FROM m WHERE split = 'train'
  UNION ALL SELECT 'gender', gender FROM m WHERE split = 'train')),
voc AS (SELECT field, value, (row_number() OVER (ORDER BY field, value) - 1) AS idx FROM val),
rf AS (SELECT row_id, 'advertiserId' AS field, advertiserId AS value FROM m UNION ALL SELECT row_id, 'gender', gender FROM m),
rv AS (SELECT rf.row_id, el.d, el.x FROM rf JOIN voc USING (field, value) JOIN el ON el.vec_id = voc.idx),
so AS (SELECT row_id, d, sum(CASE WHEN d = 0 THEN x ELSE 0 END) AS w, 0.5 * (sum(x) * sum(x) - sum(x * x)) AS v FROM rv GROUP BY row_id, d)
SELECT m.row_id, round(coalesce(sum(w), 0), 6) AS first_order, round(coalesce(sum(v), 0), 6) AS second_order
FROM m LEFT JOIN so USING (row_id) GROUP BY m.row_id
""")
def fm_vocab_score(spark, d):
    """Linear term (first element as the weight) and summed second-order term,
    with vectors found by the index of a training vocabulary."""
    from fieldcraft.functions.ordered import dense_index
    emb, _ = _emb(spark, d)
    m, fields = merged(spark, d), ["advertiserId", "gender"]
    known = m.filter(is_train()).select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("e")).select("e.*")
    vocab = dense_index(known, ["field", "value"], "idx")
    wide = N.lookup_fields(m, emb, fields, vocab=vocab)
    vecs = [F.coalesce(F.col(f"v_{f}"), F.array_repeat(F.lit(0.0), len(emb.first()["vec"]))) for f in fields]
    total = F.aggregate(N.fm_second_order(vecs), F.lit(0.0), lambda a, x: a + x)
    return round_doubles(wide.select("row_id", N.fm_first_order([F.get(f"v_{f}", 0) for f in fields]).alias("first_order"),
                                     total.alias("second_order")))


# ------------------------------------------------------------------ N01
@register("emb_mean_pool", sql=BASE + f""",
ww AS (SELECT max(CASE WHEN kw1 = '-1' THEN 0 ELSE len(string_split(kw1, ' ')) END) AS w FROM m),
mt AS (SELECT row_id, unnest(string_split(kw1, ' ')) AS tok FROM m WHERE kw1 <> '-1'),
mv AS (SELECT mt.row_id, {_pmod('mt.tok', 0)} AS vid FROM mt, ne),
pv AS (SELECT mv.row_id, el.d, sum(el.x) AS s FROM mv JOIN el ON el.vec_id = mv.vid GROUP BY ALL),
pm AS (SELECT pv.row_id, pv.d, pv.s / ww.w AS a FROM pv CROSS JOIN ww)
SELECT m.row_id, round(coalesce(sum(pm.a), 0), 6) AS vsum, round(coalesce(sum(pm.a * pm.a), 0), 6) AS vsq,
  round(coalesce(sum(pm.a * (pm.d + 1)), 0), 6) AS vpos
FROM m LEFT JOIN pm USING (row_id) GROUP BY m.row_id
""")
def emb_mean_pool(spark, d):
    emb, n = _emb(spark, d)
    out = N.mean_pool(merged(spark, d), emb, "kw1", n)
    return round_doubles(out.select("row_id", *N.summarize(F.col("pooled"))))


# ------------------------------------------------------------------ N06
@register("attention_pool", sql=BASE + f""",
qi AS (SELECT m.row_id, {_pmod('m.aid', 0)} AS vid FROM m, ne),
qv AS (SELECT qi.row_id, el.d, el.x FROM qi JOIN el ON el.vec_id = qi.vid),
kt AS (SELECT row_id, unnest(range(len(string_split(kw1, ' ')))) AS t, unnest(string_split(kw1, ' ')) AS tok
       FROM m WHERE kw1 <> '-1'),
ki AS (SELECT kt.row_id, kt.t, {_pmod('kt.tok', 1)} AS vid FROM kt, ne),
kv AS (SELECT ki.row_id, ki.t, el.d, el.x FROM ki JOIN el ON el.vec_id = ki.vid),
dm AS (SELECT sqrt(max(len(embedding))) AS sd FROM embeddings),
sc AS (SELECT kv.row_id, kv.t, sum(kv.x * qv.x) AS s0 FROM kv JOIN qv ON qv.row_id = kv.row_id AND qv.d = kv.d
       GROUP BY kv.row_id, kv.t),
wt AS (SELECT row_id, t, exp(s0 / dm.sd - max(s0 / dm.sd) OVER (PARTITION BY row_id)) AS w FROM sc, dm),
att AS (SELECT kv.row_id, kv.d, sum(wt.w * kv.x) / sum(wt.w) AS a FROM kv JOIN wt USING (row_id, t)
        GROUP BY kv.row_id, kv.d)
SELECT m.row_id, round(coalesce(sum(att.a), 0), 6) AS vsum, round(coalesce(sum(att.a * att.a), 0), 6) AS vsq,
  round(coalesce(sum(att.a * (att.d + 1)), 0), 6) AS vpos
FROM m LEFT JOIN att USING (row_id) GROUP BY m.row_id
""")
def attention_pool(spark, d):
    emb, n = _emb(spark, d)
    out = N.attention_pool(merged(spark, d), emb, "aid", "kw1", n)
    return round_doubles(out.select("row_id", *N.summarize(F.col("att"))))
