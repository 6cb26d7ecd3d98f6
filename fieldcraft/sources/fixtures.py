"""Map the driver's tables onto the interaction / ad / user data model.

* ``log``  - one row per interaction: ``row_id, uid, aid, label, split, fold``
             from ``events`` (purchase = positive).
* ``ad``   - ad dimension keyed by ``aid`` from ``part``.
* ``usr``  - user dimension keyed by ``uid`` from ``customer``; ``kw1`` is a
             multi-valued cell (space separated tokens) derived from the user's
             orders, ``'-1'`` when empty.
* ``merged`` - ``log`` inner-joined to both dimensions.

The same tables are written as SQL in ``fieldcraft.plans.oracle_base``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (shared with the SQL oracle).
TRAIN_BELOW = 7      # row_id % 10 < 7  -> train
VALID_BELOW = 9      # row_id % 10 < 9  -> valid, else test
N_FOLDS = 5          # fold = row_id % 5
KW_MOD = 97          # kw1 token = o_orderkey % 97
MISSING_CELL = "-1"  # empty multi-valued cell

SINGLE_FIELDS = ["campaignId", "advertiserId", "creativeSize", "lbs", "gender", "ability"]
MULTI_FIELDS = ["adkw", "kw1"]
USER_FIELDS = ["lbs", "gender", "ability", "kw1"]
AD_FIELDS = ["campaignId", "advertiserId", "creativeSize", "adkw"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a fact table that arrives in fewer splits than the
    session's parallelism (one small file is one task for every stage up to
    the first shuffle). A large input already has more splits than cores and
    is returned untouched; the check is planning only."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par, key)
    return df


def log(spark: SparkSession, sf_dir: str, extra: tuple = ()) -> DataFrame:
    ev = spread(table(spark, sf_dir, "events"), "event_id")
    rid = F.col("event_id")
    return ev.select(
        rid.alias("row_id"),
        F.col("user_id").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("aid"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
        F.when(rid % 10 < TRAIN_BELOW, "train")
         .when(rid % 10 < VALID_BELOW, "valid").otherwise("test").alias("split"),
        (rid % N_FOLDS).alias("fold"),
        *extra,
    )


def ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("aid"),
        F.col("p_brand").alias("campaignId"),
        F.col("p_type").alias("advertiserId"),
        F.col("p_size").alias("creativeSize"),
        F.col("p_name").alias("adkw"),
    )


def usr(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = spread(table(spark, sf_dir, "orders"), "o_custkey")  # the group-by below reuses this partitioning
    # one token per order, in order-key order
    kw = (o.groupBy("o_custkey")
           .agg(F.sort_array(F.collect_list(
               F.struct("o_orderkey", (F.col("o_orderkey") % KW_MOD).alias("t")))).alias("s"))
           .select(F.col("o_custkey"),
                   F.array_join(F.transform("s", lambda x: x["t"].cast("string")), " ").alias("kw1")))
    return (c.join(kw, c.c_custkey == kw.o_custkey, "left")
             .select(F.col("c_custkey").alias("uid"),
                     F.col("c_nationkey").alias("lbs"),
                     F.col("c_mktsegment").alias("gender"),
                     F.floor(F.col("c_acctbal") / 1000).cast("int").alias("ability"),
                     F.when(F.col("c_custkey") % 10 == 0, F.lit(MISSING_CELL))
                      .otherwise(F.coalesce("kw1", F.lit(MISSING_CELL))).alias("kw1")))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction log inner-joined with both dimensions."""
    return log(spark, sf_dir).join(ad(spark, sf_dir), "aid").join(usr(spark, sf_dir), "uid")


MODELS = ["a", "b", "c"]


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deterministic model scores per interaction row, long form
    ``(model, row_id, aid, uid, label, split, fold, score)``: ``a`` has many
    ties, ``b`` follows the event value, ``c`` is coarse."""
    base = log(spark, sf_dir, extra=("value",))  # same scan, no self-join
    scores = F.array(
        F.struct(F.lit("a").alias("model"), ((F.col("row_id") * 7919) % 1000 / F.lit(1000.0)).alias("score")),
        F.struct(F.lit("b").alias("model"), F.least(F.col("value") / F.lit(500.0), F.lit(1.0)).alias("score")),
        F.struct(F.lit("c").alias("model"),
                 ((F.col("uid") % 13 + F.col("aid") % 7) / F.lit(20.0)).alias("score")))
    return (base.select("row_id", "aid", "uid", "label", "split", "fold", F.explode(scores).alias("s"))
                .select("s.model", "row_id", "aid", "uid", "label", "split", "fold", "s.score"))
