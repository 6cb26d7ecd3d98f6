"""Models with Spark ML (E03-E05, M01-M04, M07): feature assembly, logistic
regression, factorisation machine, gradient-boosted trees, parameter search.

Training runs on the executors, through MLlib but for the factorisation machine
(``operators.fm``); scoring is ``transform`` and the positive-class probability
is extracted with ``vector_to_array``.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import CountVectorizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.text import cell_tokens
from fieldcraft.operators.evaluate import exact_auc
from fieldcraft.operators.fm import FM
from fieldcraft.operators.search import run as tpe_run
from fieldcraft.session import materialize


#: the default of 2^18 would silently drop the rarest tokens
ALL_TOKENS = 2**31 - 1


def feature_pipeline(categorical: Sequence[str], multi: Sequence[str], numeric: Sequence[str],
                     min_df: float = 5.0, out: str = "features") -> list:
    """StringIndexer + OneHotEncoder per categorical column, CountVectorizer
    (bag of tokens, ``min_df``) per multi-valued token array ``<col>_tok``,
    numeric columns as they are, all stacked by VectorAssembler."""
    stages, cols = [], []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}_ix", outputCol=f"{c}_oh", handleInvalid="keep"))
        cols.append(f"{c}_oh")
    for c in multi:
        # no token above the threshold is left out, however many there are
        stages.append(CountVectorizer(inputCol=f"{c}_tok", outputCol=f"{c}_bow", minDF=min_df,
                                      vocabSize=ALL_TOKENS))
        cols.append(f"{c}_bow")
    stages.append(VectorAssembler(inputCols=cols + list(numeric), outputCol=out, handleInvalid="keep"))
    return stages


def with_tokens(df: DataFrame, multi: Sequence[str]) -> DataFrame:
    for c in multi:
        df = df.withColumn(f"{c}_tok", cell_tokens(c))
    return df


def positive_probability(pred: DataFrame, name: str = "score") -> DataFrame:
    return pred.withColumn(name, vector_to_array("probability")[1])


def assemble(train: DataFrame, rows: DataFrame, stages: list, keep: Sequence[str]) -> DataFrame:
    """``keep`` + ``features`` of ``rows``, fitted on ``train`` and written once,
    so no optimiser step or search candidate recomputes joins or encodings."""
    made = Pipeline(stages=stages).fit(train).transform(rows).select(*keep, "features")
    return materialize(made, "features")


#: bytes of binned rows (4 a feature) that one task of a tree fit holds and reads
TREE_TASK_BYTES = 256 << 20


def for_trees(rows: DataFrame, features: str = "features") -> DataFrame:
    """Assembled rows in as many partitions as keep the binned rows of each, which a
    tree fit holds and reads anew per level, below ``TREE_TASK_BYTES``. Sparse rows are
    small on disk, so few splits of a file may hold millions of them; a table that
    already has enough partitions is returned untouched."""
    first = rows.select(features).first()
    if first is None:
        return rows
    parts = -(-rows.count() * (4 * first[0].size + 64) // TREE_TASK_BYTES)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def fit_score(train: DataFrame, score_on: DataFrame, clf, keep: Sequence[str]) -> tuple[Model, DataFrame]:
    """Fit on assembled rows and score: ``keep`` + ``score``."""
    model = clf.fit(train)
    return model, positive_probability(model.transform(score_on)).select(*keep, "score")


def logistic(label: str = "label", weight: str | None = "w", **kw) -> LogisticRegression:
    """First-order model; positives weighted (weight column ``20*y + (1-y)``)."""
    return LogisticRegression(labelCol=label, featuresCol="features", weightCol=weight, **kw)


def add_weight(df: DataFrame, label: str = "label", pos_weight: float = 20.0, name: str = "w") -> DataFrame:
    return df.withColumn(name, F.when(F.col(label) > 0, F.lit(pos_weight)).otherwise(F.lit(1.0)))


def fm(factor_size: int = 4, step_size: float = 0.02, reg: float = 1e-6, max_iter: int = 100,
       label: str = "label", seed: int = 2018) -> FM:
    return FM(factor_size=factor_size, step_size=step_size, reg=reg, max_iter=max_iter, label=label, seed=seed)


def gbt(max_iter: int = 300, step: float = 0.05, subsample: float = 0.7, col_sample: str = "0.7",
        min_instances: int = 50, max_depth: int = 5, validation_col: str | None = None,
        label: str = "label", seed: int = 2018) -> GBTClassifier:
    """Gradient-boosted trees: ``max_depth`` 5 gives up to 32 leaves (the
    reference grows 31 leaves leaf-wise); early stopping on the validation
    rows flagged by ``validation_col``."""
    kw = dict(labelCol=label, featuresCol="features", maxIter=max_iter, stepSize=step,
              subsamplingRate=subsample, featureSubsetStrategy=col_sample,
              minInstancesPerNode=min_instances, maxDepth=max_depth, seed=seed)
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTClassifier(**kw)


#: fixed values of the search space: trees, step, row share, rows per leaf, leaves
SPACE = {
    "trees": [1000 * k + 1000 for k in range(10)],
    "step": [round(0.01 * k + 0.005, 3) for k in range(10)],
    "subsample": [round(0.1 * k + 0.7, 1) for k in range(4)],
    "min_instances": [10 * k + 5 for k in range(10)],
    "leaves": [21, 31],
}


def candidates(space: dict[str, list], evals: int = 4, seed: int = 2018) -> list[dict]:
    """``evals`` distinct draws from the space."""
    r, out = random.Random(seed), []
    while len(out) < evals:
        c = {k: r.choice(v) for k, v in space.items()}
        if c not in out:
            out.append(c)
    return out


def search(rows: DataFrame, train: str = "is_train", valid: str = "is_valid", label: str = "label",
           space: dict[str, list] | None = None, evals: int = 4, seed: int = 2018, parallel: int = 2) -> DataFrame:
    """Sequential search: Parzen proposals from the trials finished so far
    (``operators.search``), ``parallel`` boosters fitted at a time on the assembled
    training rows, each stopping early on the validation rows; one row per trial: its
    parameters, the number of trees kept and the exact AUC on training and validation
    rows. ``leaves`` l becomes depth ceil(log2(l))."""
    fit_on = for_trees(rows.filter(F.col(train) | F.col(valid)))
    seen: dict[tuple, tuple] = {}

    def evaluate(c: dict) -> float:
        clf = gbt(max_iter=c["trees"], step=c["step"], subsample=c["subsample"],
                  min_instances=c["min_instances"], max_depth=(c["leaves"] - 1).bit_length(),
                  validation_col=valid, label=label, seed=seed)
        model, pred = fit_score(fit_on, fit_on, clf, [train, valid, label])
        auc = {r[train]: r["auc"] for r in exact_auc(pred, label=label, group=[train]).collect()}
        seen[tuple(c.items())] = (model.getNumTrees, auc.get(True), auc.get(False))
        return auc.get(False)

    trials = tpe_run(evaluate, space or SPACE, evals, parallel, seed=seed)
    out = [(i, "; ".join(f"{k}={v}" for k, v in c.items()), *seen[tuple(c.items())]) for i, (c, _) in enumerate(trials)]
    return rows.sparkSession.createDataFrame(
        out, "candidate int, params string, trees int, train_auc double, auc double")
