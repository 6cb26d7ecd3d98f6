"""Fit once, transform later: ``pyspark.ml`` forms of the fitted operators (E07,
E08/E09, E11/E12, E14, T01, T03).

A fitted model holds its parameters and its state as tables (a vocabulary, counts
per key, edges). ``save`` writes the parameters as usual and every table as Parquet;
``load`` reads them in any later session, alone or inside a ``PipelineModel``.
Transforming equals the plain operator, whose functions do the work.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.numeric import digitize_right
from fieldcraft.functions.text import tokens_ws
from fieldcraft.operators import encode as E
from fieldcraft.operators import target as T
from fieldcraft.operators.counts import token_vocab
from fieldcraft.operators.encode import FieldSpec
from fieldcraft.operators.info import PERCENTILE_EDGES, percentile_edges
from fieldcraft.session import broadcast_if_small, materialize


# ------------------------------------------------------------------ models with tables
class TableWriter(MLWriter):
    """Parameters as usual, every state table as Parquet."""

    def __init__(self, instance: TableModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc,
                                         extraMetadata={"tables": sorted(self.instance.tables)})
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class TableReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        model = self.cls({n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in meta["tables"]})
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class TableModel(Model, MLWritable, MLReadable):
    """A fitted operator: parameters and state tables."""

    def __init__(self, tables: dict[str, DataFrame] | None = None) -> None:
        super().__init__()
        self.tables = dict(tables or {})

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


class _Fitted(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Sets keyword arguments as parameters; ``_fit`` copies them to the model."""

    def _set_given(self, given: dict) -> None:
        self._set(**{k: v for k, v in given.items() if v is not None})

    def _model(self, cls: type, **tables: DataFrame) -> TableModel:
        return self._copyValues(cls({n: materialize(t, n) for n, t in tables.items()}))


def _p(name: str, doc: str, convert=None) -> Param:
    return Param(Params._dummy(), name, doc, convert) if convert else Param(Params._dummy(), name, doc)


# ------------------------------------------------------------------ E07
class _TokenParams(Params):
    inputCol = _p("inputCol", "multi-valued cell, split at white space", TypeConverters.toString)
    outputCol = _p("outputCol", "array of vocabulary indices in cell order", TypeConverters.toString)
    orderCol = _p("orderCol", "row order that decides which token is seen first", TypeConverters.toString)
    threshold = _p("threshold", "least number of occurrences", TypeConverters.toInt)
    start = _p("start", "index of the first token", TypeConverters.toInt)
    unknown = _p("unknown", "index of tokens outside the vocabulary", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(orderCol="row_id", threshold=100, start=2, unknown=1)


class TokenIndexer(_Fitted, _TokenParams):
    """Vocabulary of a cell's tokens in order of first appearance."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, orderCol=None, threshold=None, start=None, unknown=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TokenIndexerModel:
        get = self.getOrDefault
        vocab = token_vocab(dataset, get("inputCol"), get("orderCol"), get("threshold"), get("start"))
        return self._model(TokenIndexerModel, vocabulary=vocab)


class TokenIndexerModel(TableModel, _TokenParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Needs one row per value of the order column; rows with equal ones share
        their cell's result only if their cells are equal."""
        get = self.getOrDefault
        cell, order = get("inputCol"), get("orderCol")
        vocab = self.tables["vocabulary"].select("token", "idx")
        vocab = broadcast_if_small(vocab, vocab.count(), 64)
        toks = (dataset.select(F.col(order).alias("_o"), F.col(cell).alias("_c")).distinct()
                .select("_o", "_c", F.posexplode(tokens_ws("_c")).alias("_p", "token")).join(vocab, "token", "left"))
        lists = toks.groupBy("_o", "_c").agg(F.sort_array(F.collect_list(F.struct(
            "_p", F.coalesce("idx", F.lit(get("unknown"))).alias("i")))).alias("_l"))
        found = F.coalesce(F.transform("_l", lambda e: e["i"]), F.array().cast("array<int>"))
        return (dataset.join(lists, F.col(order).eqNullSafe(F.col("_o")) & F.col(cell).eqNullSafe(F.col("_c")), "left")
                .withColumn(get("outputCol"), found).drop("_o", "_c", "_l"))


# ------------------------------------------------------------------ E08/E09, E11/E12
class _FieldParams(Params):
    fields = _p("fields", "field specifications as JSON (see with_fields)", TypeConverters.toString)
    rowCol = _p("rowCol", "unique row id", TypeConverters.toString)
    labelCol = _p("labelCol", "label printed in front of a line", TypeConverters.toString)
    threshold = _p("threshold", "least count of a value", TypeConverters.toInt)
    missing = _p("missing", "marker of an empty cell", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(rowCol="row_id", labelCol="label", threshold=100, missing="-1")

    def specs(self) -> list[FieldSpec]:
        return [FieldSpec(**f) for f in json.loads(self.getOrDefault("fields"))]


def with_fields(specs) -> str:
    """Field specifications as the ``fields`` parameter."""
    return json.dumps([s.__dict__ for s in specs])


class FrequencyFFMEncoder(_Fitted, _FieldParams):
    """FFM lines by a vocabulary in order of frequency."""

    @keyword_only
    def __init__(self, *, fields=None, rowCol=None, labelCol=None, threshold=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyFFMModel:
        counts = E.value_counts_all(dataset, self.specs())
        return self._model(FrequencyFFMModel, vocabulary=E.frequency_vocab(counts, self.specs(),
                                                                           self.getOrDefault("threshold")))


class FrequencyFFMModel(TableModel, _FieldParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``row id, line``."""
        return E.ffm_lines(dataset, self.specs(), self.tables["vocabulary"], self.getOrDefault("rowCol"),
                           self.getOrDefault("labelCol"))


class SortedFFMEncoder(_Fitted, _FieldParams):
    """FFM lines by a vocabulary in order of the values."""

    @keyword_only
    def __init__(self, *, fields=None, rowCol=None, missing=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SortedFFMModel:
        return self._model(SortedFFMModel, vocabulary=E.sorted_vocab(dataset, self.specs(), self.getOrDefault("missing")))


class SortedFFMModel(TableModel, _FieldParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``row id, line``."""
        return E.sorted_encode(dataset, self.specs(), self.tables["vocabulary"], self.getOrDefault("rowCol"),
                               self.getOrDefault("missing"))


# ------------------------------------------------------------------ T01
class _RateParams(Params):
    keyCols = _p("keyCols", "columns of the key", TypeConverters.toListString)
    outputCol = _p("outputCol", "smoothed rate", TypeConverters.toString)
    labelCol = _p("labelCol", "label, positive above zero", TypeConverters.toString)
    alpha = _p("alpha", "prior successes", TypeConverters.toFloat)
    beta = _p("beta", "prior failures", TypeConverters.toFloat)
    fitPrior = _p("fitPrior", "estimate alpha and beta from the keys", TypeConverters.toBoolean)
    scale = _p("scale", "factor of the rate", TypeConverters.toFloat)
    digits = _p("digits", "decimals, rounded half to even", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(labelCol="label", alpha=1.0, beta=1.0, fitPrior=False, scale=100.0, digits=8)


class SmoothedRate(_Fitted, _RateParams):
    """Rate of positives per key, smoothed by a Beta prior."""

    @keyword_only
    def __init__(self, *, keyCols=None, outputCol=None, labelCol=None, alpha=None, beta=None, fitPrior=None,
                 scale=None, digits=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SmoothedRateModel:
        get = self.getOrDefault
        stats = materialize(T.rate_counts(dataset, get("keyCols"), get("labelCol")), "counts")
        a, b = get("alpha"), get("beta")
        if get("fitPrior"):
            a, b = T.rate_prior(stats, a, b)
        self_prior = dataset.sparkSession.createDataFrame([(float(a), float(b))], "alpha double, beta double")
        return self._model(SmoothedRateModel, counts=stats, prior=self_prior)


class SmoothedRateModel(TableModel, _RateParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get, prior = self.getOrDefault, self.tables["prior"].first()
        return T.apply_rate(dataset, self.tables["counts"], get("keyCols"), get("outputCol"), prior["alpha"],
                            prior["beta"], get("scale"), get("digits"))


# ------------------------------------------------------------------ T03
class _FoldParams(Params):
    pairs = _p("pairs", "crossed columns as JSON, e.g. [[\"aid\", \"age\"]]", TypeConverters.toString)
    foldCol = _p("foldCol", "fold of a training row", TypeConverters.toString)
    trainCol = _p("trainCol", "true for the rows that the model was fitted on; others use all folds",
                  TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(foldCol="fold", trainCol="is_train")


class OutOfFoldRate(_Fitted, _FoldParams, _RateParams):
    """Smoothed rates of crossed keys, each training row without its fold."""

    @keyword_only
    def __init__(self, *, pairs=None, foldCol=None, trainCol=None, labelCol=None, alpha=None, beta=None, fitPrior=None,
                 scale=None, digits=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OutOfFoldRateModel:
        get = self.getOrDefault
        stats, priors = T.oof_rate_state(dataset, json.loads(get("pairs")), F.col(get("trainCol")), get("foldCol"),
                                         get("labelCol"), get("alpha"), get("beta"), get("fitPrior"))
        tables = {"outside": stats} | ({"priors": priors} if priors is not None else {})
        return self._copyValues(OutOfFoldRateModel(tables))


class OutOfFoldRateModel(TableModel, _FoldParams, _RateParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The rows with one ``<a>_<b>_stas`` column per pair."""
        get = self.getOrDefault
        return T.apply_oof_rate(dataset, self.tables["outside"], self.tables.get("priors"), json.loads(get("pairs")),
                                list(dataset.columns), F.col(get("trainCol")), get("foldCol"), get("alpha"),
                                get("beta"), get("scale"), get("digits"))


# ------------------------------------------------------------------ E14
class _BucketParams(Params):
    inputCols = _p("inputCols", "numeric columns", TypeConverters.toListString)
    percents = _p("percents", "percentiles that are the edges", TypeConverters.toListFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(percents=[float(p) for p in PERCENTILE_EDGES])


class PercentileBuckets(_Fitted, _BucketParams):
    """Right-closed buckets between exact percentiles."""

    @keyword_only
    def __init__(self, *, inputCols=None, percents=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PercentileBucketsModel:
        edges = percentile_edges(dataset, self.getOrDefault("inputCols"), self.getOrDefault("percents"))
        rows = [(c, i, None if v is None else float(v)) for c, vs in edges.items() for i, v in enumerate(vs)]
        return self._model(PercentileBucketsModel,
                           edges=dataset.sparkSession.createDataFrame(rows, "col string, at int, edge double"))


class PercentileBucketsModel(TableModel, _BucketParams):
    def __init__(self, tables=None):
        super().__init__(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The rows with every column replaced by its bucket."""
        edges: dict[str, list] = {}
        for r in self.tables["edges"].orderBy("col", "at").collect():  # a few edges per column
            edges.setdefault(r["col"], []).append(r["edge"])
        for c in self.getOrDefault("inputCols"):
            dataset = dataset.withColumn(c, digitize_right(F.col(c), edges[c]))
        return dataset
