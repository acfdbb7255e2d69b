"""D1 column_medians, K3 impute_features (a ``pyspark.ml`` Estimator/Model pair), K4 one_hot.

Imputation: 14 numerics -> double, null -> train median (midpoint-interpolated, nulls
skipped, all-null -> 0.0); 5 categoricals -> text, null -> "missing"; 5 booleans ->
0/1, null -> 0. Exactly the 24 feature columns are emitted, in order; the target and ids
never are. NaN is not null and is kept (``coalesce``, not ``fillna``).

Medians are exact, and found for all columns at once by counting digits (``selection``): no value is
shuffled or held in a buffer. They become literals in the transform, so scoring is a narrow projection
(no join, no shuffle).
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import FeatureError
from domus.operators.selection import medians


def column_medians(df: DataFrame, cols=C.NUMERIC_FEATURES, method: str = "ranked") -> dict[str, float]:
    """Exact median per column, nulls skipped, all-null -> 0.0. ``ranked`` is the only method."""
    if method != "ranked":
        raise FeatureError(f"there is no method {method!r} for medians")
    return medians(df, cols)


def impute_columns(medians: dict[str, float]) -> list[Column]:
    """K3 projection: the 24 feature columns with nulls filled, in feature order."""
    num = [F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))).alias(c)
           for c in C.NUMERIC_FEATURES]
    cat = [F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY)).alias(c)
           for c in C.CATEGORICAL_FEATURES]
    boo = [F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)).cast("tinyint").alias(c)
           for c in C.BOOL_FEATURES]
    return [*num, *cat, *boo]


def impute(df: DataFrame, medians: dict[str, float] | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """K3 transform; ``keep`` passes extra columns (keys, target) through after the features."""
    if not medians:
        raise FeatureError("the transformer is not fitted yet")
    return df.select(*impute_columns(medians), *keep)


class _ImputerParams(Params):
    targetCol = Param(Params._dummy(), "targetCol", "target column required at fit",
                      typeConverter=TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through after the features",
                     typeConverter=TypeConverters.toListString)
    medianMethod = Param(Params._dummy(), "medianMethod", "ranked",
                         typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(targetCol=C.TARGET, keepCols=[], medianMethod="ranked")


class ListingImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the medians of the numeric features."""

    @keyword_only
    def __init__(self, targetCol: str = C.TARGET, keepCols: list[str] | None = None,
                 medianMethod: str = "ranked"):
        super().__init__()
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "ListingImputerModel":
        target = self.getOrDefault(self.targetCol)
        if target not in dataset.columns:
            raise FeatureError(f"there is no column {target!r} to fit on")
        medians = column_medians(dataset, method=self.getOrDefault(self.medianMethod))
        model = ListingImputerModel(medians=json.dumps(medians),
                                    keepCols=self.getOrDefault(self.keepCols))
        return model


class ListingImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls and projects to the 24 features (+ keep columns)."""

    medians = Param(Params._dummy(), "medians", "JSON map column -> median",
                    typeConverter=TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through after the features",
                     typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, medians: str | None = None, keepCols: list[str] | None = None):
        super().__init__()
        self._setDefault(keepCols=[])
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def median_map(self) -> dict[str, float]:
        if not self.isDefined(self.medians):
            raise FeatureError("the transformer is not fitted yet")
        return json.loads(self.getOrDefault(self.medians))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keep = tuple(c for c in self.getOrDefault(self.keepCols) if c in dataset.columns)
        return impute(dataset, self.median_map(), keep)


def one_hot_stages(features_col: str = "features") -> list:
    """K4: categorical one-hot block first, then numerics and booleans, as one vector.

    ``StringIndexer(handleInvalid="keep", alphabetAsc)`` sends unseen categories to the
    extra last index, which ``OneHotEncoder(dropLast=True)`` drops — so an unseen
    category becomes the all-zero vector, as in ignore-unknown one-hot encoding.
    """
    idx_cols = [f"{c}__idx" for c in C.CATEGORICAL_FEATURES]
    ohe_cols = [f"{c}__ohe" for c in C.CATEGORICAL_FEATURES]
    indexer = StringIndexer(inputCols=list(C.CATEGORICAL_FEATURES), outputCols=idx_cols,
                            handleInvalid="keep", stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=idx_cols, outputCols=ohe_cols, dropLast=True,
                            handleInvalid="error")
    assembler = VectorAssembler(inputCols=[*ohe_cols, *C.NUMERIC_FEATURES, *C.BOOL_FEATURES],
                                outputCol=features_col)
    return [indexer, encoder, assembler]


def encoded_slots(train: DataFrame, cols=C.CATEGORICAL_FEATURES) -> DataFrame:
    """K4 table form: (column, category, idx, n): the slot of each category in its one-hot block, as the fitted encoder
    gives it to imputed rows, and the rows whose vector has a one there. One pass over the encoded rows."""
    model = Pipeline(stages=one_hot_stages()[:2]).fit(train)  # indexer and encoder
    labels = dict(zip(C.CATEGORICAL_FEATURES, model.stages[0].labelsArray, strict=True))
    ones = model.transform(train).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), vector_to_array(F.col(f"{c}__ohe")).alias("slots")) for c in cols])).alias("v"))
    counts = (ones.select("v.column", F.posexplode("v.slots").alias("idx", "one")).groupBy("column", "idx")
              .agg(F.sum("one").cast("long").alias("n")))
    names = train.sparkSession.createDataFrame([(c, k, name) for c in cols for k, name in enumerate(labels[c])],
                                               "column string, idx int, category string")
    return counts.join(names, ["column", "idx"]).select("column", "category", "n", F.col("idx").cast("long").alias("idx"))


def feature_pipeline(estimator, features_col: str = "features",
                     keep: tuple[str, ...] = (C.TARGET,)) -> Pipeline:
    """K3 + K4 + estimator as one ``Pipeline`` (fit on train only)."""
    return Pipeline(stages=[ListingImputer(keepCols=list(keep)), *one_hot_stages(features_col),
                            estimator])
