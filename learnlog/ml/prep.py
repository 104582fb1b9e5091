"""Impute, standardize and one-hot encode, as a Spark ML pipeline."""

from collections.abc import Mapping

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog import schemas

NUMERIC = [
    "prior_question_elapsed_time",
    "user_interaction_count",
    "user_correctness",
    "content_correctness",
]
SCALED = [f"scaled_{name}" for name in NUMERIC]
FLAG = "prior_question_had_explanation"


class ImputeScale(
    Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable
):
    """Fill by the mean, then subtract it and divide by the population deviation.

    Spark's own scaler divides by the sample deviation. A constant column is
    left unscaled.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ImputeScaleModel":
        names = self.getInputCols()
        stats = [
            stat
            for name in names
            for stat in (
                F.avg(name),
                # Filled rows sit on the mean: they add to the count only.
                F.sqrt(F.var_pop(name) * F.count(name) / F.count("*")),
            )
        ]
        row = dataset.agg(*[s.alias(str(i)) for i, s in enumerate(stats)]).first()
        means = [float(row[2 * i] or 0.0) for i in range(len(names))]
        scales = [float(row[2 * i + 1] or 1.0) for i in range(len(names))]
        model = ImputeScaleModel()
        return model._set(
            inputCols=names, outputCols=self.getOutputCols(), means=means, scales=scales
        )


class ImputeScaleModel(
    Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable
):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "column deviations", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means, scales = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        columns = zip(self.getInputCols(), self.getOutputCols(), means, scales)
        return dataset.withColumns(
            {
                out: (F.coalesce(F.col(name).cast("double"), F.lit(mean)) - mean) / scale
                for name, out, mean, scale in columns
            }
        )


def _stages() -> list:
    return [
        ImputeScale(inputCols=NUMERIC, outputCols=SCALED),
        SQLTransformer(statement=f"select *, cast({FLAG} as string) as flag_text from __THIS__"),
        # An unseen value gets the extra slot, which the encoder then drops.
        StringIndexer(
            inputCol="flag_text",
            outputCol="flag_index",
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(inputCol="flag_index", outputCol="flag_one_hot", dropLast=True),
    ]


def preprocessor() -> Pipeline:
    return Pipeline(stages=_stages())


def pipeline(params: Mapping[str, float]) -> Pipeline:
    """The unfitted pipeline: preprocessing, one vector, boosted trees."""
    trees = GBTClassifier(featuresCol="prepared", labelCol=schemas.TARGET)
    trees._set(**dict(params))
    assembler = VectorAssembler(inputCols=[*SCALED, "flag_one_hot"], outputCol="prepared")
    return Pipeline(stages=[*_stages(), assembler, trees])


def unpack(prepared: DataFrame) -> DataFrame:
    """The preprocessed inputs as plain columns."""
    flags = vector_to_array("flag_one_hot")
    return prepared.select(
        "row_id",
        *SCALED,
        F.get(flags, F.lit(0)).cast("int").alias("explained_0"),
        F.get(flags, F.lit(1)).cast("int").alias("explained_1"),
    )
