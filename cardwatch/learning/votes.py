"""The last stage of a forest that was grown in groups of trees."""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Votes(Transformer, HasInputCols, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable,
            DefaultParamsWritable):
    """Adds up the votes per class of several forests, as one forest of all their trees does; works on a stream too."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = [vector_to_array(c) for c in self.getInputCols()]
        votes = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), columns)
        summed = dataset.withColumn("_votes", votes).drop(*self.getInputCols())
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        shares = summed.withColumn("_shares", F.transform("_votes", lambda x: F.when(total > 0, x / total).otherwise(x)))
        return shares.withColumns({
            self.getRawPredictionCol(): array_to_vector("_votes"), self.getProbabilityCol(): array_to_vector("_shares"),
            # the first of the largest
            self.getPredictionCol(): (F.array_position("_shares", F.array_max("_shares")) - 1).cast("double"),
        }).drop("_votes", "_shares")
