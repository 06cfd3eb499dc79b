"""Category numbers from written tables: no list of labels on the driver, however many values a column has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.prefix import numbered
from clickloom.operators.trees import with_category
from clickloom.session import materialize


def dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A written table (column, value, n, slot): slots count from 0 by falling frequency, then by value. One pass for all columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = train.select(F.explode(pairs).alias("_p")).select("_p.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    placed = numbered(counts, F.col("column"), F.desc("n"), F.col("value"))
    first = placed.groupBy("column").agg(F.min("position").alias("_first"))
    return materialize(placed.join(first, "column").select("column", "value", "n", (F.col("position") - F.col("_first")).alias("slot")), "dictionary")


class CategorySlots(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a dictionary of its input columns."""

    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols))

    def _fit(self, dataset: DataFrame) -> CategorySlotsModel:
        return CategorySlotsModel(self.getInputCols(), self.getOutputCols(), dictionary(dataset, self.getInputCols()))


class CategorySlotsModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """Adds the slot of each column's value; null and unseen values get the number of slots."""

    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), table: DataFrame | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols))
        self.table = table
        self.sizes = dict(table.groupBy("column").count().collect()) if table is not None else {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for source, target in zip(self.getInputCols(), self.getOutputCols()):
            known = self.table.where(F.col("column") == source).select("column", "value", F.col("slot").cast("double").alias("slot"))
            dataset = with_category(dataset, known, "slot", [source], "_slot_of", float(self.sizes.get(source, 0)))
            dataset = dataset.withColumnRenamed(f"{source}_slot_of", target)
        return dataset

    def write(self) -> MLWriter:
        return _SlotsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SlotsReader(cls)


class _SlotsWriter(MLWriter):
    def __init__(self, model: CategorySlotsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        self.model.table.write.parquet(f"{path}/table")


class _SlotsReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategorySlotsModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        params = metadata["paramMap"]
        model = self.cls(params["inputCols"], params["outputCols"], spark.read.parquet(f"{path}/table"))
        model._resetUid(metadata["uid"])
        return model
