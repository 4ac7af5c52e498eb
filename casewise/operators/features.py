"""Feature preparation, splits and samples."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def indexer(category: str, output: str) -> StringIndexer:
    """Index by falling frequency, ties alphabetical; unseen values get one extra index.

    The model holds every distinct value on the driver: it is for class labels and codes, not for keys.
    """
    return StringIndexer(
        inputCol=category, outputCol=output, handleInvalid="keep", stringOrderType="frequencyDesc"
    )


def feature_stages(before: Sequence[str], category: str, after: Sequence[str], scaled: bool = True) -> Pipeline:
    """Stages that give ``features`` (numbers, one-hot block, numbers) and ``scaled`` from it.

    The one-hot block has a slot for unseen values, which is zero on the fitted rows; scaling
    leaves it zero. Rows with a null number are left out.
    """
    stages = [
        indexer(category, f"{category}_idx"),
        OneHotEncoder(inputCols=[f"{category}_idx"], outputCols=[f"{category}_hot"], dropLast=False),
        VectorAssembler(
            inputCols=[*before, f"{category}_hot", *after], outputCol="features", handleInvalid="skip"
        ),
    ]
    if scaled:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    return Pipeline(stages=stages)


def numeric_stages(columns: Sequence[str]) -> Pipeline:
    """Stages that give ``features`` and ``scaled`` from plain numbers."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip"),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        ]
    )


def prepared(df: DataFrame, stages: Pipeline, fit_on: Column | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit the stages on the rows that ``fit_on`` selects (all if none) and apply them to all."""
    model = stages.fit(df if fit_on is None else df.where(fit_on))
    return model, model.transform(df)


def slot_names(df: DataFrame, features: str = "features") -> list[str]:
    """Name of each slot of an assembled vector, from the column's own metadata."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"].values()
    return [slot["name"] for slot in sorted((s for group in groups for s in group), key=lambda s: s["idx"])]


def slot_summary(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Per vector slot: rows, non-zero rows, sum, mean and sample deviation, from one pass."""
    found = df.agg(
        Summarizer.metrics("count", "numNonZeros", "sum", "mean", "std").summary(F.col(vector)).alias("s")
    )
    slots = F.arrays_zip(
        F.array(*[F.lit(name) for name in names]).alias("slot"),
        vector_to_array("s.numNonZeros").alias("nonzero"),
        vector_to_array("s.sum").alias("total"),
        vector_to_array("s.mean").alias("mean"),
        vector_to_array("s.std").alias("stddev"),
    )
    return found.select(F.col("s.count").alias("rows"), F.posexplode(slots).alias("position", "item")).select(
        "position", "item.slot", "rows", F.col("item.nonzero").cast("long").alias("nonzero"),
        "item.total", "item.mean", "item.stddev",
    )


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def draw(key: str, seed: int = 42, parts: int = 100) -> Column:
    """A number below ``parts`` that depends only on the row's key and the seed.

    Unlike a random split it is the same under any partitioning, retry or executor loss.
    """
    return F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("long") % parts


def in_train(key: str, seed: int = 42, train_percent: int = 80) -> Column:
    return draw(key, seed) < train_percent


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in a pseudo-random but repeatable order; each task keeps at most ``n``."""
    return df.orderBy(_digest(key, seed), key).limit(n)
