"""Small helpers shared by the Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers, so that very long texts cannot pile up."""
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key, str(most)))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def map_rows(df: DataFrame, fn, schema: str, spark: SparkSession | None = None) -> DataFrame:
    """``mapInArrow`` over bounded batches; ``fn`` takes an iterator of RecordBatch."""
    bounded_batches(spark or df.sparkSession)
    return df.mapInArrow(fn, schema)


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches as tuples, column order kept."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))
