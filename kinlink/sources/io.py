"""Readers, writers, row ids and the lifecycle of transient folders."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.sources.stash import delete

TRANSIENT = ".kinlink-transient"


@dataclass
class Pipe:
    """A named source or sink: a format, its options, and for sources perhaps a DDL schema."""

    name: str
    format: str
    props: dict[str, str] = field(default_factory=dict)
    schema: str | None = None
    mode: str = "overwrite"


def read_pipe(spark: SparkSession, pipe: Pipe) -> DataFrame:
    """A lazy scan. ``location`` stands for ``path``; malformed records are read permissively."""
    options = dict(pipe.props)
    path = options.pop("location", options.pop("path", None))
    reader = spark.read.format(pipe.format).options(**{**options, "mode": "PERMISSIVE"})
    if pipe.schema:
        reader = reader.schema(pipe.schema)
    return reader.load(path) if path else reader.load()


def write_pipe(df: DataFrame, pipe: Pipe) -> None:
    options = dict(pipe.props)
    path = options.pop("location", options.pop("path", None))
    df.write.format(pipe.format).options(**options).mode(pipe.mode).save(path)


def with_row_id(df: DataFrame, column: str = "z_zid") -> DataFrame:
    """A unique non-negative long a row, not stable over runs."""
    return df.withColumn(column, F.monotonically_increasing_id())


def transient_dir(root: str, run_id: str | None = None) -> str:
    """A folder of one run below ``root``; the id must be a UUID."""
    run_id = str(uuid.uuid4()) if run_id is None else str(uuid.UUID(run_id))
    return f"{root.rstrip('/')}/{TRANSIENT}/{run_id}"


def drop_transient(spark: SparkSession, path: str) -> None:
    """Delete a run's folder; anything that is not shaped like one is refused. Repeated calls are fine."""
    if ".." in path.split("/") or not re.search(rf"/{re.escape(TRANSIENT)}/[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}$", path):
        raise ValueError(f"{path} is not a transient folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.supportsSymlinks() and system.exists(target) and system.getFileLinkStatus(target).isSymlink():
        raise ValueError(f"{path} is a link")
    delete(spark, path)
