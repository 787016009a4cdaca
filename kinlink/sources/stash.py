"""Written intermediate tables that cut lineage and survive the loss of an executor.

Every stash goes below the folder that the session names in ``spark.checkpoint.dir``. Only a local session that names none
gets a folder of our own there; on a cluster, where such a folder would be one machine's, that is refused.
"""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RELEASE_SECONDS = 2.0
_released = 0.0
_OWNED: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="kinlink-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a written folder through Hadoop's file system, so that any store works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _sweep() -> None:
    for spark, path in _OWNED:
        try:
            delete(spark, path)
        except Exception:  # the session may be gone already; the folder is transient by design
            pass


atexit.register(_sweep)


class Stash:
    """A written table. ``df`` reads it; ``drop()`` deletes it once nothing reads it any more."""

    def __init__(self, spark: SparkSession, path: str, schema=None):
        self.spark, self.path, self.schema = spark, path, schema

    @property
    def df(self) -> DataFrame:
        """The table; its schema is known, so no job reads footers for it."""
        return (self.spark.read.schema(self.schema) if self.schema else self.spark.read).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)
        if (self.spark, self.path) in _OWNED:
            _OWNED.remove((self.spark, self.path))


def _release(spark: SparkSession) -> None:
    """Shuffle files of finished jobs stay until the driver collects its garbage; small jobs in a row need not ask each time."""
    global _released
    if time.monotonic() - _released > RELEASE_SECONDS:
        spark._jvm.System.gc()
        _released = time.monotonic()


def stash(df: DataFrame, name: str = "t") -> Stash:
    """Write ``df`` to the shared folder as Parquet and return a handle that rereads it.

    Empty frames, clashing-free any schema and null columns pass through unchanged.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinlink/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _OWNED.append((spark, path))
    _release(spark)
    return Stash(spark, path, df.schema)


def settle(make: Callable[[], DataFrame], name: str) -> Stash:
    """The result of ``make()`` written as a table; what it stashed on the way is dropped."""
    before = set(_OWNED)
    out = stash(make(), name)
    for s, path in [o for o in _OWNED if o not in before and o[1] != out.path]:
        Stash(s, path).drop()
    return out
