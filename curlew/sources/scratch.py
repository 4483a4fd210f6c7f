"""Tables of intermediate results in the shared checkpoint folder: they cut lineage and outlive executors."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex
_swept: dict[str, SparkSession] = {}


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder wherever Spark can write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_root(spark: SparkSession) -> str:
    """This process's folder below spark.checkpoint.dir, which all executors share; it goes when the process ends.

    Where the setting is missing a local session takes a temporary folder. A cluster's executors would each write to
    their own disk there, so without the setting it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = next((r for r, s in _swept.items() if s.sparkContext is spark.sparkContext), None) or tempfile.mkdtemp(prefix="curlew-")
        base = base.removesuffix(f"/curlew/{_RUN}")
    root = f"{base.rstrip('/')}/curlew/{_RUN}"
    if not _swept:
        atexit.register(_sweep)
    _swept.setdefault(root, spark)
    return root


def _sweep() -> None:
    for root, spark in _swept.items():
        with contextlib.suppress(Exception):  # the session may be gone
            delete(spark, root)


class Scratch:
    """Tables for one computation. As a context manager it deletes, at its end, those not kept."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.made = spark, shared_root(spark), []

    def path(self, name: str = "") -> str:
        return f"{self.root}/{name}{uuid.uuid4().hex}"

    def put(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """The DataFrame written and read back; keep: it outlives the context, as what is returned reads it."""
        path = self.path()
        df.write.parquet(path)
        if not keep:
            self.made.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing still to be run reads."""
        for df in tables:
            delete(self.spark, df._scratch_path)
            if df._scratch_path in self.made:
                self.made.remove(df._scratch_path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.made:
            delete(self.spark, path)
        self.made.clear()
