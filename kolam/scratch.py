"""Tables that cut lineage, written to the folder all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: dict[str, set[str]] = {}  # folders by application, for clear()
#: Deletes the shuffle files of a plan when its write has ended; what was written doesn't need them any more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = str(Path(__file__).resolve().parents[1])


def ensure_importable(spark: SparkSession) -> None:
    """Lets Python workers that see the same files import this package, whatever folder the driver was started in. On clusters
    without such files the package is shipped as usual, by --py-files."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([x for x in known if x] + [_ROOT])


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; on a local master without that setting, one of our own.

    On a cluster the setting is required: a folder of one machine would be lost with it.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        made = tempfile.mkdtemp(prefix="kolam-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own[app] = "file://" + made
    return _own[app]


def clear(spark: SparkSession) -> None:
    """Deletes every intermediate table this application has written, once the results that read them are stored."""
    for path in _written.pop(spark.sparkContext.applicationId, set()):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """A folder of intermediate Parquet tables of one operator call.

    save() writes a table and returns a reader of it, so that what follows starts from files and survives lost executors. The
    shuffle files behind it are deleted when it is written.
    drop() deletes tables that no later plan reads; what a returned DataFrame still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_importable(spark)
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        _written.setdefault(spark.sparkContext.applicationId, set()).add(self.path)
        self._n = 0
        self._paths: set[str] = set()

    def save(self, df: DataFrame, name: str = "t", by: list[str] | None = None) -> DataFrame:
        """The table as written; with by, parted into folders by these columns, so that filters on them read their folders only."""
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").mode("overwrite").parquet(path, partitionBy=by)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out = out.select(*df.columns) if by else out
        out._scratch_path = path
        self._paths.add(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(getattr(t, "_scratch_path", None))

    def keep_only(self, *tables: DataFrame) -> None:
        """Deletes all tables of this folder but these, which are what later plans still read."""
        kept = {getattr(t, "_scratch_path", None) for t in tables}
        for path in sorted(self._paths - kept):
            self._delete(path)

    def _delete(self, path: str | None) -> None:
        if path in self._paths:
            self._paths.discard(path)
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of driver rows as a local relation, which needs no Python worker when it is read."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, arrow)], schema=arrow), schema)
