"""Session helpers: shared scratch folder, lineage cuts, code shipping, table reads."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that setting is absent and everything runs in one process (tests, a laptop) a
    folder of our own is set; on a cluster its absence is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = f"file://{tempfile.gettempdir()}/dialoom-checkpoints"
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def _hadoop_path(spark: SparkSession, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Scratch:
    """Tables written into the shared folder to cut lineage; they survive lost executors.

    ``keep`` writes a DataFrame as compressed Parquet and reads it back; ``drop`` removes a
    table that is no longer needed; what is left goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        path, fs = _hadoop_path(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def keep(self, df: DataFrame) -> tuple[DataFrame, str]:
        self.n += 1
        where = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where), where

    def table(self, df: DataFrame) -> DataFrame:
        return self.keep(df)[0]

    def drop(self, where: str) -> None:
        path, fs = _hadoop_path(self.spark, where)
        fs.delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for Arrow functions.

    Written to the shared folder, so executors need no installation of it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, f"{_PACKAGE.name}/{p.relative_to(_PACKAGE)}")
    where = f"{shared_dir(spark)}/code-{app}/{_PACKAGE.name}.zip"
    path, fs = _hadoop_path(spark, where)
    fs.mkdirs(path.getParent())
    fs.deleteOnExit(path.getParent())
    out = fs.create(path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(where)
    _shipped.add(app)


def exists(spark: SparkSession, where: str) -> bool:
    """Whether a path is there, on any file system of the cluster."""
    path, fs = _hadoop_path(spark, where)
    return fs.exists(path)


def read_text(spark: SparkSession, where: str) -> str:
    """A small document."""
    path, fs = _hadoop_path(spark, where)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8-sig")
    finally:
        stream.close()


def write_text(spark: SparkSession, where: str, text: str) -> None:
    """A small document, whole or not at all: written beside its place and renamed over it."""
    path, fs = _hadoop_path(spark, where)
    part, _ = _hadoop_path(spark, f"{where}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    sc = spark.sparkContext
    fs_package = sc._jvm.org.apache.hadoop.fs
    how = sc._gateway.new_array(fs_package.Options.Rename, 1)
    how[0] = fs_package.Options.Rename.OVERWRITE
    context = fs_package.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(path), how)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """A table or document under another name; nothing is replaced."""
    source, fs = _hadoop_path(spark, old)
    target, _ = _hadoop_path(spark, new)
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"{old} could not be renamed")


@contextmanager
def exclusive(spark: SparkSession, folder: str):
    """One run per folder, by a lock file that is created or else exists."""
    path, fs = _hadoop_path(spark, f"{folder}/.lock")
    fs.mkdirs(path.getParent())
    if not fs.createNewFile(path):
        raise RuntimeError(f"{folder} is in use; remove .lock if no run is going on")
    try:
        yield
    finally:
        fs.delete(path, False)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PLAIN_SCAN = {"Project", "Filter", "LogicalRelation", "HiveTableRelation", "DataSourceV2ScanRelation", "LocalRelation", "LogicalRDD"}


def spread(df: DataFrame) -> DataFrame:
    """``df`` on at least as many partitions as there are cores, for costly work on a plain scan.

    A small table in one file would keep one core busy. Tables with enough splits, and anything
    that is more than a scan with projections and filters, are returned as they are.
    """
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in _PLAIN_SCAN:
            return df
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
