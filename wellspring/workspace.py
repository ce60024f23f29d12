"""Where intermediate tables go, and how small inputs are spread over the cores."""

import io
import json
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; elsewhere a folder on the
    driver's disk would not be seen by the executors, so its absence is an error.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="wellspring-")
        root = _local_roots[app]
    path = f"{root.rstrip('/')}/wellspring/{app}/{name}-{uuid.uuid4().hex}"
    if (given := _scope.get()) is not None:
        given.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables of the block at its end, for work that repeats forever."""
    token = _scope.set([])
    try:
        yield
    finally:
        for path in _scope.get():
            delete(spark, path)
        _scope.reset(token)


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _hadoop_file(spark, path)
    return file_system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    file_system, target = _hadoop_file(spark, path)
    file_system.delete(target, True)


def published(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the entries in a manifest folder, in order."""
    file_system, target = _hadoop_file(spark, folder)
    if not file_system.exists(target):
        return []
    names = [status.getPath().getName() for status in file_system.listStatus(target)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())


def read_published(spark: SparkSession, folder: str, number: int) -> dict:
    file_system, target = _hadoop_file(spark, f"{folder}/{number}.json")
    stream = file_system.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, entry: dict) -> int:
    """Add ``entry`` to a manifest folder under the next number. It is written beside and then
    moved, and a move onto a number that another writer took is tried again with the next."""
    file_system, hidden = _hadoop_file(spark, f"{folder}/_{uuid.uuid4().hex}")
    stream = file_system.create(hidden)
    stream.write(json.dumps(entry).encode())
    stream.close()
    number = max(published(spark, folder), default=-1) + 1
    while True:
        _, target = _hadoop_file(spark, f"{folder}/{number}.json")
        if not file_system.exists(target) and file_system.rename(hidden, target):
            return number
        number += 1


def put_line(spark: SparkSession, folder: str, entry: dict) -> None:
    """Replace ``folder`` by one with a single JSON line, which is too little for a job."""
    delete(spark, folder)
    file_system, target = _hadoop_file(spark, f"{folder}/line.json")
    stream = file_system.create(target)
    stream.write(json.dumps(entry).encode())
    stream.close()


def withdraw(spark: SparkSession, folder: str, number: int) -> None:
    delete(spark, f"{folder}/{number}.json")


def _hadoop_file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: lineage ends here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stage``, with aggregates over ``df`` taken on the way instead of by a further job."""
    seen = Observation()
    table = stage(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), name)
    return table, seen.get


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a plain scan at least one partition per core, in ranges of ``key``.

    A table that fits fewer splits than there are cores is small by definition, so
    the shuffle is cheap; a large scan already has more splits and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(cores, key) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, by way of the
    shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(home.rglob("*.py")):
            archive.write(source, source.relative_to(home.parent).as_posix())
    target = f"{scratch(spark, 'package')}/wellspring.zip"
    file_system, path = _hadoop_file(spark, target)
    stream = file_system.create(path)
    stream.write(packed.getvalue())
    stream.close()
    sc.addPyFile(file_system.makeQualified(path).toString())
    _shipped.add(sc.applicationId)
