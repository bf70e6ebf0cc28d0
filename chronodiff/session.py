"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Settings a session needs for right results; sizes of partitions stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Settings for the speed of long expressions: HotSpot leaves methods of more than 8,000 bytes uncompiled, so a generated one that is
#: longer is slower than the same plan without whole-stage code.
RUNTIME = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Sets RUNTIME in a session that somebody else made, where it isn't set; the queries do so, the operators don't."""
    for k, v in RUNTIME.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def build_session(cpus: int | str = 8, memory: str = "8g", name: str = "chronodiff") -> SparkSession:
    """A local session for tests and bench; on a cluster the caller brings its own session."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for k, v in (SETTINGS | RUNTIME).items():
        b = b.config(k, v)
    return (
        b.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables: inside the one that the session names in ``spark.checkpoint.dir`` (or has as its checkpoint folder), which all executors share.

    Where none is set, a session on one machine (master ``local``) gets a temporary one; on a cluster this raises. The folder
    is the session's own and goes when its JVM ends, or earlier by :func:`release`.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc._jsc.sc().getCheckpointDir().get()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = _ALONE.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="chronodiff-"))
    folder = f"{named.rstrip('/')}/chronodiff-{sc.applicationId}"
    if folder not in _MARKED:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


_ALONE: dict[str, str] = {}
_MARKED: set[str] = set()


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder and read from there: computed once, with no lineage, whatever becomes of the executors.

    For a table that several later stages read; they read only its columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes the session's written intermediate tables and forgets its kept ones; results that aren't computed yet can't be afterwards."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    _MARKED.discard(shared_folder(spark))
    spark.catalog.clearCache()


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed now, once, and kept on the executors' disks for the several uses that follow; parts that are lost are computed again.

    Left to the first use, stages that run side by side would each compute it.
    """
    df = df.persist(StorageLevel.DISK_ONLY)
    df.count()
    return df
