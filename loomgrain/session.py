"""Session profile and the shared working folder."""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

MB = 1024 * 1024

_roots: dict[str, str] = {}
_serial = itertools.count(1)


def session_settings(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings every job of this package is written for.

    ``shuffle_partitions`` is only a starting point: adaptive execution merges
    small shuffle partitions, so a cluster should start high.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(128 * MB),
        "spark.sql.files.openCostInBytes": str(4 * MB),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return settings


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Settings for ``s3a://`` paths; TLS follows the endpoint's scheme."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**session_settings(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Intermediate tables are written there so that a lost executor costs a
    re-read and no recomputation. Only a local session may fall back to a
    temporary folder: on a cluster no other machine could read it.
    """
    app_id = spark.sparkContext.applicationId
    if app_id not in _roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        local = spark.sparkContext.master.startswith("local")
        if shared:
            _roots[app_id] = f"{shared.rstrip('/')}/loomgrain-{app_id}-{uuid.uuid4().hex[:8]}"
        elif local:
            _roots[app_id] = tempfile.mkdtemp(prefix="loomgrain-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if local and "://" not in _roots[app_id]:
            atexit.register(shutil.rmtree, _roots[app_id].removeprefix("file:"), ignore_errors=True)
    return _roots[app_id]


def release(spark: SparkSession) -> None:
    """Delete this application's working folder, once nothing reads its tables any more."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        delete_path(spark, root)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def delete_path(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    return f"{scratch_root(spark)}/{label}-{next(_serial):05d}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
