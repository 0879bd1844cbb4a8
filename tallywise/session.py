"""Session settings, object-store credentials and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators were planned for. All of them are defaults or safe
#: to override; none is needed for right results.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


_local_folders: dict[str, str] = {}


def build_session(app: str, conf: Mapping[str, str] | None = None, hive: bool = False) -> SparkSession:
    """Return a session with the recommended settings; ``hive`` adds the Hive catalog."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def object_store_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3A settings for ``build_session``; credentials come from the environment only."""
    env = os.environ if env is None else env
    names = {
        "spark.hadoop.fs.s3a.access.key": "access_key",
        "spark.hadoop.fs.s3a.secret.key": "secret_key",
        "spark.hadoop.fs.s3a.endpoint": "endpoint_url_http",
    }
    return {key: env[name] for key, name in names.items() if env.get(name)}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master.startswith("local"):
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tallywise-")
        return _local_folders[context.applicationId]
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten there.

    All paths of an application lie in one folder, which can be removed when the
    application and the frames it left behind are done with.
    """
    own = f"tallywise-{spark.sparkContext.applicationId}"
    return f"{shared_folder(spark).rstrip('/')}/{own}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a derived frame to the shared folder and read it back.

    Its lineage is cut for good, and the planner learns its true size: a join
    with it is broadcast when it is under the session's threshold and shuffled,
    with skew handling, when it is not. Without this the planner assumes the
    size of the inputs and shuffles the large side before it finds out.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
