"""Session settings and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rillmark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume (all are Spark settings, none is required)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; make a folder only for a local test session."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rillmark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder so later rounds neither recompute nor re-plan it."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors."""
    _checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def write_round(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to the scratch folder, split by the columns ``by``, and read again: like ``cut_lineage``, but compressed, and
    ``drop_round`` deletes it when the next rounds have been written."""
    path = f"{scratch_path(df.sparkSession)}/round-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_round(*tables: DataFrame) -> None:
    """Delete what ``write_round`` wrote for these tables."""
    for df in tables:
        session = df.sparkSession
        folders = {m[0] for f in df.inputFiles() if (m := re.match(r".*/round-[0-9a-f]{32}(?=/)", f))}
        for folder in folders:
            path = session._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
