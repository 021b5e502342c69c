"""Session defaults, the shared folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "affinitext", **conf: str) -> SparkSession:
    """A session with the defaults the operators are written for.

    Master, memory and shuffle partitions belong to the deployment and are not set here.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="affinitext-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of jobs that are over: Spark deletes them only once the driver's
    garbage, which refers to them, is collected."""
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Unlike a checkpoint it is evaluated once, and readers can prune its columns and know
    its size. The files stay until the folder is cleaned up, like checkpoint files.
    """
    path = f"{shared_folder(df.sparkSession)}/affinitext-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete written tables whose readers have all been written themselves."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for file in list(df.inputFiles())[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            folder.getFileSystem(conf).delete(folder, True)
