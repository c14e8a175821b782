"""Session factory and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; on a cluster leave ``master`` to spark-submit."""
    builder = (
        SparkSession.builder.master(master)
        .appName("sedimenta")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would be lost
    with its machine.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="sedimenta-checkpoint-")
        sc.setCheckpointDir(folder)
    kept = df.checkpoint(eager=True)
    # A checkpoint hands on its plan's constraints, order and partitioning; over
    # the self-joins of an iteration they double each round, until planning takes
    # longer than the work. Only the rows and their types are kept here.
    plan = kept._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan, kept._jdf.schema(), False), spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
