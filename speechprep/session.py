"""Session settings for local runs and tests, and materialisation.

On a cluster the session comes from the platform; nothing in the library needs
settings beyond Spark's defaults and a ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "speechprep") -> SparkSession:
    partitions = 8 if cpus == "*" else max(int(cpus), 1)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small tables, heavy expressions: keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, *keys: str, per_task: int | None = None) -> DataFrame:
    """Spread narrow rows that stand for heavy work (a file to open, a stretch of
    audio to read) over all tasks. The number is fixed, because adaptive execution
    would judge by the size of the rows and put them all into one task; with
    ``per_task`` it grows with the rows, which are counted for it."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, spark.sparkContext.defaultParallelism)
    if per_task:
        tasks = max(tasks, -(-df.count() // per_task))
    return df.repartition(tasks, *keys)


def shared_folder(spark: SparkSession) -> str:
    """The folder all nodes reach, named by ``spark.checkpoint.dir``. Only a local
    session without one gets a folder of its own, which goes when Python ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes can reach")
        folder = tempfile.mkdtemp(prefix="speechprep-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Materialise a relation that is costly to make and read by several branches.

    A reliable checkpoint in the shared folder: it survives lost executors and cuts
    the lineage.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def saved(df: DataFrame) -> str:
    """Write the rows as a table in the shared folder; returns its place."""
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, read from there. Unlike a checkpoint,
    a table tells the plans that follow its true size, and the tasks that read it are
    made anew from the sizes of its files."""
    return df.sparkSession.read.schema(df.schema).parquet(saved(df))
