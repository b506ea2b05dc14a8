"""Session settings and the one way lineage is cut."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# All timestamps are read, compared and formatted in UTC. Joins on a hot key are
# split at run time, even where that costs another shuffle.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Of a repeated key in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "tallymart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**PINNED, "spark.ui.enabled": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def pin_session(spark: SparkSession) -> SparkSession:
    for key, value in PINNED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints; a temporary one only for local runs."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tallymart-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Writes `df` once as a table under the checkpoint folder and reads it back.

    With `by`, rows go to a folder per value of that column, so that a filter on it
    reads only its own. `codec` is for wide tables, whose bytes count ("zstd").

    Used where one expensive input feeds several jobs, or where a result that
    depends on the physical layout must not be computed twice. Parquet keeps
    column pruning, cheap counts and a known size for the joins that follow.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tables/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    (writer.option("compression", codec) if codec else writer).parquet(path)
    _created().append(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, for work that costs far more than moving them: at least a
    task per core, however few bytes there are.

    Rows that come from a file per core, or more, stay there: moving all of a large table
    would fill the disks and shorten little.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, cores))


_LOCAL = threading.local()


def _created() -> list[str]:
    """Scratch tables written by this thread and not released yet."""
    if not hasattr(_LOCAL, "paths"):
        _LOCAL.paths = []
    return _LOCAL.paths


def releases_scratch(step: Callable) -> Callable:
    """Deletes the scratch tables of a pipeline step once its results are published."""

    @wraps(step)
    def run(store, *args, **kwargs):
        start = len(_created())
        try:
            return step(store, *args, **kwargs)
        finally:
            spark = store.spark
            for path in _created()[start:]:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            del _created()[start:]

    return run
