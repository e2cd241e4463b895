"""Session helpers: a local session for tests and benches, and reliable lineage cuts."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Session setting: partitions that the queries' text tables are spread over. Unset, they stay in the
# splits of their files.
SPREAD_TEXTS = "spark.webloom.spreadTexts"


def local_session(cores: int | str = 8, app: str = "webloom", **conf: str) -> SparkSession:
    """Session for tests and benches. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config(SPREAD_TEXTS, str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Long iterations leave a checkpoint behind in each step.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose the data together with its machine, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="webloom-checkpoint-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables, below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there. Survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Like ``cut_lineage``, with the rows hash-partitioned by ``keys`` in a way later joins on
    those keys know of."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage_in_place(df.repartition(parts, *keys))


def cut_lineage_in_place(df: DataFrame) -> DataFrame:
    """Like ``cut_lineage``, in the layout that ``df`` has, which later plans know of. An adaptive plan
    does not report its layout, so this one write goes without."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(df)
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)
