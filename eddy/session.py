"""Session construction and durable scratch locations.

Scratch data (lineage cuts, CSV round trips, stream checkpoints) always goes
under ``spark.checkpoint.dir``: on a cluster that is the shared folder the
cluster names.  Only a local-mode session without that setting gets a private
temporary folder (tests); a cluster session without it is an error, because a
machine-local folder does not survive executor loss.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that make the plans in this package behave as intended.  AQE
# re-plans at runtime: it coalesces small shuffle partitions (towards the
# advisory size, so a cluster can set a large spark.sql.shuffle.partitions for
# 100 TB inputs and still get ~128 MB partitions on small ones), splits skewed
# join partitions and turns a sort-merge join into a broadcast join when the
# measured side is small.  Session time zone is fixed to UTC so epoch
# conversions do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "eddy",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def scratch_conf() -> dict[str, str]:
    """The checkpoint folder named by EDDY_CHECKPOINT_DIR, for tools that build their own
    session; empty if it is not set."""
    root = os.environ.get("EDDY_CHECKPOINT_DIR")
    return {"spark.checkpoint.dir": root} if root else {}


def checkpoint_root(spark: SparkSession) -> str:
    """The durable folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset, a
    local-mode session gets a fresh temporary folder (tests only); any other
    master must name a shared folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        root = tempfile.mkdtemp(prefix="eddy-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/eddy-scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
