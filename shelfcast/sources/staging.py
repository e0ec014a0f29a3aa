"""Written intermediate tables.

A table that feeds two or more branches of a plan is written once and read back, so the
daily fact is never scanned twice. Small aggregated sides are staged for a second reason:
the planner then knows their true size, and broadcasts them only under
``spark.sql.autoBroadcastJoinThreshold``; above it the join is a shuffle join that
adaptive execution can split on skewed keys.

The files live in the shared folder named by ``spark.checkpoint.dir``, so a lost executor
costs a re-read and nothing else.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder of this application inside the shared checkpoint folder."""
    context = spark.sparkContext
    app = context.applicationId
    if app not in _ROOTS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not shared:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="shelfcast-")
        root = f"{shared.rstrip('/')}/shelfcast-{app}-{uuid.uuid4().hex[:8]}"
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        if not context.getCheckpointDir():
            context.setCheckpointDir(f"{root}/rdd")
        _ROOTS[app] = root
    return _ROOTS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex[:8]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the staging folder and return the scan of what was written."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
