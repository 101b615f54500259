"""Results that later steps begin with: written once to the folder that all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and written under spark.checkpoint.dir, so that a lost executor loses nothing of it; gone when the driver ends.

    Where the setting is unset, a session in one process gets a temporary folder and a cluster an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    path = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return df.checkpoint()
