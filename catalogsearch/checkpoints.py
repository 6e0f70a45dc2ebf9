"""Results kept in the shared checkpoint folder, so that several outputs do not recompute them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(session: SparkSession) -> str:
    """The folder for intermediate tables that the cluster names in `spark.checkpoint.dir`.

    Without that setting a local session, as in tests, gets a temporary folder.
    """
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        folder = session.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The DataFrame, computed once and written to the checkpoint folder as Parquet, so that readers prune columns."""
    session = frame.sparkSession
    path = f"{checkpoint_folder(session)}/table-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return session.read.schema(frame.schema).parquet(path)
