"""Cuts in long plans: results that several later steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder and read from there.

    A plan that is read several times, by joins with itself or with what was derived from it, is otherwise repeated in every place.
    ``spark.checkpoint.dir`` names the folder; only a local session without one uses a temporary folder.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return df.checkpoint(eager=True)
