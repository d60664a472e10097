"""Session and table helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the folder of ``spark.checkpoint.dir``; a temporary folder serves in local
    mode only."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            folder = tempfile.mkdtemp(prefix="loomwright-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
