"""What the operators share: bounded Arrow batches and keys of contents; ranks, running sums and checked broadcasts come from the library."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ranges import fresh, numbers, ranked, running, small
from ..session import durable, table

__all__ = ["bounded", "content_key", "durable", "fresh", "numbers", "ranked", "running", "small", "stored", "table"]

ARROW_BYTES = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends texts to Python in batches of about ARROW_BYTES, so that long documents fit in the workers.  A
    session that has its own limit keeps it."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name).rstrip("b") == str(64 << 20):  # Spark's default
        conf.set(name, str(ARROW_BYTES))
    return df


def content_key(*columns: str) -> Column:
    """16 bytes that differ where the columns do; nulls aren't empty texts."""
    return F.unhex(F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns])))


def stored(df: DataFrame) -> list[Column]:
    """Columns in whose order the rows are stored.  A table that is read from Parquet, also with columns or rows left out, is in the order of its
    files' names, the shorter first, as its scan takes large files first; any other DataFrame is in that of its partitions."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    if node.nodeName() == "LogicalRelation":
        try:
            file = df.metadataColumn("_metadata")
            at = [F.length(file["file_path"]), file["file_path"], file["row_index"]]
            df.select(*at)
            return at
        except AnalysisException:  # other files don't number their rows
            pass
    return [F.monotonically_increasing_id()]
