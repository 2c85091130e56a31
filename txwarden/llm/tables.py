"""Tables that are stored between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txwarden.functions.staging import stage

#: Spark's setting that has shuffle files deleted at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str) -> DataFrame:
    """A staged table whose shuffle files go as soon as it is written: nothing reads them again,
    and on their own they stay until the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
