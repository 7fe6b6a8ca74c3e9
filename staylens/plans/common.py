"""Plan helpers shared by the composed analyses."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def reuse(df: DataFrame) -> DataFrame:
    """A DataFrame read by more than one later step of the same plan.

    Persisted to executor memory / local disk (``MEMORY_AND_DISK``); its
    lineage is short, so blocks lost with an executor are recomputed from it.
    Lazy: the first action fills it, no extra job."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage (iterative plans such as pointer doubling).

    Writes a reliable checkpoint under the session's ``spark.checkpoint.dir``
    (a shared folder on a cluster), so a lost executor does not force the
    whole chain of earlier rounds to rerun."""
    from staylens.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: rows keep
    their generated ids, and a lost executor costs a re-read."""
    from staylens.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
