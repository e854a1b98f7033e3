"""What the operators of this subpackage share: tables, the shared folder, packaging."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: A space or one of the five control characters 9 to 13, as bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster
    the setting is required, since executors don't share local folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache(maxsize=8)
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"llm-{application}-")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once to the shared folder and read back.

    Cuts the lineage so that a lost executor costs a re-read, not a re-computation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def replaced(df: DataFrame, columns: dict) -> DataFrame:
    """``df`` with ``columns`` put last; columns of the same names (any case) make way."""
    taken = {c.lower() for c in columns}
    keep = [df[c] for c in df.columns if c.lower() not in taken]
    return df.select(*keep, *[value.alias(name) for name, value in columns.items()])


def dropped(spark: SparkSession, path: str) -> None:
    """Removes a folder of this application's own intermediate files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of results that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()
