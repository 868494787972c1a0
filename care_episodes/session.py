"""Session helpers: where lineage is cut, and sessions for local runs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"
_OWN: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can read.  The cluster names it in `spark.checkpoint.dir`.

    Only a local session (one machine by definition) may fall back to a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    own = tempfile.TemporaryDirectory(prefix="care-episodes-", ignore_cleanup_errors=True)
    _OWN.append(own)  # goes when Python ends
    spark.sparkContext.setCheckpointDir(own.name)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and go on from the written copy.

    Used where one compact intermediate result feeds several branches.  The branches then read
    just the columns they need, Spark knows the real size of what it joins, and losing an executor
    costs a re-read instead of a re-computation.  Files stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/care-episodes-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Rows known on the driver, as a local relation.

    Spark knows the exact size of a local relation and broadcasts it by its own threshold.  A
    DataFrame made from a plain list counts as endlessly large and would force a shuffle join.
    """
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = SparkSession.builder
    if folder:
        builder = builder.config(CHECKPOINT_KEY, folder)
    return (
        builder
        .master(f"local[{cores}]")
        .appName("care-episodes")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Windows cost far more time than bytes: let small shuffles keep all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
