"""What the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.session import ensure_checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Most bytes of one Arrow batch sent to a Python worker.
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes: rows alone do not bound a batch of very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage and lets several consumers share one computation; a lost
    executor costs nothing, as the files are in shared storage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def rows_of(batches: Iterator[pa.RecordBatch], *cols: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one batch in memory at a time."""
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in cols), strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
