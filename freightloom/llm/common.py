"""What several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.session import shared_dir

#: Rows of an Arrow batch that are worked on at once; texts may be long.
SLICE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def digest_of(column: str) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(text_of(column), 256))


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def field_of(df: DataFrame, column: str, alias: str | None = None):
    """Schema field of a column under another name."""
    from pyspark.sql.types import StructField

    return StructField(alias or column, df.schema[column].dataType, True)


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of a table, whatever signs are in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_key(id_column: str) -> Column:
    """The id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit(""))


def keep_rows(docs: DataFrame, kept: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Documents whose (id, digest) is in ``kept``; of rows equal in both, one stays.

    ``kept`` has the columns ``id`` and ``digest``. Both sides meet in one
    shuffle on the pair, and the repeated rows fall in the same partitions.
    """
    left = docs.withColumns({"__key": row_key(id_column), "__digest": digest_of(text_column)})
    right = kept.select(row_key("id").alias("__key"), F.col("digest").alias("__digest"))
    return left.join(right, ["__key", "__digest"], "left_semi").dropDuplicates(["__key", "__digest"]).select(*columns_of(docs))
