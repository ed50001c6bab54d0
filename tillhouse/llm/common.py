"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; the fast built-in serves texts without other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 where the id is null."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % divisor, F.lit(-1))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that Python objects of few texts exist at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


KEYS = ["key_no_id", "key_id", "key_text"]


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with what tells its rows apart in joins: rows equal in it have the same id and text."""
    return docs.withColumns({
        "key_no_id": F.col("doc_id").isNull(),
        "key_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
        "key_text": F.xxhash64("text"),
    })


def repeat_rows(df: DataFrame, copies: str, columns: list[str]) -> DataFrame:
    """``columns`` of each row as many times as ``copies`` says."""
    return df.withColumn("copy_number", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*columns)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by them; a run is bounded by how rows are dealt."""
    rest: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = pa.concat_tables([rest, part]) if rest is not None else part
        if not part.num_rows:
            continue
        part = part.combine_chunks()
        columns = [part.column(key).to_numpy() for key in keys]
        change = np.zeros(part.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            yield part.slice(begin, end - begin)
        rest = part.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest
