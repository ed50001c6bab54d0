"""Long texts in overlapping chunks, and the places where the chunks' pre-tokens agree.

A pre-tokeniser that reads from left to right without looking back continues alike from any place
where two of its runs both start a pre-token. So if chunk i is right from some place on, and chunk
i + 1 starts a pre-token at the same place inside their overlap, chunk i + 1 is right from there on.
Places next to a chunk's cut end don't count, since more text could have lengthened those pre-tokens,
nor do places after white space, which pre-tokenisers split by what follows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import slices
from tillhouse.staging import pin

#: Pre-tokens that end this close to a cut are not trusted; longer than any contraction or special token.
MARGIN = 32
_SCHEMA = (
    "row_id long, chunk long, start long, last boolean, text string, total long, "
    "head array<long>, head_counts array<long>, tail array<long>, tail_counts array<long>"
)
#: Gets a text; gives where its pre-tokens start, and how many tokens stand before each of them, and in all.
Scan = Callable[[str], tuple[np.ndarray, np.ndarray, int]]


def _cut(step: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row, text = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            starts = range(0, max(len(text) - overlap, 1), step)
            for first in range(0, len(starts), 64):
                some = starts[first : first + 64]
                yield pa.RecordBatch.from_pydict({
                    "row_id": pa.array([row] * len(some), pa.int64()),
                    "chunk": pa.array([s // step for s in some], pa.int64()),
                    "last": pa.array([s == starts[-1] for s in some], pa.bool_()),
                    "text": pa.array([text[s : s + step + overlap] for s in some], pa.string()),
                })

    return run


def _scan_chunks(make_scan: Callable[[], Scan], step: int, overlap: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make_scan()
        for batch in slices(batches, 8):
            out: dict[str, list] = {name: [] for name in pa_schema.names}
            for row, chunk, last, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                start, (places, counts, total) = chunk * step, scan(text)
                stable = np.array([p == 0 or not text[p - 1].isspace() for p in places.tolist()], bool)
                if not last:
                    stable &= places <= len(text) - MARGIN
                places, counts = places[stable], counts[stable]
                head, tail = places < overlap, places >= step
                values = (row, chunk, start, last, text if keep_text else None, total, places[head] + start, counts[head], places[tail] + start, counts[tail])
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa_schema)

    longs = pa.list_(pa.int64())
    pa_schema = pa.schema(
        [("row_id", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("text", pa.string()), ("total", pa.int64())]
        + [(name, longs) for name in ("head", "head_counts", "tail", "tail_counts")]
    )
    return run


def stitched(long_texts: DataFrame, make_scan: Callable[[], Scan], step: int, overlap: int, keep_text: bool) -> DataFrame:
    """Chunks of ``long_texts`` (row_id unique and stored, text) with the part of each that counts.

    Adds ``begin`` and ``end``, the characters of the text between the agreed places (end is null at
    the text's end), ``begin_count`` and ``end_count``, the chunk's tokens before them. Chunks that
    nowhere agree with the next make their whole text go again with eight times the overlap and step,
    until one chunk holds it. Reads and writes stored tables when called.
    """
    parts = None
    while True:
        cut = long_texts.select("row_id", "text").mapInArrow(
            _cut(step, overlap), "row_id long, chunk long, last boolean, text string"
        )
        spread = cut.repartition("row_id", "chunk")
        chunks = pin(spread.mapInArrow(_scan_chunks(make_scan, step, overlap, keep_text), _SCHEMA))
        nexts = chunks.select("row_id", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("next_head"), F.col("head_counts").alias("next_counts"))
        agreed = F.array_min(F.array_intersect("tail", "next_head"))
        seams = (
            chunks.where("not last")
            .select("row_id", "chunk", "tail", "tail_counts")
            .join(nexts, ["row_id", "chunk"])
            .withColumn("end", agreed)
            .select(
                "row_id", "chunk", "end",
                F.element_at("tail_counts", F.array_position("tail", F.col("end")).cast("int")).alias("end_count"),
                F.element_at("next_counts", F.array_position("next_head", F.col("end")).cast("int")).alias("next_count"),
            )
        )
        seams = pin(seams)
        failed = seams.where("end is null").select("row_id").distinct()
        begins = seams.select("row_id", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("begin"), F.col("next_count").alias("begin_count"))
        whole = (
            chunks.drop("head", "head_counts", "tail", "tail_counts")
            .join(begins, ["row_id", "chunk"], "left")
            .join(seams.drop("next_count"), ["row_id", "chunk"], "left")
            .withColumns({"begin": F.coalesce("begin", F.lit(0)), "begin_count": F.coalesce("begin_count", F.lit(0))})
            .join(failed, "row_id", "left_anti")
        )
        parts = whole if parts is None else parts.unionByName(whole)
        if failed.isEmpty():
            return parts
        long_texts = long_texts.join(failed, "row_id", "left_semi")
        step, overlap = step * 8, overlap * 8
