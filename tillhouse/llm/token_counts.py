"""Token counts of whole documents, huge ones by overlapping chunks that are spliced where they agree.

Texts of up to ``step`` characters are counted in one go. Longer ones are cut into overlapping
chunks, each encoded with offsets; the counts are spliced at places where both neighbours start a
pre-token (``resync``), and texts whose chunks nowhere agree go again with a wider overlap.

The library spends most of its time on words it has seen before, so a worker keeps the counts of
the texts between single spaces. A space between two other characters always starts a pre-token;
this is used only for texts of long-established letters, on which all Unicode versions agree, and
every count comes from the library itself.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillhouse.llm.common import slices, table
from tillhouse.llm.resync import stitched
from tillhouse.staging import pin

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
#: Entries of a worker's memory of counts, some 150 bytes each; when full it starts anew.
REMEMBERED = 1_000_000
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\u00a1-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
_NOT_SINGLE = re.compile(r" \s|\s ")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


@cache
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class Counter:
    """Counts of the library, remembered for the texts between single spaces."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.known: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if not _PLAIN.fullmatch(text):
            return self.whole(text)
        parts = _SINGLE_SPACE.split(text) if _NOT_SINGLE.search(text) or text[:1] == " " or text[-1:] == " " else text.split(" ")
        first = self.whole(parts[0]) if parts[0] else 0
        rest = parts[1:]
        new = [part for part in set(rest) if part not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(set(rest))
            found = self.library.encode_batch_fast([" " + part for part in new], add_special_tokens=False)
            self.known.update(zip(new, map(len, found), strict=True))
        return first + sum(map(self.known.__getitem__, rest))


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in slices(batches):
            counts = [count(text) for text in batch.column("text").to_pylist()]
            others = {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes")}
            yield pa.RecordBatch.from_pydict(others | {"n_tokens": pa.array(counts, pa.int64())})

    return run


def _offsets(path: str):
    def make():
        library = tokenizer(path)

        def scan(text: str) -> tuple[np.ndarray, np.ndarray, int]:
            found = library.encode(text, add_special_tokens=False)
            words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            begins = np.array([b for b, _ in found.offsets], np.int64)
            ends = np.array([e for _, e in found.offsets], np.int64)
            first = np.ones(len(words), bool)
            first[1:] = (words[1:] != words[:-1]) & (begins[1:] == ends[:-1])
            return begins[first], np.flatnonzero(first), len(words)

        return scan

    return make


def count_tokens(docs: DataFrame, path: str = TOKENIZER, limit: int = LIMIT, step: int = 65_536, overlap: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    A null text is empty: no bytes, no tokens. Repeated rows and null ids stay, other columns are
    ignored. Special strings inside a text count as the library's default takes them. Stores the
    long texts when called.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    kinds = "doc_id long, n_bytes long, n_tokens long"
    counted = texts.where(F.length("text") <= step).mapInArrow(_count(path), kinds)
    long_texts = pin(texts.where(F.length("text") > step).select(F.monotonically_increasing_id().alias("row_id"), "*"))
    if not long_texts.isEmpty():
        chunks = stitched(long_texts, _offsets(path), step, overlap, keep_text=False)
        inside = F.coalesce("end_count", "total") - F.col("begin_count")
        sums = chunks.groupBy("row_id").agg(F.sum(inside).alias("n_tokens"))
        counted = counted.unionByName(long_texts.join(sums, "row_id").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"))


QUERIES = {"op6_token_counts": op6_token_counts}
