"""Byte-level BPE encoding and decoding of whole documents.

Texts of up to ``step`` characters are encoded as they are. Longer ones are cut into overlapping
chunks that are pre-tokenised in parallel; where the pre-tokens of neighbours agree again
(``resync``) they are stitched, and the pieces between these places are encoded on their own.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import slices, table
from tillhouse.llm.resync import stitched
from tillhouse.staging import pin

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: White space as the encoder's regex engine has it; Python's own class also holds \x1c to \x1f.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pre_tokens():
    pattern = public_tokenizers.PATTERN.replace(r"[^\s", rf"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]")
    pattern = regex.compile(pattern.replace(r"\S", f"[^{_SPACE}]"))

    def scan(text: str) -> tuple[np.ndarray, np.ndarray, int]:
        places = np.fromiter((m.start() for m in pattern.finditer(text)), np.int64)
        return places, np.zeros_like(places), 0

    return scan


def _encode(ranks: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks)
        for batch in slices(batches):
            ids = [bpe.encode_ordinary(text) for text in batch.column("text").to_pylist()]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            columns["ids"] = pa.array([np.array(some, "<u4").tobytes() for some in ids], pa.binary())
            if decoded:
                columns["decoded"] = pa.array([bpe.decode_bytes(some) for some in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(
    docs: DataFrame, ranks: str = RANKS, step: int = 65_536, overlap: int = 512, decoded: bool = False
) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every whole text; null counts as empty.

    With ``decoded`` also the bytes that the ids stand for, decoded in the same pass.

    Repeated rows and null ids stay, other columns are ignored. A text is one row before and after,
    so a row's ids take memory in proportion to its text. Stores the long texts when called.
    """
    names = ["ids", "decoded"] if decoded else ["ids"]
    kinds = ", ".join(f"{name} binary" for name in names)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = texts.where(F.length("text") <= step).mapInArrow(_encode(ranks, decoded), f"doc_id long, {kinds}")
    long_texts = pin(texts.where(F.length("text") > step).select(F.monotonically_increasing_id().alias("row_id"), "*"))
    if long_texts.isEmpty():
        return short
    chunks = stitched(long_texts, _pre_tokens, step, overlap, keep_text=True)
    size = F.coalesce(F.col("end") - F.col("begin"), F.length("text").cast("bigint")).cast("int")
    pieces = chunks.select(
        "row_id", "chunk", F.substr("text", (F.col("begin") - F.col("start") + 1).cast("int"), size).alias("text")
    )

    def in_order(name: str) -> Column:
        parts = F.sort_array(F.collect_list(F.struct("chunk", F.hex(name).alias("part"))))
        return F.unhex(F.array_join(F.transform(parts, lambda part: part["part"]), "")).alias(name)

    encoded = pieces.mapInArrow(_encode(ranks, decoded), f"row_id long, chunk long, {kinds}")
    joined = encoded.groupBy("row_id").agg(*map(in_order, names))
    return short.unionByName(long_texts.select("row_id", "doc_id").join(joined, "row_id").select("doc_id", *names))


def _decode(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks)
        for batch in slices(batches):
            texts = [bpe.decode_bytes(np.frombuffer(ids, "<u4").tolist()) for ids in batch.column("ids").to_pylist()]
            others = {name: batch.column(name) for name in batch.schema.names}
            yield pa.RecordBatch.from_pydict(others | {"decoded": pa.array(texts, pa.binary())})

    return run


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``; frame needs doc_id and ids."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    return encode(docs, ranks, decoded=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))


def reference_digest(text: str | None, ranks: str = RANKS) -> tuple[int, str, str]:
    """The same figures of one text without Spark and chunks, for tests."""
    ids = encoding(ranks).encode_ordinary(text or "")
    decoded = encoding(ranks).decode_bytes(ids)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
