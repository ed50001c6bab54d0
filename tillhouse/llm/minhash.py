"""Near duplicates by circulant MinHash, banding, and exact Jaccard similarity on full sets.

Two fixed permutations of the 32-bit numbers make all coordinates of a signature: the first places a
shingle, the second is shifted circularly by k for coordinate k, and the coordinate is the least
image over the set. Documents with equal sets are one class. Classes that agree in all coordinates
of a band are compared by a sketch of two bits a coordinate, which leaves out only pairs that are far
too different; what it leaves falls into families, and within these the full sets are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import KEYS, row_keys, slices, sorted_groups, table
from tillhouse.llm.components import components
from tillhouse.staging import pin

WORDS = 2
PERCENT = 80
#: A pair at 0.8 shares no band with a chance of (1 - 0.8 ** 6) ** 42 = 3e-6.
BANDS, ROWS = 42, 6
#: Rows of a bucket and members of a family that meet in one task; more are dealt out as pairs of chunks.
BUCKET, FAMILY = 2048, 1024
#: Two-bit coordinates of 252 that a pair at 0.8 shares, less five standard deviations (0.85 - 5 * 0.0225).
SKETCH_LEAST = int(BANDS * ROWS * (0.85 - 5 * 0.0225))
_WORD_MEMORY = 200_000
_FIRST, _SECOND, _THIRD = np.uint32(0x7FEB352D), np.uint32(0x846CA68B), np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles; word hashes are remembered up to a bound."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        known = self.known
        new = [word for word in set(words) if word not in known]
        if new:
            if len(known) + len(new) > _WORD_MEMORY:
                known.clear()
                new = list(set(words))
            known.update((word, xxhash.xxh64_intdigest(word)) for word in new)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(hashes):
            return hashes
        width = min(self.words, len(hashes))
        shingles = np.full(len(hashes) - width + 1, np.uint64(width))
        for i in range(width):
            shingles = (shingles * _THIRD) ^ (shingles >> np.uint64(29))
            shingles += hashes[i : len(hashes) - width + 1 + i]
        return np.unique((shingles ^ (shingles >> np.uint64(32))) * _THIRD)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set, from the two permutations."""
    placed = shingles.astype(np.uint32) ^ (shingles >> np.uint64(32)).astype(np.uint32)
    placed ^= placed >> np.uint32(16)
    placed *= _SECOND
    placed ^= placed >> np.uint32(15)
    shifts = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(placed), 256):
        image = placed[None, start : start + 256] + shifts
        image *= _FIRST
        image ^= image >> np.uint32(15)
        image *= _SECOND
        image ^= image >> np.uint32(16)
        np.minimum(least, image.min(axis=1), out=least)
    return least


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
    ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
])


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(words)
        for batch in slices(batches):
            sizes, nodes, bands, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingles_of(text)
                sizes.append(len(shingles))
                if not len(shingles):
                    nodes.append(None), bands.append(None), sketches.append(None)
                    continue
                found = signature(shingles)
                rows = found.reshape(BANDS, ROWS)
                nodes.append(xxhash.xxh128_digest(shingles.tobytes()))
                bands.append([xxhash.xxh64_intdigest(row.tobytes(), seed=i) - 2**63 for i, row in enumerate(rows)])
                bits = np.unpackbits((found >> np.uint32(13)).astype(np.uint8)[:, None], axis=1, count=2, bitorder="little")
                sketches.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes() + b"\0")
            columns = [batch.column("doc_id"), batch.column("text_key"), sizes, nodes, bands, sketches]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _SIGNED, strict=True)],
                schema=_SIGNED,
            )

    return run


def _stars(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """For each connected group of 0..count-1 its members with their first one; ``near(u, others)`` is a mask."""
    left, edges = np.arange(count), []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            mask = near(queue.pop(), left)
            found, left = left[mask], left[~mask]
            queue.extend(found.tolist())
            edges.extend((root, v) for v in found.tolist())
    return edges


def _edges(group: pa.Table, near: Callable[[int, np.ndarray], np.ndarray], out: dict[str, list]) -> None:
    nodes = group.column("node").to_pylist()
    for u, v in _stars(len(nodes), near):
        out["u"].append(nodes[u]), out["v"].append(nodes[v])


def _edge_batches(batches: Iterator[pa.RecordBatch], keys: list[str], near_of: Callable) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])
    out: dict[str, list] = {"u": [], "v": []}
    for group in sorted_groups(batches, keys):
        if group.num_rows > 1:
            _edges(group, near_of(group), out)
        if len(out["u"]) > 20_000:
            yield pa.RecordBatch.from_pydict(out, schema)
            out = {"u": [], "v": []}
    yield pa.RecordBatch.from_pydict(out, schema)


def _alike_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = np.uint64(0x5555555555555555)

    def near_of(group: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
        sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(group.num_rows, 8)

        def near(u: int, others: np.ndarray) -> np.ndarray:
            differ = sketches[others] ^ sketches[u]
            differ = (differ | (differ >> np.uint64(1))) & low
            return BANDS * ROWS - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) >= SKETCH_LEAST

        return near

    yield from _edge_batches(batches, ["bucket", "a", "b"], near_of)


def _linked_sets(percent: int):
    def near_of(group: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        own = np.zeros(ids.max() + 1, np.int64)

        def near(u: int, others: np.ndarray) -> np.ndarray:
            mask = (np.minimum(sizes[others], sizes[u]) * 100 >= percent * np.maximum(sizes[others], sizes[u]))
            like = others[mask]
            if len(like):
                mine = ids[ends[u] - sizes[u] : ends[u]]
                own[mine] = 1
                shared = np.array([own[ids[ends[v] - sizes[v] : ends[v]]].sum() for v in like.tolist()])
                own[mine] = 0
                mask[mask] = 100 * shared >= percent * (sizes[like] + sizes[u] - shared)
            return mask

        return near

    return lambda batches: _edge_batches(batches, ["family", "a", "b"], near_of)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(words)
        for batch in slices(batches, 64):
            sets = [shingles_of(text).tobytes() for text in batch.column("text").to_pylist()]
            others = {name: batch.column(name) for name in ("node", "family", "members")}
            yield pa.RecordBatch.from_pydict(others | {"shingles": pa.array(sets, pa.binary())})

    return run


def _dealt(df: DataFrame, key: str, count: str, most: int) -> DataFrame:
    """Rows of a key with up to ``most`` rows stay together; of more, every pair of chunks meets somewhere."""
    chunks = F.ceil(F.col(count) / most).cast("int")
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    # With more than one chunk, a chunk meets itself wherever it meets another.
    dealt = df.withColumn("own", own).withColumn("other", other).where(f"own != other or {count} <= {most}")
    keys = [key, "a", "b"]
    dealt = dealt.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")}).drop("own", "other", count)
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of every row of ``docs``.

    Words are what white space separates, A-Z lower-cased; a set holds the distinct runs of ``words``
    words, or the whole sequence of a shorter text. Two documents are linked if 100 * intersection
    >= ``percent`` * union. component_id is the smallest doc_id that links reach. Null texts and texts
    without words have an empty set and are linked with nothing. Rows without doc_id take part, but
    name no component unless alone (null, kept). Repeated rows share a component and are all kept or
    none. text_key is xxhash64 of the text, for joining back. Other columns are ignored. Shingles are
    compared by 64-bit hashes. Works through stored tables when called.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    signed = pin(texts.mapInArrow(_sign(words), "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, sketch binary"))
    classes = pin(
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    banded = classes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = banded.join(shared, "bucket").join(classes.select("node", "sketch"), "node")
    alike = _dealt(met, "bucket", "members", BUCKET).mapInArrow(_alike_sketches, "u binary, v binary")
    families = pin(components(alike).withColumnRenamed("label", "family"))

    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    members = families.join(sizes, "family").withColumn("family", F.xxhash64("family"))
    # A class is read through one of its documents; of rows that repeat an id, by the text's key too.
    first = signed.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"))
    chosen = members.join(first, "node").select("node", "family", "members", "row.doc_id", "row.text_key")
    read = texts.withColumnsRenamed({"doc_id": "their_id", "text_key": "their_key"})
    with_text = chosen.join(read, F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("text_key") == F.col("their_key")))
    sets = with_text.select("node", "family", "members", "text").mapInArrow(
        _sets(words), "node binary, family long, members long, shingles binary"
    )
    linked = _dealt(sets, "family", "members", FAMILY).mapInArrow(_linked_sets(percent), "u binary, v binary")
    labels = pin(components(linked))

    named = classes.select("node", "doc_id").join(labels, "node", "left")
    named = named.select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_node = named.drop("doc_id").join(smallest, "label").select("node", "component_id")
    found = signed.select("doc_id", "text_key", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs``, with all its columns, without near duplicates: of each component the row with the smallest id.

    Of rows equal in doc_id and text one stays; different texts under one id both stay.
    """
    kept = near_duplicates(docs, words, percent).where("kept").select(
        F.col("doc_id").isNull().alias("key_no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("key_id"),
        F.col("text_key").alias("key_text"),
    )
    counted = pin(kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows")))
    found = row_keys(docs).join(counted.drop("rows"), KEYS, "left_semi")
    if not counted.where("rows > 1").isEmpty():
        found = found.dropDuplicates(KEYS)
    return found.select(*docs.columns)


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("text_key")


QUERIES = {"op10_near_duplicates": op10_near_duplicates}
