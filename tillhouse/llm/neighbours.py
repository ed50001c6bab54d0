"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by rotations learned on a sample (iterative quantisation). A code is cut
into substrings, each indexed on its own. Codes within a Hamming radius must come close in one
substring at least (pigeonhole), so a query probes in each index the values within that index's share
of the radius, and finds every code within the radius; what it finds is ranked by exact cosine. Rows lie in
shards of bounded size, each with the indexes of its own codes, so that a vector moves once and not once for
every substring; every query visits every shard and takes the best of each along. The radius is learned
from the neighbours within the sample and widened in steps for queries that find too few.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import sorted_groups, table
from tillhouse.staging import pin

NEIGHBOURS = 5
BITS, PARTS = 128, 8
PART_BITS = BITS // PARTS
#: Rows that the rotations and the radius are learned from at most; share of the sample's own
#: neighbours that the radius has to reach.
SAMPLE, REACH = 4096, 0.98
#: Rows of a shard, and queries that visit it in one task, about.
SHARD_ROWS, SHARD_QUERIES = 16_384, 4096
#: What a radius that was too small is widened by, as often as need be.
WIDER = 32
_QUERY_BLOCK = 32


@dataclass(frozen=True)
class Codes:
    """Rotations of unit vectors of one length, and the radius to search."""

    rotation: np.ndarray
    radius: int

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """BITS bits per row as bytes."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.packbits(units @ self.rotation > 0, axis=1)


def part_radii(radius: int) -> list[int]:
    """Shares of the radius: were every substring further away than its share, the whole would be too."""
    whole, rest = divmod(radius, PARTS)
    return [whole if part <= rest else whole - 1 for part in range(PARTS)]


def learn(vectors: np.ndarray, neighbours: int = NEIGHBOURS, reach: float = REACH, steps: int = 30) -> Codes:
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    width = units.shape[1]
    random, rotations = np.random.default_rng(7), []
    for _ in range(math.ceil(BITS / width)):
        rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
        for _ in range(steps):
            left, _, right = np.linalg.svd(units.T @ np.sign(units @ rotation), full_matrices=False)
            rotation = left @ right
        rotations.append(rotation)
    codes = Codes(np.concatenate(rotations, axis=1)[:, :BITS], BITS)
    if len(units) <= neighbours:
        return codes
    nearness = units @ units.T
    np.fill_diagonal(nearness, -2)
    nearest = np.argpartition(-nearness, neighbours, axis=1)[:, :neighbours]
    code = codes.encode(vectors).view(np.uint64)
    apart = np.bitwise_count(code[:, None, :] ^ code[nearest]).sum(axis=2)
    return Codes(codes.rotation, int(np.quantile(apart, reach)))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of rows that take part, all of the commonest length; floats stay as they are given."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = vectors.schema["embedding"].dataType
    kind = "array<float>" if given == T.ArrayType(T.FloatType(), given.containsNull) else "array<double>"
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
    commonest = sizes.orderBy(F.desc("rows"), F.desc("width")).first()
    return rows.where(F.size("embedding") == (commonest["width"] if commonest else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


class Shard:
    """Some rows with one index per substring: its values in order, and the rows of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, code: np.ndarray):
        self.ids, self.vectors, self.code = ids, vectors, code.view(np.uint64)
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        parts = code.view(np.uint16)
        self.orders = [np.argsort(parts[:, part], kind="stable") for part in range(PARTS)]
        self.values, self.starts = [], []
        for part, order in enumerate(self.orders):
            values, starts = np.unique(parts[order, part], return_index=True)
            self.values.append(values)
            self.starts.append(np.append(starts, len(ids)))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row whose codes differ in ``radius`` bits at most, each found in one substring at least."""
        parts, whole = code.view(np.uint16), code.view(np.uint64)
        met = np.zeros((len(code), len(self.ids)), bool)
        for part, share in enumerate(part_radii(radius)):
            q, v = np.nonzero(np.bitwise_count(parts[:, part, None] ^ self.values[part][None, :]) <= share)
            sizes = np.diff(self.starts[part])[v]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[part][v] - ends + sizes, sizes)
            met[np.repeat(q, sizes), self.orders[part][at]] = True
        q, r = np.nonzero(met)
        close = np.bitwise_count(whole[q] ^ self.code[r]).sum(axis=1) <= radius
        return q[close], r[close]

    def best(self, own: np.ndarray, asked: np.ndarray, code: np.ndarray, radius: int, neighbours: int) -> tuple[np.ndarray, ...]:
        """Of every query the nearest rows within the radius: query, vec_id and cosine, and how many it found."""
        q, r = self.within(code, radius)
        other = own[q] != self.ids[r]
        q, r = q[other], r[other]
        cosine = np.empty(len(q))
        lengths = np.sqrt((asked * asked).sum(axis=1))
        for some in np.array_split(np.arange(len(q)), len(q) // 200_000 + 1):
            products = np.einsum("ij,ij->i", asked[q[some]], self.vectors[r[some]])
            cosine[some] = products / (lengths[q[some]] * self.norms[r[some]])
        order = np.lexsort((self.ids[r], -cosine, q))
        q, r, cosine = q[order], r[order], cosine[order]
        fresh = np.ones(len(q), bool)  # a repeated row stands beside itself
        fresh[1:] = (q[1:] != q[:-1]) | (self.ids[r][1:] != self.ids[r][:-1])
        q, r, cosine = q[fresh], r[fresh], cosine[fresh]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return tuple(x[place < neighbours] for x in (own[q], self.ids[r], cosine))


def _visit(codes: Codes, neighbours: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["shard", "chunk"]):
            queries, rows = group.filter(group["asks"]), group.filter(pa.compute.invert(group["asks"]))
            if not queries.num_rows or not rows.num_rows:
                continue
            vectors = _matrix(rows["embedding"])
            shard = Shard(rows["vec_id"].to_numpy(), vectors, codes.encode(vectors))
            own, asked = queries["vec_id"].to_numpy(), _matrix(queries["embedding"])
            code = codes.encode(asked)
            for start in range(0, len(own), _QUERY_BLOCK):
                some = slice(start, start + _QUERY_BLOCK)
                found = shard.best(own[some], asked[some], code[some], codes.radius, neighbours)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return run


def _search(queries: DataFrame, rows: DataFrame, shards: int, codes: Codes, neighbours: int) -> DataFrame:
    """The best pairs within the radius of each query and shard; every query visits every shard once."""
    own, keys = F.xxhash64("vec_id", "embedding"), ["shard", "chunk"]
    chunks = max(math.ceil(queries.count() / SHARD_QUERIES), 1)
    held = rows.withColumns({"shard": F.pmod(own, F.lit(shards)).cast("int"), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))), "asks": F.lit(False)})
    asking = queries.withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "chunk": F.pmod(own, F.lit(chunks)).cast("int"), "asks": F.lit(True)})
    met = held.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(_visit(codes, neighbours), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, neighbours: int = NEIGHBOURS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest other rows of each row that ``is_query`` picks.

    Nearness is the largest cosine, in double precision on the given vectors; ties go to the smaller
    vec_id. Rows without vec_id and vectors that are null, zero, or hold null or non-finite components
    take no part, nor do lengths other than the commonest. Rows that repeat a vec_id are one item: the
    nearest of its vectors counts, and it is never its own neighbour. Works through stored tables when
    called; at most ``sample`` vectors come to the driver, those whose ids have the least hashes.
    """
    rows = pin(usable(vectors).distinct())
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    if not picked:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    codes = learn(np.array([row["embedding"] for row in picked]), neighbours)
    short = rows.where(is_query)
    shards = max(math.ceil(rows.count() / SHARD_ROWS), 1)

    found = None
    while not short.isEmpty():
        new = pin(_search(short, rows, shards, codes, neighbours))
        found = new if found is None else found.unionByName(new)
        if codes.radius >= BITS:
            break
        enough = new.groupBy("query_id").agg(F.count_distinct("vec_id").alias("found")).where(F.col("found") >= neighbours)
        short = short.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti").select(*rows.columns)
        codes = Codes(codes.rotation, min(codes.radius + WIDER, BITS))
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op1_nearest_neighbours": op1_nearest_neighbours}
