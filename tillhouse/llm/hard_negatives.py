"""Hard-negative mining by branch and bound over vertically stored vectors (BOND).

Rows lie in blocks as columns, one array per dimension. An anchor reads the dimensions in the order of
its own descending magnitude and adds up partial scores; what the dimensions still to come can add at
least and at most follows from the least and largest value of each column. With these bounds the
candidates of a block shrink until the first rows of the same label (positives), or the windows below
the positives' scores (negatives), are exact. Every anchor meets every row, in blocks of bounded size,
and only the first few of each block go on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import sorted_groups, table
from tillhouse.staging import pin

POSITIVES, NEGATIVES = 5, 5
LOWEST, HIGHEST = 80, 100
SCALE = 256
#: Rows of a block, and anchors that meet it in one task, about.
ROWS, ANCHORS = 8192, 2048
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Whole numbers up to here, and sums of their products, are exact as doubles.
_EXACT = 2.0**52

Needed = Callable[[np.ndarray, np.ndarray], np.ndarray]


def usable(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part, one for each vec_id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = rows.where("vec_id is not null and label is not null and vector is not null").where(~bad)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Components times ``scale`` as whole numbers, rounded down; Python integers where doubles are not exact."""
    scaled = np.floor(vectors * scale)
    if scaled.size and np.abs(scaled).max() >= _EXACT:
        return np.array([[math.floor(x) for x in row] for row in scaled.tolist()], object).reshape(scaled.shape)
    return scaled


@dataclass
class Block:
    """Some rows by columns, those of a label side by side."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Block:
        order = np.lexsort((ids, labels))
        return cls(ids[order], labels[order], np.ascontiguousarray(vectors[order].T))

    def __post_init__(self) -> None:
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def of_label(self, label: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows with this label, and of all others."""
        begin, end = np.searchsorted(self.labels, [label, label + 1])
        return np.arange(begin, end), np.r_[0:begin, end : len(self.labels)]

    def scan(self, anchor: np.ndarray, rows: np.ndarray, needed: Needed) -> tuple[np.ndarray, np.ndarray]:
        """The rows that ``needed`` keeps, by bounds on their scores, and their exact scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = anchor * self.low, anchor * self.high
        least, most = (np.append(np.cumsum(pick(*ends)[order][::-1])[::-1], 0) for pick in (np.minimum, np.maximum))
        score = np.zeros(len(rows), anchor.dtype)
        for start in range(0, len(order), STEP):
            dims = order[start : start + STEP]
            read = self.columns[dims] if len(rows) == len(self.ids) else self.columns[np.ix_(dims, rows)]
            score = score + anchor[dims] @ read
            done = start + len(dims)
            alive = needed(score + least[done], score + most[done])
            rows, score = rows[alive], score[alive]
        return rows, score


def _among_first(count: int) -> Needed:
    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= count:
            return np.ones(len(low), bool)
        return (high >= np.partition(low, -count)[-count]).astype(bool)

    return needed


def _among_first_in(windows: list[tuple[int, int]], count: int) -> Needed:
    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(low), bool)
        for least, most in windows:
            possible = (high >= least) & (low <= most)
            sure = low[((low >= least) & (high <= most)).astype(bool)]
            if len(sure) >= count:
                possible &= high >= np.partition(sure, -count)[-count]
            kept |= possible.astype(bool)
        return kept

    return needed


def window(positive_score: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The whole scores from ``lowest`` to ``highest`` percent of a positive's score."""
    return -(-lowest * positive_score // 100), highest * positive_score // 100


def _first(ids: np.ndarray, scores: np.ndarray, count: int) -> list[tuple[int, int]]:
    order = np.lexsort((ids, -scores)) if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
    return [(int(ids[i]), int(scores[i])) for i in order[:count]]


def _positives(count: int):
    def find(block: Block, own: int, label: int, anchor: np.ndarray, scores: None) -> Iterator[tuple[int, ...]]:
        rows = block.of_label(label)[0]
        rows, found = block.scan(anchor, rows[block.ids[rows] != own], _among_first(count))
        for other, score in _first(block.ids[rows], found, count):
            yield own, other, score

    return find, "anchor_id long, positive_id long, positive_score long"


def _negatives(count: int, lowest: int, highest: int):
    def find(block: Block, own: int, label: int, anchor: np.ndarray, scores: list[int]) -> Iterator[tuple[int, ...]]:
        windows = {score: window(score, lowest, highest) for score in set(scores)}
        windows = {score: ends for score, ends in windows.items() if ends[0] <= ends[1]}
        if not windows:
            return
        rows, found = block.scan(anchor, block.of_label(label)[1], _among_first_in(list(windows.values()), count))
        for positive, (least, most) in windows.items():
            inside = ((found >= least) & (found <= most)).astype(bool)
            for other, score in _first(block.ids[rows[inside]], found[inside], count):
                yield own, positive, other, score

    return find, "anchor_id long, positive_score long, negative_id long, negative_score long"


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    return rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, width)


_CELL = ["width", "block", "chunk"]


def _meet(find: Callable, names: list[str], scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_groups(batches, _CELL):
            width = cell["width"][0].as_py()
            asking, rows = cell.filter(cell["asks"]), cell.filter(pa.compute.invert(cell["asks"]))
            if not asking.num_rows or not rows.num_rows:
                continue
            values, anchors = whole(_matrix(rows, width), scale), whole(_matrix(asking, width), scale)
            if values.size and np.abs(values).max() * float(np.abs(anchors).max()) * width >= _EXACT:
                values, anchors = (np.array([list(map(int, r)) for r in m.tolist()], object).reshape(m.shape) for m in (values, anchors))
            block = Block.of(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), values)
            found: list[tuple[int, ...]] = []
            asked = zip(*(asking[name].to_pylist() for name in ("vec_id", "label", "scores")), anchors, strict=True)
            for own, label, scores, anchor in asked:
                found += find(block, own, label, anchor, scores)
            if found:
                columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _blocks(rows: DataFrame, anchors: DataFrame, find: Callable, schema: str, scale: int) -> DataFrame:
    """What ``find`` yields for every anchor and every block of rows with vectors of the anchor's length."""
    own = F.xxhash64("vec_id")
    blocks = rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
    chunks = anchors.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("chunks"))
    sizes = blocks.join(chunks, "width")
    held = rows.join(sizes, "width").withColumns({
        "block": F.pmod(own, "blocks").cast("int"), "chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)),
        "asks": F.lit(False), "scores": F.lit(None).cast("array<long>"),
    })
    asks = anchors.join(sizes, "width").withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "chunk": F.pmod(own, "chunks").cast("int"), "asks": F.lit(True),
    })
    dealt = held.unionByName(asks).drop("blocks", "chunks").repartition(*_CELL).sortWithinPartitions(*_CELL)
    names = [field.split()[0] for field in schema.split(", ")]
    return dealt.mapInArrow(_meet(find, names, scale), schema)


def _ranked(df: DataFrame, keys: list[str], score: str, other: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of rows that ``is_anchor`` picks.

    ``vectors`` has vec_id, embedding and label, or the column given as ``label``; other columns are ignored. A
    component counts as floor(``scale`` * component), a row's score is its inner product with the anchor, an
    exact whole number; higher scores come first, ties by smaller vec_id. An anchor's positives are its first
    other rows of the same label, and for each of them follow the first rows of other labels whose scores are
    from ``lowest`` to ``highest`` percent of the positive's. Rows without vec_id, label or vector, and vectors that
    hold null or non-finite components, take no part; of rows that repeat a vec_id the one with the least label and
    vector does. Vectors of different lengths have no score. Scores past bigint fail the job. Works through
    stored tables when called.
    """
    rows = usable(vectors, label).withColumn("width", F.size("vector"))
    rows = pin(rows)
    no_scores = F.lit(None).cast("array<long>")
    anchors = rows.where(is_anchor).withColumn("scores", no_scores)
    near = _blocks(rows, anchors, *_positives(positives), scale)
    near = pin(_ranked(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"))
    scores = near.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))
    asking = anchors.drop("scores").join(scores.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    asking = pin(asking.select(*anchors.columns))
    hard = _blocks(rows, asking, *_negatives(negatives, lowest, highest), scale)
    hard = _ranked(hard, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    return near.join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    given = F.col("label")
    label = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    return mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {"op11_hard_negatives": op11_hard_negatives}

ORACLE_SQL = {
    "op11_hard_negatives": """
with given as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as vector
  from embeddings
  where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    cast(list_sum(list_transform(list_zip(a.vector, b.vector), lambda p: p[1] * p[2])) as bigint) as score
  from given a join given b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.vector) = len(b.vector)),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank,
  other_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other_id) <= 5
""",
}
