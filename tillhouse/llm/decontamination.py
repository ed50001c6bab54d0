"""Benchmark decontamination by runs of words at fixed distances.

Words are hashed in runs of ``GRAM``: of an item all runs, of a document those that begin at every
``WINDOW - GRAM + 1``-th word. As many runs lie in a window of ``WINDOW`` words, so one of them is such a
run wherever the window is in the document: every window that an item and a document share is found by
joining the hashes, once, and none by chance, because each hit is extended by comparing the words around it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import KEYS, ascii_lower, repeat_rows, row_keys, table
from tillhouse.staging import pin

WINDOW = 10
GRAM = 5
PRINTS = "array<struct<hash:bigint,position:int,lead:int,around:array<string>,n_words:int>>"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words_of(text: Column) -> Column:
    """Maximal runs of digits, letters and all characters past ASCII, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; a plain column would be computed anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _prints(words: Column, step: int) -> Column:
    """Hash, position and the words around each ``step``-th run; empty for fewer than ``WINDOW`` words."""

    def entry(i: Column) -> Column:
        lead = F.least(i, F.lit(WINDOW - GRAM))
        return F.struct(
            F.xxhash64(*[F.get(words, i + j) for j in range(GRAM)]).alias("hash"),
            i.alias("position"),
            lead.alias("lead"),
            F.slice(words, i - lead + 1, F.lit(2 * WINDOW - GRAM)).alias("around"),
            F.lit(0).alias("n_words"),
        )

    places = F.sequence(F.lit(0), F.greatest(F.size(words) - GRAM, F.lit(0)), F.lit(step))
    return F.when(F.size(words) >= WINDOW, F.transform(places, entry)).otherwise(F.array().cast(PRINTS))


def _item_prints(items: DataFrame) -> DataFrame:
    rows = items.select("item_id", F.explode(_prints(F.col("words"), 1)).alias("p"))
    return rows.select(
        "item_id", F.col("p.hash").alias("hash"), F.col("p.lead").alias("item_lead"), F.col("p.around").alias("item_around")
    ).distinct()


def _runs_of(n: int) -> Callable[[Column], Column]:
    """Every run of ``n`` words, joined by spaces, which no word holds."""

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words) - n + 1)
        return F.when(F.size(words) >= n, F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " ")))

    return runs


def find_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, those inside any benchmark window, and the items found.

    A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item. Nulls and
    texts without words have no windows and no hits. Rows equal in doc_id and text are worked on once
    and written as often as they came; a null item_id is found under the empty name; other columns are
    ignored. Whether the items' hashes are broadcast is Spark's decision by their stored size.
    """
    items = pin(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
    )
    def marked(words: Column) -> Column:
        marker = F.struct(
            F.xxhash64("doc_id", "text_key").alias("hash"),  # spreads; a chance hit has no words to match
            F.lit(-1).alias("position"),
            F.lit(0).alias("lead"),
            F.array().cast("array<string>").alias("around"),
            F.size(words).alias("n_words"),
        )
        return F.concat(F.array(marker), _prints(words, WINDOW - GRAM + 1))

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = texts.select("doc_id", "text_key", F.explode(_let(words_of(F.col("text")), marked)).alias("p")).select(
        "doc_id", "text_key", "p.*"
    )

    def same(back: Column) -> Column:
        ours = F.slice("around", F.col("lead") - back + 1, F.lit(WINDOW))
        theirs = F.slice("item_around", F.col("item_lead") - back + 1, F.lit(WINDOW))
        return (back <= F.col("lead")) & (back <= F.col("item_lead")) & (F.size(ours) == WINDOW) & (ours == theirs)

    steps_back = F.sequence(F.lit(0), F.lit(WINDOW - GRAM))
    matched = (
        rows.join(pin(_item_prints(items)), "hash", "left")
        .where("position = -1 or item_id is not null")
        .withColumn("back", F.when((F.col("position") >= 0), F.filter(steps_back, same)))
        .where("position = -1 or size(back) > 0")
    )
    hits = matched.select(
        "doc_id", "text_key", "n_words",
        F.when(F.col("position") >= 0, F.col("item_id")).alias("item_id"),
        F.explode_outer("back").alias("back"), "position",
    ).select(
        "doc_id", "text_key", "n_words", "item_id", (F.col("position") - F.col("back")).alias("first"),
        (F.col("position") - F.col("back") + WINDOW).alias("past"), F.when(F.col("position") < 0, 1).otherwise(0).alias("copies"),
    ).withColumn("copies", F.when(F.col("item_id").isNull(), F.col("copies")).otherwise(0))

    short = items.where(F.size("words") < WINDOW).select("item_id", F.size("words").alias("length"), F.array_join("words", " ").alias("run"))
    for row in short.select("length").distinct().collect():  # lengths 1 to WINDOW - 1
        n = row["length"]

        runs = F.posexplode(_let(words_of(F.col("text")), _runs_of(n))).alias("first", "run")
        at = texts.select("doc_id", "text_key", F.lit(0).alias("n_words"), runs)
        found = at.join(short.where(F.col("length") == n).drop("length").distinct(), "run").select(
            "doc_id", "text_key", "n_words", "item_id", "first", (F.col("first") + n).alias("past"), F.lit(0).alias("copies")
        )
        hits = hits.unionByName(found)

    span = F.when(F.col("item_id").isNotNull(), F.struct("first", "past"))
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def cover(seen: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0), span["past"] - F.greatest(seen["end"], span["first"]))
        return F.struct(F.greatest(seen["end"], span["past"]).alias("end"), (seen["total"] + fresh).alias("total"))

    per_doc = hits.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.sum("copies").alias("copies"),
        F.aggregate(F.sort_array(F.collect_set(span)), nothing, cover)["total"].cast("bigint").alias("n_hit"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    full = per_doc.select(
        "doc_id", "text_key", "n_words", "n_hit", "copies", "items",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
    return full


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with the benchmark."""
    found = find_hits(docs, benchmark).where("contaminated").select(
        F.col("doc_id").isNull().alias("key_no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("key_id"),
        F.col("text_key").alias("key_text"),
    )
    return row_keys(docs).join(pin(found), KEYS, "left_anti").select(*docs.columns)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return repeat_rows(found, "copies", RESULT)


QUERIES = {"op8_decontamination": op8_decontamination}
