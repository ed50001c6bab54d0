"""Spelling variants by a dictionary of pairs of trie nodes.

The words of a corpus form two tries, one read forwards and one read backwards, whose nodes are
numbered. A word then is a list of pairs (prefix node, suffix node): at every position one pair that
skips its letter and, between letters, one pair that leaves a gap. Equal pairs mean equal letters before
and after the place, so words that share a skipping pair differ by one replaced letter, and a skipping
pair that equals a gap pair is a letter inserted or deleted. Pairs are integers of fixed size and are
met in one shuffle; a pair names the letters around one place, so no more words than letters of the
alphabet can share it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import slices, table
from tillhouse.staging import pin

MIN_LENGTH, MIN_COUNT, FACTOR = 5, 3, 2
#: One letter is deleted where the crc32 of document and run is a multiple of this.
DELETE = 97
#: A-Z arrive lower-cased; the range takes in the two signs between the letters.
_RUNS = re.compile("[a-zÀ-ÿ]+")
#: Words that a task remembers, letters of deleted forms, and characters that it splits into runs at once.
_MEMORY, _DELETED, _PIECE = 200_000, 4_000_000, 1_000_000
#: Runs of more bytes are hashed one by one.
_SHORT = 64
_ZERO_BYTE = np.array([zlib.crc32(b"\0", i) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
#: Numbers of nodes shared by neighbouring parts are (first part, depth); all others (part, counter).
_SHARED = 1 << 62
_PART_BITS = 32
_ROWS = 200_000


def _pieces(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of a text, a bounded number of characters at a time."""
    text = text.encode().lower().decode()
    if len(text) <= _PIECE:
        yield _RUNS.findall(text)
        return
    runs, held = [], 0
    for match in _RUNS.finditer(text):
        runs.append(match.group())
        held += len(runs[-1])
        if held > _PIECE:
            yield runs
            runs, held = [], 0
    yield runs


class Counts:
    """Counts of runs, some with one letter deleted; crc32 of a run in a document from those of its parts.

    crc32 is linear: that of ``document:run`` is that of ``document:`` moved on by the run's length,
    xor that of the run, which is the same in all documents.
    """

    def __init__(self, least: int):
        self.least = least
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.hashes = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.deleted: Counter[str] = Counter()
        self.deleted_letters = 0

    def _learn(self, runs: set[str]) -> None:
        new = [run for run in runs if run not in self.ids]
        self.ids.update(zip(new, range(len(self.ids), len(self.ids) + len(new)), strict=True))
        raw = [run.encode() for run in new]
        self.hashes = np.append(self.hashes, np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)))
        self.sizes = np.append(self.sizes, np.fromiter(map(len, raw), np.int64, len(raw)))
        self.counts = np.append(self.counts, np.zeros(len(raw), np.int64))

    def add(self, keys: list[str], runs: list[list[str]]) -> None:
        """Count the runs of some documents, named by their keys."""
        flat = [run for some in runs for run in some]
        if not flat:
            return
        self._learn(set(flat))
        ids = np.fromiter(map(self.ids.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(runs)), [len(some) for some in runs])
        starts = np.array([zlib.crc32(f"{key}:".encode()) for key in keys], np.uint32)
        moved = np.empty((_SHORT + 1, len(starts)), np.uint32)
        moved[0] = starts
        for size in range(1, _SHORT + 1):
            moved[size] = _ZERO_BYTE[moved[size - 1] & np.uint32(255)] ^ (moved[size - 1] >> np.uint32(8))
        sizes = self.sizes[ids]
        hashes = moved[np.minimum(sizes, _SHORT), doc] ^ self.hashes[ids]
        for i in np.flatnonzero(sizes > _SHORT).tolist():
            hashes[i] = zlib.crc32(flat[i].encode(), int(starts[doc[i]]))
        cut = hashes % np.uint32(DELETE) == 0
        self.counts += np.bincount(ids[~cut], minlength=len(self.counts))
        for i in np.flatnonzero(cut).tolist():
            at = int(hashes[i]) % len(flat[i])
            word = flat[i][:at] + flat[i][at + 1 :]
            if len(word) >= self.least:
                self.deleted[word] += 1
                self.deleted_letters += len(word)

    @property
    def full(self) -> bool:
        return len(self.ids) > _MEMORY or self.deleted_letters > _DELETED

    def rows(self) -> pa.RecordBatch:
        counts = self.counts.tolist()
        found = self.deleted
        for word, i in self.ids.items():
            if counts[i] and len(word) >= self.least:
                found[word] += counts[i]
        self.clear()
        return pa.RecordBatch.from_pydict({"word": list(found), "n": pa.array(found.values(), pa.int64())}, _COUNTED)


_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(least)
        for batch in slices(batches, 64):
            keys, runs, held = [], [], 0
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for piece in _pieces(text or ""):
                    keys.append("" if key is None else key), runs.append(piece)
                    held += len(piece)
                    if held > _PIECE:
                        counts.add(keys, runs)
                        keys, runs, held = [], [], 0
            counts.add(keys, runs)
            if counts.full:
                yield counts.rows()
        yield counts.rows()

    return run


def words(docs: DataFrame, least_length: int = MIN_LENGTH, least_count: int = MIN_COUNT) -> DataFrame:
    """word and n of the words of ``docs`` (doc_id, text).

    A word is a maximal run of letters a-z, A-Z and U+00C0 to U+00FF, with A-Z lower-cased; where the crc32 of
    ``<doc_id>:<run>`` is a multiple of 97 it lacks one letter. Null texts have no words, a null doc_id counts as
    the empty text, rows that repeat count each time, other columns are ignored.
    """
    found = docs.select("doc_id", "text").mapInArrow(_count(least_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    end = min(len(a), len(b))
    if a[:end] == b[:end]:
        return end
    low, high = 0, end  # the beginnings of length low agree, those of length high do not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def shared_paths(ends: list[tuple[int, str, str]]) -> dict[int, tuple[str, list[int]]]:
    """For every part (number, first, last word) its last word and the nodes that the next part has too.

    Nodes are given by the first part that has them, from depth 1 on.
    """
    found, before = {}, []
    for (part, first, last), after in zip(ends, [*ends[1:], None], strict=False):
        depth = _common(last, after[1]) if after else 0
        path = before[: min(depth, _common(first, last))]
        path = path + [part] * (depth - len(path))
        found[part] = (last, path)
        before = path
    return found


def _number(paths: dict[int, tuple[str, list[int]]], before: dict[int, list[int]], key: str):
    """Per word, in order, the numbers of the nodes on its path below the root."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("rank", pa.int64()), ("nodes", pa.list_(pa.int64()))])

    def number(first_part: int, depth: int) -> int:
        return _SHARED | first_part << _PART_BITS | depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, counter, previous, nodes = None, 0, 0, "", []
        last, after = "", []
        for batch in batches:
            ranks, offsets, values = [], [0], []
            for own, word in zip(batch.column("part").to_pylist(), batch.column(key).to_pylist(), strict=True):
                if own != part:
                    part, place, counter, previous = own, 0, 0, word
                    last, after = paths[part]
                    nodes = [number(f, d) for d, f in enumerate(before[part], 1)]
                    common = len(nodes)
                else:
                    common = _common(previous, word)
                    nodes = nodes[:common]
                    previous = word
                tail = min(_common(word, last), len(after))
                nodes += [number(after[d - 1], d) for d in range(common + 1, tail + 1)]
                new = len(word) - len(nodes)
                nodes += range((part << _PART_BITS) + counter + 1, (part << _PART_BITS) + counter + 1 + new)
                counter += new
                ranks.append((part << _PART_BITS) + place)
                place += 1
                values += nodes
                offsets.append(len(values))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(ranks, pa.int64()), lists], schema=schema)

    return run


def trie(words: DataFrame, backwards: bool = False) -> DataFrame:
    """word, n, rank in the order of the trie, and the numbers of its nodes on the way from the root (0, left out).

    One range sort; parts of it are numbered side by side. Of each part only its first and last word come to the
    driver, from which follow the nodes that it shares with the part before.
    """
    keyed = words.withColumn("key", F.reverse("word") if backwards else F.col("word"))
    parts = pin(keyed.repartitionByRange("key").withColumn("part", F.spark_partition_id().cast("long")))
    ends = parts.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    paths = shared_paths([tuple(row) for row in ends])
    before = dict(zip(paths, [[], *[path for _, path in paths.values()]], strict=False))
    ordered = parts.repartition("part").sortWithinPartitions("part", "key")
    return ordered.mapInArrow(_number(paths, before, "key"), "word string, n long, rank long, nodes array<long>")


_GAP, _SKIP, _SKIP_AGAIN = 0, 1, 2
_PAIRS = "prefix long, suffix long, kind byte, rank long, n long"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each word: gaps, and skipped letters, of a run of equal letters the last as the one that counts."""
    for batch in slices(batches, 4096):
        forwards, backwards, kinds, owner = [], [], [], []
        columns = (batch.column(name) for name in ("word", "prefixes", "suffixes"))
        for i, (word, prefixes, suffixes) in enumerate(zip(*(c.to_pylist() for c in columns), strict=True)):
            prefixes, suffixes = [0, *prefixes], [*reversed(suffixes), 0]
            forwards += prefixes
            forwards += prefixes[:-1]
            backwards += suffixes
            backwards += suffixes[1:]
            kinds += [_GAP] * len(prefixes)
            kinds += [_SKIP_AGAIN if a == b else _SKIP for a, b in zip(word, word[1:], strict=False)] + [_SKIP]
            owner += [i] * (2 * len(word) + 1)
        owner = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "prefix": pa.array(forwards, pa.int64()), "suffix": pa.array(backwards, pa.int64()), "kind": pa.array(kinds, pa.int8()),
            "rank": batch.column("rank").take(owner), "n": batch.column("n").take(owner),
        })


def _meet(prefix: np.ndarray, suffix: np.ndarray, kind: np.ndarray, rank: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """rank, near, best_n, best of words that meet others in whole groups of equal pairs."""
    change = np.ones(len(prefix), bool)
    change[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    group = np.cumsum(change) - 1
    alone = np.bincount(group) == 1
    some = ~alone[group]
    group, kind, rank, n = group[some], kind[some], rank[some], n[some]
    order = np.lexsort((rank, -n, group))
    group, kind, rank, n = group[order], kind[order], rank[order], n[order]
    groups = len(alone)

    def first(rows: np.ndarray) -> np.ndarray:
        """Per group the first of some rows, which are in order; -1 without."""
        found = np.full(groups, -1)
        found[group[rows[::-1]]] = rows[::-1]
        return found

    skips, counted, gaps = np.flatnonzero(kind != _GAP), np.flatnonzero(kind == _SKIP), np.flatnonzero(kind == _GAP)
    best = first(skips)
    second = first(skips[best[group[skips]] != skips])
    gap, best_counted = first(gaps), first(counted)
    own, near, other = [], [], []

    # Words that skip the same place differ there by one replaced letter.
    rows = skips[second[group[skips]] >= 0]
    sizes = np.bincount(group[skips], minlength=groups)
    own.append(rows), near.append(sizes[group[rows]] - 1)
    other.append(np.where(best[group[rows]] == rows, second[group[rows]], best[group[rows]]))
    # The word with a gap at this place is the one that lacks the letter.
    rows = counted[gap[group[counted]] >= 0]
    own.append(rows), near.append(np.ones(len(rows), np.int64)), other.append(gap[group[rows]])
    rows = gaps[best_counted[group[gaps]] >= 0]
    sizes = np.bincount(group[counted], minlength=groups)
    own.append(rows), near.append(sizes[group[rows]]), other.append(best_counted[group[rows]])
    own, near, other = np.concatenate(own), np.concatenate(near), np.concatenate(other)
    return [rank[own], near, n[other], rank[other]]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["rank", "near", "best_n", "best"]
    held: list[np.ndarray] | None = None

    def rows(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in _meet(*columns)], names=names)

    for batch in batches:
        new = [batch.column(name).to_numpy() for name in ("prefix", "suffix", "kind", "rank", "n")]
        held = new if held is None else [np.concatenate(both) for both in zip(held, new, strict=True)]
        if len(held[0]) < _ROWS:
            continue
        last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield rows([c[:cut] for c in held])
            held = [c[cut:] for c in held]
    if held is not None and len(held[0]):
        yield rows(held)


def _roots(forms: DataFrame) -> DataFrame:
    """rank and root of every row of ``forms`` (rank, form), by doubling the steps; chains end, as counts grow."""
    steps = pin(forms.select("rank", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not steps.where("open").isEmpty():
        ahead = steps.select(F.col("rank").alias("root"), F.col("root").alias("ahead"))
        moved = steps.where("open").join(ahead, "root", "left")
        moved = moved.select("rank", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("open"))
        steps = pin(moved.unionByName(steps.where("not open")))
    return steps.select("rank", "root")


def variants(found: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``found`` (word, n; words once each, not null or empty).

    Two words are near if one inserted, deleted or replaced code point makes them equal. A word's form is its
    near word of largest n, of equal ones the first in code-point order, if that n is at least ``factor`` (2 or
    more) times its own; root is where forms lead in the end. Works through stored tables when called.
    """
    if factor < 2:
        raise ValueError("forms lead in circles below a factor of 2")
    forwards = trie(found).withColumnRenamed("nodes", "prefixes")
    backwards = trie(found, backwards=True).select("word", F.col("nodes").alias("suffixes"))
    named = pin(forwards.join(backwards, "word"))
    pairs = named.mapInArrow(_pairs, _PAIRS).repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    met = pairs.mapInArrow(_neighbours, "rank long, near long, best_n long, best long")
    met = met.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"))
    best_n = -F.col("first.less")
    has_form = best_n >= factor * F.col("n")
    near = named.select("rank", "word", "n").join(met, "rank", "left")
    near = near.select("rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                       F.when(has_form, F.col("first.best")).alias("form_rank"), F.when(has_form, best_n).alias("form_n"))
    near = pin(near)
    formed = near.where("form_rank is not null")
    led = _roots(formed.select("rank", F.col("form_rank").alias("form")))
    texts = near.select(F.col("rank").alias("to"), F.col("word").alias("text"))
    formed = formed.join(led, "rank").join(texts.withColumnsRenamed({"to": "form_rank", "text": "form"}), "form_rank")
    formed = formed.join(texts.withColumnsRenamed({"to": "root", "text": "root_word"}), "root")
    formed = formed.select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n")
    rest = near.where("form_rank is null")
    none = F.lit(None).cast("string")
    return formed.unionByName(rest.select("word", none.alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(pin(words(table(spark, folder, "documents"))))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
