"""Language-model scores of whole documents, and a word model to compare with.

A text is its words (A-Z lower-cased) and one end. A frequent word of the training documents is an id of its own, any
other word becomes the subword ids of itself after a space; the end is an id, too. The chance of an id is that of its class, from a causal attention
model, times the id's share of its class, from the counts of all training documents. The frequent
ids are classes of their own; rarer ones share classes by the kind of text they occur in and frequency,
whole words, beginnings of words and other parts apart; the network tells the kind of a class first, then the class. Overlapping windows score each id once. A word's chance is that of
its ids, given that the first begins a word, times the chance that what follows begins the next one or is the end; the
chances of all words so sum to one at most. It is interpolated with the word's share of all training words,
as is usual, so that the small network need not learn the lexicon.

The base is a smoothed word model. Both take their counts from all training documents; the most frequent
words are looked up where the text is, all others through a join.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import attention
from tillhouse.llm.attention import CONTEXT, PAD, SCORED
from tillhouse.llm.bpe import encoding
from tillhouse.llm.common import remainder, slices, table
from tillhouse.staging import pin

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Classes: ids of their own; the others by topic, type (whole words, beginnings of words, other parts), and level of
#: frequency. Input buckets: ids of their own, and shared ones by topic and type.
OWN_CLASSES, TOPICS, TYPES, LEVELS = 96, 8, 3, 4
OWN_BUCKETS, SHARED_BUCKETS = 2048, 256
#: The attention model's first weights come from windows of this many documents at most, this many each.
SAMPLE_DOCS, SAMPLE_WINDOWS, EPOCHS = 2500, 10, 4
#: From there it learns from all windows of all training documents, in so many rounds of part of the windows each. They
#: are dealt by hash to shards of about so many ids, whose number and order follow from the texts alone. Weights are
#: added up in pieces, by piece.
ROUNDS, RATE, BATCH = 4, 0.004, 128
SHARD_IDS, WEIGHT_PIECES = 1_000_000, 64
#: Words that are ids of their own, at most, and how often they occur at least; rarer ones show how words are spelled.
OWN_WORDS, OWN_WORD_COUNT = 300_000, 3
#: Windows of a row of stored ids.
ROW_WINDOWS = 64
#: Ids of the most frequent kinds, by which the topic of a piece of text is told.
FREQUENT = 256
#: What part of a word's chance is its share of the counted words; the network gives the rest.
WORD_SHARE = 0.4
#: Words whose counts (16 bytes each) go to every worker; all others are joined.
HEAD_WORDS = 1_000_000
END = b"\n"  # no word holds white space
_PIECE = 1_000_000
_TEXT_BYTES = 2_000_000
_REMEMBERED_IDS, _HELD_COUNTS = 300_000, 500_000


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in lists, so that a very long text does not become objects all at once."""
    data = (text or "").encode()
    start = 0
    while start < len(data):
        end = start + _PIECE
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end].lower().split()
        start = end


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - 2**63


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows with so much text at a time that distinct words are few beside all words; a longer text comes alone."""
    for batch in batches:
        ends, start = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)), 0
        while start < batch.num_rows:
            past = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _TEXT_BYTES, "right"))
            past = max(past, start + 1)
            yield batch.slice(start, past - start)
            start = past


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``words_of`` of all texts (no nulls), and how many each text has, without an object for each word."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    parts, offsets = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(parts), 0)  # white space at the ends of a text leaves empty parts
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
    return parts.filter(real), np.diff(before)


def _coded(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts and the end; the place among them of each word, an end after each text; and the
    number of words of each text, its end included."""
    words, sizes = _split(texts)
    coded = words.dictionary_encode()
    distinct = [*coded.dictionary.cast(pa.binary()).to_pylist(), END]
    return distinct, np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(sizes), len(distinct) - 1), sizes + 1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, held = ["word", "c"], []

    def added() -> pa.Table:
        whole = pa.concat_tables(held).group_by("word").aggregate([("c", "sum")])
        held.clear()
        return whole.select(["word", "c_sum"]).rename_columns(names)

    for batch in _text_slices(batches):
        counts = _split(batch.column("text"))[0].value_counts()
        words = pa.concat_arrays([counts.field("values").cast(pa.binary()), pa.array([END], pa.binary())])
        held.append(pa.table([words, pa.concat_arrays([counts.field("counts"), pa.array([batch.num_rows])])], names))
        if sum(map(len, held)) > _HELD_COUNTS:
            held.append(added())
            if len(held[0]) > _HELD_COUNTS // 2:
                yield from held.pop().to_batches()
    if held:
        yield from added().to_batches()


def _subwords(word: bytes, path: str) -> list[int]:
    bpe = encoding(path)
    return [bpe.n_vocab] if word == END else bpe.encode_ordinary(" " + word.decode())


class _Known(dict):
    """The ids of words in four bytes each, remembered up to a bound. Words among ``own`` are ids of their own, after all others."""

    def __init__(self, path: str, own: list[bytes]):
        super().__init__()
        self.path, self.own, self.encode = path, own, encoding(path).encode_ordinary
        self.total = encoding(path).n_vocab + 1 + len(own)
        self._begin()

    def _begin(self) -> None:
        self.clear()
        ids = np.arange(self.total - len(self.own), self.total, dtype="<u4").tobytes()
        self.update((word, ids[4 * i : 4 * i + 4]) for i, word in enumerate(self.own))

    def __reduce__(self):
        return _Known, (self.path, self.own)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= len(self.own) + _REMEMBERED_IDS:
            self._begin()
        ids = self.encode(" " + word.decode()) if word != END else _subwords(word, self.path)
        found = self[word] = array("I", ids).tobytes()
        return found

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one word after the other, and how many each has."""
        found = [self[word] for word in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), lengths


_without_own = lru_cache(1)(lambda path: _Known(path, []))


def _known(path: str, own: Broadcast | None) -> _Known:
    return own.value if own else _without_own(path)


def _at(flat: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` at ``places``, where parts of these lengths follow each other."""
    sizes = lengths[places]
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1]) + np.repeat((np.cumsum(lengths) - lengths)[places] - ends + sizes, sizes)]


def _count_ids(path: str, own: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path, own)
        counts = np.zeros(known.total, np.int64)
        for batch in slices(batches, 4096):
            ids, lengths = known.of(batch.column("word").to_pylist())
            np.add.at(counts, ids, np.repeat(batch.column("c").to_numpy(), lengths))
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "n": pa.array(counts[ids])})

    return run


@dataclass
class Vocabulary:
    """Class and log share in it of every id, the input bucket of every id (PAD and the start come first), a mark
    at the classes whose ids begin a word, or are the end, and how many classes each kind has. A kind is a topic's
    classes that begin a word, or its others; classes of a kind have neighbouring numbers."""

    classes: np.ndarray
    log_share: np.ndarray
    buckets: np.ndarray
    begins: np.ndarray
    kinds: tuple[int, ...]

    @property
    def sizes(self) -> tuple[int, int, tuple[int, ...]]:
        return int(self.buckets.max()) + 1, int(self.classes.max()) + 1, self.kinds

    @staticmethod
    def of(counts: np.ndarray, path: str, pieces: list[np.ndarray], topics: np.ndarray | None = None) -> Vocabulary:
        """From the counts of all ids and their topics, or pieces of texts that show which ids occur together."""
        bpe, total = encoding(path), len(counts)
        end = bpe.n_vocab
        begins = np.array([i >= end or bpe.decode_single_token_bytes(i)[:1] == b" " for i in range(total)])
        types = np.where(np.arange(total) >= end, 0, np.where(begins, 1, 2))  # whole words, beginnings, what goes on
        order = _by_frequency(counts)
        others = order[order != end]
        classes = np.empty(total, np.int64)
        classes[[*others[: OWN_CLASSES - 1], end]] = np.arange(OWN_CLASSES)
        rest = others[OWN_CLASSES - 1 :]
        topics = _topics(pieces, order[:FREQUENT], total) if topics is None else topics
        made = OWN_CLASSES
        for topic in range(TOPICS):
            for kind in range(TYPES):
                ids = rest[(topics[rest] == topic) & (types[rest] == kind)]
                if not len(ids):
                    continue
                # Classes of about the same number of occurrences.
                weight = np.cumsum(counts[ids] + 0.5)
                level = np.unique(np.minimum((weight / weight[-1] * LEVELS).astype(int), LEVELS - 1), return_inverse=True)[1]
                classes[ids] = made + level
                made += int(level.max()) + 1
        kind_of = np.empty(made, np.int64)
        kind_of[classes] = topics * 2 + ~begins
        by_kind = np.argsort(kind_of, kind="stable")
        classes = np.argsort(by_kind).astype(np.int16)[classes]
        kinds = tuple(np.unique(kind_of, return_counts=True)[1].tolist())
        mass = np.bincount(classes, counts + 0.5)
        buckets = np.empty(total, np.int16)
        buckets[order[:OWN_BUCKETS]] = 2 + np.arange(OWN_BUCKETS)
        rare, each = order[OWN_BUCKETS:], SHARED_BUCKETS // (TOPICS * TYPES)
        buckets[rare] = 2 + OWN_BUCKETS + (topics[rare] * TYPES + types[rare]) * each + rare % each
        marks = np.bincount(classes, begins).astype(bool).astype(np.float32)
        return Vocabulary(classes, np.log((counts + 0.5) / mass[classes]), buckets, marks, kinds)

    def windows(self, texts: list[np.ndarray], leads: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input buckets, classes and marks of real positions of all windows over the texts' ids.

        The first ``leads`` ids of a text that goes on from an earlier part are not scored, but seen.
        """
        inputs, targets, marks = [], [], []
        for ids, lead in zip(texts, leads or [0] * len(texts), strict=True):
            count = -(-(len(ids) - lead) // SCORED)
            padded = np.full(CONTEXT + count * SCORED, PAD, np.int16)
            if lead:
                padded[: len(ids) - 1] = self.buckets[ids[:-1]]
                ids = ids[lead:]
            else:
                padded[CONTEXT] = 1  # the start
                padded[CONTEXT + 1 : CONTEXT + len(ids)] = self.buckets[ids[:-1]]
            target = np.zeros(count * SCORED, np.int16)
            target[: len(ids)] = self.classes[ids]
            inputs.append(np.lib.stride_tricks.sliding_window_view(padded, CONTEXT + SCORED)[::SCORED])
            targets.append(target.reshape(-1, SCORED))
            marks.append((np.arange(count * SCORED) < len(ids)).reshape(-1, SCORED))
        return np.concatenate(inputs), np.concatenate(targets), np.concatenate(marks)


def _by_frequency(counts: np.ndarray) -> np.ndarray:
    return np.lexsort((np.arange(len(counts)), -counts))


class _Topics:
    """Groups of pieces of text (mostly languages) by their frequent ids, and how often each id occurs in each."""

    def __init__(self, frequent: np.ndarray, total: int, centres: np.ndarray):
        self.column, self.width, self.centres = np.full(total, -1), len(frequent), centres
        self.column[frequent] = np.arange(len(frequent))

    def shares(self, pieces: list[np.ndarray]) -> np.ndarray:
        at = self.column[np.concatenate(pieces)]
        cells = np.repeat(np.arange(len(pieces)), [len(ids) for ids in pieces]) * self.width + at
        shares = np.sqrt(np.bincount(cells[at >= 0], minlength=len(pieces) * self.width)).astype(np.float32)
        shares = shares.reshape(len(pieces), self.width)
        return shares / (np.linalg.norm(shares, axis=1, keepdims=True) + 1e-9)

    @staticmethod
    def found(frequent: np.ndarray, total: int, pieces: list[np.ndarray]) -> _Topics:
        topics = _Topics(frequent, total, np.zeros((0, 0)))
        shares = topics.shares(pieces)
        centres = shares[np.random.default_rng(17).permutation(len(shares))[:TOPICS]]
        for _ in range(20):
            nearest = (shares @ centres.T).argmax(axis=1)
            centres = np.stack([shares[nearest == k].sum(axis=0) if (nearest == k).any() else centre for k, centre in enumerate(centres)])
            centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-9
        topics.centres = centres
        return topics

    def count(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Occurrences by id and topic, id * TOPICS + topic."""
        nearest = (self.shares(pieces) @ self.centres.T).argmax(axis=1)
        cells = np.concatenate(pieces) * TOPICS + np.repeat(nearest, [len(ids) for ids in pieces])
        return np.bincount(cells, minlength=len(self.column) * TOPICS)


def _topic_of_ids(seen: np.ndarray) -> np.ndarray:
    seen = seen.reshape(-1, TOPICS)
    return (seen / (seen.sum(axis=0) + 1)).argmax(axis=1)


def _topics(pieces: list[np.ndarray], frequent: np.ndarray, total: int) -> np.ndarray:
    """A topic for every id, from pieces of texts."""
    if not pieces:
        return np.zeros(total, np.int64)
    return _topic_of_ids(_Topics.found(frequent, total, pieces).count(pieces))


def _texts_as_ids(batches: Iterator[pa.RecordBatch], path: str, own: Broadcast | None = None) -> Iterator[np.ndarray]:
    """The ids of each text, the end included."""
    known = _known(path, own)
    for batch in _text_slices(batches):
        distinct, places, sizes = _coded(batch.column("text"))
        flat, lengths = known.of(distinct)
        ids = _at(flat, lengths, places)
        yield from np.split(ids, np.cumsum(lengths[places])[np.cumsum(sizes)[:-1] - 1])


_ENCODED = "key long, number long, lead int, ids binary"


def _encode_texts(path: str, own: Broadcast | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _text_slices(batches):
            rows: dict[str, list] = {name: [] for name in ("key", "number", "lead", "ids")}
            keys = batch.column("key").to_pylist()
            for key, ids in zip(keys, _texts_as_ids(iter([batch]), path, own), strict=True):
                for number, begin in enumerate(range(0, len(ids), ROW_WINDOWS * SCORED)):
                    lead = CONTEXT + 1 if begin else 0
                    part = ids[begin - lead : begin + ROW_WINDOWS * SCORED].astype("<u4").tobytes()
                    for name, value in zip(rows, (key, number, lead, part), strict=True):
                        rows[name].append(value)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_pydict({name: pa.array(x, t) for (name, x), t in zip(rows.items(), types, strict=True)})

    return run


def encode_texts(training: DataFrame, path: str, own: Broadcast | None = None) -> DataFrame:
    """The ids of all texts (doc_id, text; no nulls in text) as a stored table, four bytes an id, some windows in a row."""
    keyed = training.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    return pin(keyed.mapInArrow(_encode_texts(path, own), _ENCODED))


def _ids(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[int]]:
    """The ids of each row, and how many of them only lead up to it."""
    return [np.frombuffer(x, "<u4").astype(np.int64) for x in batch.column("ids").to_pylist()], batch.column("lead").to_pylist()


def _count_topics(topics: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = np.zeros(len(topics.value.column) * TOPICS, np.int64), CONTEXT + SCORED
        for batch in slices(batches):
            texts = [ids[lead:] for ids, lead in zip(*_ids(batch), strict=True)]
            seen += topics.value.count([ids[start : start + size] for ids in texts for start in range(0, len(ids), size)])
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int64()), "n": pa.array(seen[cells], pa.int64())})

    return run


def count_topics(encoded: DataFrame, topics: _Topics) -> np.ndarray:
    """How often each id occurs in each topic in all texts."""
    shared = encoded.sparkSession.sparkContext.broadcast(topics)
    found = encoded.select("lead", "ids").mapInArrow(_count_topics(shared), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(len(topics.column) * TOPICS)
    seen[found["cell"].to_numpy()] = found["n"].to_numpy()
    return seen


_WEIGHTS = "shard int, piece int, windows long, weights binary"


def _learn(shared: Broadcast, rate: float):
    """The weights after each shard's windows, times their number, in pieces; rows come sorted by shard."""

    def learned(shard: int, network: attention.Model, windows: int) -> pa.RecordBatch:
        pieces = np.array_split(network.flat().astype(np.float64) * windows, WEIGHT_PIECES)
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard] * WEIGHT_PIECES, pa.int32()), "piece": pa.array(range(WEIGHT_PIECES), pa.int32()),
            "windows": pa.array([windows] * WEIGHT_PIECES, pa.int64()), "weights": pa.array([piece.tobytes() for piece in pieces], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        shard, network, trainer, random, windows = None, None, None, None, 0
        waiting: list[tuple[np.ndarray, int]] = []

        def learn() -> int:
            if not waiting:
                return 0
            inputs, targets, marks = vocabulary.windows([ids for ids, _ in waiting], [lead for _, lead in waiting])
            order = random.permutation(len(inputs))
            for start in range(0, len(order), BATCH):
                some = order[start : start + BATCH]
                trainer.step(inputs[some], targets[some], marks[some], rate)
            waiting.clear()
            return len(inputs)

        for batch in slices(batches, 64):
            for own, ids, lead in zip(batch.column("shard").to_pylist(), *_ids(batch), strict=True):
                if own != shard:
                    windows += learn()
                    if windows:
                        yield learned(shard, network, windows)
                    shard, network, windows = own, shared.value.network.copy(), 0
                    trainer, random = attention.Trainer(network), np.random.default_rng(19)
                waiting.append((ids, lead))
                if len(waiting) >= 64:
                    windows += learn()
        windows += learn()
        if windows:
            yield learned(shard, network, windows)

    return run


def _add_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    windows: Counter[int] = Counter()
    weights: dict[int, np.ndarray] = {}
    for batch in slices(batches):
        for row in batch.to_pylist():
            piece = row["piece"]
            windows[piece] += row["windows"]
            weights[piece] = weights.get(piece, 0) + np.frombuffer(row["weights"])
    yield pa.RecordBatch.from_pydict({
        "piece": pa.array(weights, pa.int32()), "windows": pa.array([windows[piece] for piece in weights], pa.int64()),
        "weights": pa.array([x.tobytes() for x in weights.values()], pa.binary()),
    })


def learn_from_all(encoded: DataFrame, model: LanguageModel, ids: int) -> tuple[LanguageModel, int]:
    """The model after every window of all texts, and the number of windows; ``ids`` is how many ids there are.

    A round deals with a part of the rows of ids, in shards that their hashes make. Each shard goes on from the
    common weights over its own windows, in a fixed order; the next common weights are the shards' mean, weighted by
    windows. How files or partitions split the texts changes nothing.
    """
    spark, total = encoded.sparkSession, 0
    shards = max(1, round(ids / ROUNDS / SHARD_IDS))
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        part = encoded.where(F.pmod(F.xxhash64("key", "number"), F.lit(ROUNDS)) == number)
        dealt = part.withColumn("shard", F.pmod(F.xxhash64("number", "key"), F.lit(shards)).cast("int"))
        ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "key", "number", "ids")
        learned = ordered.mapInArrow(_learn(shared, RATE / (number + 1)), _WEIGHTS)
        added = learned.repartition(WEIGHT_PIECES, "piece").sortWithinPartitions("piece", "shard")
        rows = added.mapInArrow(_add_weights, "piece int, windows long, weights binary").collect()
        shared.unpersist()
        if rows:
            total += rows[0]["windows"]
            means = [np.frombuffer(row["weights"]) / row["windows"] for row in sorted(rows, key=lambda row: row["piece"])]
            model = LanguageModel(model.vocabulary, model.network.with_flat(np.concatenate(means)))
    return model, total


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    network: attention.Model

    def score(
        self, texts: list[np.ndarray], lengths: list[np.ndarray], counts: list[np.ndarray], total: int, joined: bool
    ) -> tuple[np.ndarray, list[np.ndarray]]:
        """log10 of the chance of each text: its ids (the end included), ids in each word, counts of the words.

        A word's chance is ``WORD_SHARE`` of its share of the ``total`` training words and the rest of
        what the network says of its ids and of its end; words without a count only have the latter. If counts are
        ``joined`` later, words whose count is -1 are left out of the scores, and log10 of the network's
        part of each comes beside them.
        """
        scores, left = np.zeros(len(texts)), [np.zeros(0)] * len(texts)
        windows, part = 0, []
        word_share = WORD_SHARE if total else 0.0
        for i, ids in enumerate(texts):
            part.append(i)
            windows += len(ids) // SCORED + 1
            if windows > 4096 or i == len(texts) - 1:
                inputs, targets, marks = self.vocabulary.windows([texts[j] for j in part])
                by_id, begins = (x[marks].astype(np.float64) for x in self.network.log_chances(inputs, targets, self.vocabulary.begins))
                by_id += self.vocabulary.log_share[np.concatenate([texts[j] for j in part])]
                sizes = np.concatenate([lengths[j] for j in part])
                firsts = np.cumsum(sizes) - sizes
                # That a word begins here is given; that the next one begins, or the end comes, belongs to the word.
                ends = np.append(begins[firsts[1:]], 0.0)
                ends[np.cumsum([len(lengths[j]) for j in part]) - 1] = 0.0  # nothing follows the end
                by_word = np.add.reduceat(by_id, firsts) - begins[firsts] + ends + np.log1p(-word_share)
                counted = np.concatenate([counts[j] for j in part])
                seen = np.flatnonzero(counted > 0)
                if word_share:
                    by_word[seen] = np.logaddexp(by_word[seen], np.log(word_share * counted[seen] / total))
                words = np.array([len(lengths[j]) for j in part])
                if joined:
                    for j, chances in zip(part, np.split(by_word, np.cumsum(words)[:-1]), strict=True):
                        left[j] = chances[counts[j] < 0] / np.log(10)
                    by_word[counted < 0] = 0
                scores[part] = np.add.reduceat(by_word, np.cumsum(words) - words)
                windows, part = 0, []
        return scores / np.log(10), left


def _sampled(path: str, own: Broadcast):
    """Ids of pieces of a text, evenly spread, for training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = CONTEXT + SCORED
        for batch in slices(batches, 64):
            out = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _texts_as_ids(iter([batch]), path, own), strict=True):
                starts = {round(s) for s in np.linspace(0, max(len(ids) - size, 0), SAMPLE_WINDOWS)}
                out += [(doc, start, ids[start : start + size]) for start in sorted(starts)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([d for d, _, _ in out], pa.int64()), "start": pa.array([s for _, s, _ in out], pa.int64()),
                "ids": pa.array([i for _, _, i in out], pa.list_(pa.int32())),
            })

    return run


@dataclass
class _Shared:
    """What every worker gets once: the model, the keys (sorted) and counts of the head words, the number of training
    words, and whether other words are joined later."""

    model: LanguageModel
    keys: np.ndarray
    counts: np.ndarray
    total: int
    joined: bool

    def counted(self, keys: np.ndarray) -> np.ndarray:
        """The counts of words by their keys; -1 for those outside the head."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], -1)


def _score(shared: Broadcast, path: str, own: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total, joined, known = shared.value.model, shared.value.total, shared.value.joined, _known(path, own)
        for batch in _text_slices(batches):
            distinct, places, sizes = _coded(batch.column("text"))
            keys = np.fromiter(map(word_key, distinct), np.int64, len(distinct))
            counts = shared.value.counted(keys)
            flat, lengths = known.of(distinct)
            terms = np.log10(np.maximum(counts, 0) + 0.5)
            if joined:
                terms[counts < 0] = 0
            ends = np.cumsum(sizes)
            begins, cuts = ends - sizes, ends[:-1]
            of_words, seen = lengths[places], counts[places]
            ids = np.split(_at(flat, lengths, places), np.cumsum(of_words)[cuts - 1])
            scores, left = model.score(ids, np.split(of_words, cuts), np.split(seen, cuts), total, joined)
            rare = [keys[x[c < 0]] if joined else keys[:0] for x, c in zip(np.split(places, cuts), np.split(seen, cuts), strict=True)]
            columns = [sizes, np.add.reduceat((seen > 0).astype(np.int64), begins), np.add.reduceat(terms[places], begins), rare, left]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
            names = ["n_tokens", "head_known", "head_base", "rare", "chances"]
            others = {name: batch.column(name) for name in ("row_id", "doc_id")}
            yield pa.RecordBatch.from_pydict(
                others
                | {name: pa.array(values, kind) for name, values, kind in zip(names, columns, kinds, strict=True)}
                | {"head_score": pa.array(scores, pa.float64())}
            )

    return run


def _frequent(counted: DataFrame, words: int) -> Column:
    """A condition on ``c`` for the most frequent words, by the levels of frequency that hold so many of them at most."""
    level = F.floor(F.log2("c") * 8).cast("int")
    levels = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    held, least = 0, None
    for row in sorted(levels, key=lambda row: -row["level"]):
        held += row["words"]
        if held > words:
            break
        least = row["level"]
    return level >= least if least is not None else F.lit(False)


def _own_words(counted: DataFrame) -> list[bytes]:
    """The words that become ids."""
    found = counted.where(_frequent(counted, OWN_WORDS) & (F.col("c") >= OWN_WORD_COUNT)).select("word").toArrow()
    return sorted(word for word in found["word"].to_pylist() if word != END)


def score_texts(docs: DataFrame, is_training: str, path: str = RANKS, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``is_training`` is the SQL condition (on doc_id) of the rows to learn from. A null text is empty:
    one token, the end. Repeated rows and null ids stay, other columns are ignored. Words are matched
    by 64-bit hashes. Without training rows all classes are equally likely and the base is 0 a token.
    Works through stored tables when called.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    training = texts.where(is_training)
    counted = pin(training.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    total, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    kept = counted.mapInArrow(_keyed, "word_key long, c long")
    known = _Known(path, _own_words(counted))
    own = spark.sparkContext.broadcast(known)
    found = counted.mapInArrow(_count_ids(path, own), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    id_counts = np.zeros(known.total)
    id_counts[found["id"].to_numpy()] = found["n"].to_numpy()

    chosen = training.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    read = training.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = read.mapInArrow(_sampled(path, own), "doc_id long, start long, ids array<int>").toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("start", "ascending")])
    ids = sample["ids"].combine_chunks()
    places = ids.offsets.to_numpy()
    pieces = np.split(ids.flatten().to_numpy().astype(np.int64), places[1:-1] - places[0]) if len(ids) else []
    topics = None
    encoded = encode_texts(training, path, own)
    if pieces:
        grouped = _Topics.found(_by_frequency(id_counts)[:FREQUENT], len(id_counts), pieces)
        topics = _topic_of_ids(count_topics(encoded, grouped))
    vocabulary = Vocabulary.of(id_counts, path, pieces, topics)
    network = attention.fresh(*vocabulary.sizes)
    if pieces:
        begins = [start == 0 for start in sample["start"].to_pylist()]
        network = attention.train(network, *_training_windows(vocabulary, begins, pieces), EPOCHS)
    del sample, ids, pieces
    model, _ = learn_from_all(encoded, LanguageModel(vocabulary, network), int(id_counts.sum()))

    head = kept.where(_frequent(counted, head_words))
    head = head.toArrow().sort_by("word_key")
    keys, counts = head["word_key"].to_numpy(), head["c"].to_numpy()
    del head
    joined = distinct > len(keys)  # else every word of the training documents is in the head: the others have no count
    shared = spark.sparkContext.broadcast(_Shared(model, keys, counts, total, joined))
    kinds = (
        "row_id long, doc_id long, n_tokens long, head_known long, head_base double, rare array<long>, chances array<double>, head_score double"
    )
    numbered = texts.withColumn("row_id", F.monotonically_increasing_id())
    scored = pin(numbered.mapInArrow(_score(shared, path, own), kinds))

    if joined:
        rare = scored.select("row_id", F.explode(F.arrays_zip("rare", "chances")).alias("w")).select("row_id", F.col("w.rare").alias("word_key"), "w.chances")
        c = F.coalesce("c", F.lit(0))
        share = F.log10(F.lit(WORD_SHARE) * c / F.lit(float(total)))
        both = F.greatest("chances", share) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(F.col("chances") - share)))
        looked_up = rare.join(kept, "word_key", "left").groupBy("row_id").agg(
            F.sum(F.log10(c + 0.5)).alias("rare_base"), F.sum((c > 0).cast("long")).alias("rare_known"),
            F.sum(F.when(c > 0, both).otherwise(F.col("chances"))).alias("rare_score"),
        )
        scored = scored.join(looked_up, "row_id", "left")
    else:
        scored = scored.withColumns({"rare_base": F.lit(0.0), "rare_known": F.lit(0), "rare_score": F.lit(0.0)})
    per_token = F.log10(F.lit(total + 0.5 * (distinct + 1)))
    return scored.select(
        "doc_id", "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4096):
        keys = [word_key(word) for word in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_pydict({"word_key": pa.array(keys, pa.int64()), "c": batch.column("c")})


def _training_windows(vocabulary: Vocabulary, begins: list[bool], pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inputs, classes, marks = [], [], []
    for begin, ids in zip(begins, pieces, strict=True):
        if begin:
            x, y, m = vocabulary.windows([ids[:SCORED]])
        else:
            shifted = np.full(CONTEXT + SCORED, PAD, np.int16)
            late = len(ids) - CONTEXT
            shifted[: len(ids) - 1] = vocabulary.buckets[ids[:-1]]
            x = shifted[None, :]
            y = np.zeros((1, SCORED), np.int16)
            # The input at position CONTEXT + t stands before the token it is to predict.
            y[0, : late - 1] = vocabulary.classes[ids[CONTEXT + 1 :]]
            m = (np.arange(SCORED) < late - 1)[None, :]
        inputs.append(x), classes.append(y), marks.append(m)
    return np.concatenate(inputs), np.concatenate(classes), np.concatenate(marks)


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    in_fold = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5, -1)"
    scored = score_texts(docs, f"{in_fold} != 1")
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES = {"op3_lm_score": op3_lm_score}
