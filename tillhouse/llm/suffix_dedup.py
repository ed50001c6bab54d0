"""Removal of every byte inside a string of ``SPAN`` bytes that also starts earlier.

Strings are dealt out before they are sorted. Each string of ``SPAN`` bytes is placed by the least
hash of the ``GRAM``-byte pieces inside it; neighbours mostly share that piece, so a document becomes
runs of strings with one least piece, some ``SPAN - GRAM`` / 2 bytes apart. Equal strings have the same
least piece, hence a piece that occurs once holds no repeat and its run is done. Runs with the same
piece and the same bytes repeat as a whole. What is left, runs of one piece with different bytes, as
at the edges of a copied passage, goes to suffix arrays (difference cover of three), each over the
runs of the pieces dealt to a task; equal prefixes of ``SPAN`` bytes are then next to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import slices, table
from tillhouse.llm.suffix_array import suffix_array
from tillhouse.staging import pin

SPAN, GRAM = 100, 32
WIDTH = SPAN - GRAM + 1
#: Bytes of runs in one suffix array, about; runs of a piece beyond which its strings are dealt out singly, as they
#: are beyond twice these bytes.
ARRAY_BYTES, HOT_RUNS = 1_000_000, 10_000
#: Strings of one run at most: in long periodic texts a piece comes again and again. A number that most short periods
#: divide, so that the runs of such a text are the same bytes.
LONGEST = 5040
#: Bytes of texts read at once, of a longer text one part after another, and strings dealt out at once.
_BATCH_BYTES, _SINGLES = 4_000_000, 50_000
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_KEY = ["no_id", "doc_id", "text_key"]
_ORDER = ["no_id", "doc_id", "text_key", "first"]
_RUN = "piece long, bytes_key long, inner boolean, sure boolean, no_id boolean, doc_id long, text_key long, first long, size long"


def _pieces(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pieces, and the least in every string of SPAN bytes, by start; needs at least SPAN bytes."""
    n = len(data)
    words = np.empty(n - 7, np.uint64)
    for shift in range(8):
        part = words[shift::8]
        part[:] = np.frombuffer(data, "<u8", len(part), shift)
    count = n - GRAM + 1
    grams = np.zeros(count, np.uint64)
    for i, at in enumerate(range(0, GRAM, 8)):
        grams += words[at : at + count] * _MIX[i]
        grams ^= grams >> np.uint64(29)
        grams *= _MIX[1]
    grams ^= grams >> np.uint64(32)
    least, covered = grams, 1
    while covered * 2 <= WIDTH:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    starts = n - SPAN + 1
    return grams, np.minimum(least[:starts], least[WIDTH - covered :][:starts])


def _occurrences(grams: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """How often each run's piece occurs in it; only from two on can strings inside one run be equal."""
    counts = sizes + WIDTH - 1
    begins = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) + np.repeat(firsts - begins, counts)
    return np.add.reduceat((grams[at] == np.repeat(pieces, counts)).astype(np.int64), begins)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows, held = [], 0
    for batch in slices(batches, 64):
        for row in batch.to_pylist():
            rows.append(row)
            held += len(row["text"])
            if held >= _BATCH_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _emit(columns: dict[str, np.ndarray | list]) -> pa.RecordBatch:
    """Runs as rows; of equal runs in this batch all but the first are sure, and spread evenly."""
    doc = np.array([0 if d is None else d for d in columns["doc_id"]], np.int64)
    no_id = np.array([d is None for d in columns["doc_id"]], bool)
    piece, key = _signed(columns["piece"]), _signed(columns["bytes_key"])
    order = np.lexsort((columns["first"], columns["text_key"], doc, no_id, key, piece))
    sure = np.zeros(len(order), bool)
    sure[order[1:]] = (piece[order[1:]] == piece[order[:-1]]) & (key[order[1:]] == key[order[:-1]])
    same_place = np.zeros(len(order), bool)
    a, b = order[1:], order[:-1]
    same_place[a] = sure[a] & (doc[a] == doc[b]) & (no_id[a] == no_id[b]) & (columns["text_key"][a] == columns["text_key"][b]) & (columns["first"][a] == columns["first"][b])
    piece = np.where(sure, doc * 31 + columns["first"], piece)
    keep = ~same_place  # a repeated row stands in one place
    arrays = [piece, key, columns["inner"], sure, no_id, doc, columns["text_key"], columns["first"], columns["size"]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x)[keep]) for x in arrays],
        names=["piece", "bytes_key", "inner", "sure", *_ORDER, "size"],
    )


def _add_runs(found: dict[str, list], row: dict, data: bytes, begin: int) -> None:
    """The runs of a part of a text that begins at byte ``begin``."""
    grams, pieces = _pieces(data)
    changes = np.concatenate([[True], pieces[1:] != pieces[:-1]])
    firsts = np.flatnonzero(changes)
    sizes = np.diff(np.append(firsts, len(pieces)))
    if sizes.max() > LONGEST:
        for first, size in zip(firsts[sizes > LONGEST].tolist(), sizes[sizes > LONGEST].tolist(), strict=True):
            changes[first : first + size : LONGEST] = True
        firsts = np.flatnonzero(changes)
        sizes = np.diff(np.append(firsts, len(pieces)))
    ends = (firsts + sizes + SPAN - 1).tolist()
    keys = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(firsts.tolist(), ends, strict=True)]
    found["piece"].append(pieces[firsts])
    found["bytes_key"].append(np.array(keys, np.uint64))
    found["inner"].append(_occurrences(grams, firsts, sizes, pieces[firsts]) > 1)
    found["doc_id"].extend([None if row["no_id"] else row["doc_id"]] * len(firsts))
    found["text_key"].append(np.full(len(firsts), row["text_key"], np.int64))
    found["first"].append(firsts.astype(np.int64) + begin)
    found["size"].append(sizes.astype(np.int64))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _text_batches(batches):
        found: dict[str, list] = {name: [] for name in ("piece", "bytes_key", "inner", "doc_id", "text_key", "first", "size")}
        for row in rows:
            data = row["text"].encode()
            if len(data) < SPAN:
                continue
            for begin in range(0, len(data) - SPAN + 1, _BATCH_BYTES):
                _add_runs(found, row, data[begin : begin + _BATCH_BYTES + SPAN - 1], begin)
        if found["piece"]:
            yield _emit({k: v if k == "doc_id" else np.concatenate(v) for k, v in found.items()})


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by piece, bytes and place: repeats (sure), and first runs that may hold further repeats.

    These are the runs of pieces with different runs, and those in which the piece occurs again.

    Holds one batch and the last first run, so a piece may have any number of runs.
    """
    held: pa.Table | None = None  # the last first run, whose piece may go on
    held_open = False  # whether an earlier first run had its piece
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not rows.num_rows:
            continue
        sure_rows = rows.filter(rows["sure"])
        rows = rows.filter(pa.compute.invert(rows["sure"]))
        if sure_rows.num_rows:
            yield from sure_rows.combine_chunks().to_batches()
        if not rows.num_rows:
            continue
        had = 0 if held is None else 1
        rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        piece, key = rows["piece"].to_numpy(), rows["bytes_key"].to_numpy()
        same_piece = np.concatenate([[False], piece[1:] == piece[:-1]])
        same = same_piece & np.concatenate([[False], key[1:] == key[:-1]])
        firsts = np.flatnonzero(~same)
        with_earlier = same_piece[firsts]
        if had:
            with_earlier[0] = held_open
        with_later = np.append(with_earlier[1:], False)
        several = with_earlier | with_later | rows["inner"].to_numpy()[firsts]
        places = [rows[name].to_numpy() for name in _ORDER]
        moved = same & np.concatenate([[False], np.any([x[1:] != x[:-1] for x in places], axis=0)])
        repeats = rows.filter(pa.array(moved))
        repeats = repeats.set_column(repeats.schema.get_field_index("sure"), "sure", pa.array(np.ones(repeats.num_rows, bool)))
        known = rows.take(pa.array(firsts[:-1][several[:-1]]))
        for part in (repeats, known):
            if part.num_rows:
                yield from part.combine_chunks().to_batches()
        held, held_open = rows.slice(int(firsts[-1]), 1), bool(with_earlier[-1])
        # Rows after the held one that equal it are done; the next batch compares with the held one.
    if held is not None and (held_open or held["inner"][0].as_py()):
        yield from held.combine_chunks().to_batches()


def _cut(hot: bool):
    """The bytes of each run; of a hot piece, every string on its own under a piece made from its bytes."""

    def rows(out: dict[str, list]) -> pa.RecordBatch:
        if not hot:
            kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))
        return _emit({
            "piece": np.array([xxhash.xxh3_64_intdigest(x) for x in out["bytes"]], np.uint64),
            "bytes_key": np.array([xxhash.xxh64_intdigest(x) for x in out["bytes"]], np.uint64),
            "inner": np.zeros(len(out["bytes"]), bool),
            "doc_id": [None if gone else d for d, gone in zip(out["doc_id"], out["no_id"], strict=True)],
            **{k: np.array(out[k], np.int64) for k in ("text_key", "first", "size")},
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            out: dict[str, list] = {name: [] for name in ("piece", "no_id", "doc_id", "text_key", "first", "size", "bytes")}
            for row in batch.to_pylist():
                data = row["text"].encode()
                for part in row["runs"]:
                    if part["hot"] != hot:
                        continue
                    begin, past = part["first"], part["first"] + part["size"]
                    for first in range(begin, past) if hot else [begin]:
                        cut = data[first : first + SPAN] if hot else data[begin : past + SPAN - 1]
                        values = (part["piece"], row["no_id"], row["doc_id"], row["text_key"], first, 1 if hot else part["size"], cut)
                        for name, value in zip(out, values, strict=True):
                            out[name].append(value)
                    if len(out["piece"]) >= _SINGLES:
                        yield rows(out)
                        out = {name: [] for name in out}
            yield rows(out)

    return run


def _repeats(rows: pa.Table) -> pa.RecordBatch:
    """Strings of these runs that start earlier in another one, from the order of all their suffixes."""
    names = ["piece", *_ORDER]
    columns = [rows[name].to_numpy() for name in names]
    order = np.lexsort(columns)
    fresh = np.concatenate([[True], np.any([x[order][1:] != x[order][:-1] for x in columns], axis=0)])
    rows = rows.take(pa.array(order[fresh]))  # a repeated row stands in one place
    parts, sizes = rows["bytes"].to_pylist(), rows["size"].to_numpy()
    lengths = np.array([len(x) for x in parts])
    text = np.frombuffer(b"".join(parts) + bytes(SPAN), np.uint8)
    begins = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(parts)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = begins[of] + inside
    run_of = np.full(len(text), -1, np.int64)
    run_of[starts] = of
    order = suffix_array(text[:-SPAN].astype(np.int64) + 1)
    order = order[run_of[order] >= 0]

    windows = np.lib.stride_tricks.sliding_window_view(text, SPAN)
    fresh = np.ones(len(order), bool)
    for at in range(1, len(order), 100_000):
        some = slice(at, min(at + 100_000, len(order)))
        before = slice(some.start - 1, some.stop - 1)
        fresh[some] = (windows[order[some]] != windows[order[before]]).any(axis=1)
    group = np.cumsum(fresh)
    place = [rows[name].to_numpy() for name in _ORDER]
    run = run_of[order]
    start = place[3][run] + order - begins[run]
    ranked = np.lexsort((start, place[2][run], place[1][run], place[0][run], group))
    later = ranked[np.concatenate([[False], group[ranked][1:] == group[ranked][:-1]])]
    # Back to runs of starts, each within one document.
    later = later[np.lexsort((start[later], run[later]))]
    at, r = start[later], run[later]
    cuts = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (r[1:] != r[:-1])]) if len(at) else np.zeros(0, bool)
    heads = np.flatnonzero(cuts)
    counts = np.diff(np.append(heads, len(at)))
    picked = r[heads]
    return pa.RecordBatch.from_arrays(
        [pa.array(place[0][picked]), pa.array(place[1][picked]), pa.array(place[2][picked]), pa.array(at[heads]), pa.array(counts)],
        names=[*_ORDER, "size"],
    )


def _sorted_repeats(array_bytes: int):
    """Suffix arrays over whole pieces, from runs sorted by piece; a piece has a bounded number of runs and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < array_bytes:
                continue
            rows = pa.concat_tables(held).combine_chunks()
            piece = rows["piece"].to_numpy()
            ends = (np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist()
            filled = np.cumsum([len(x) for x in rows["bytes"].to_pylist()])
            begin = 0
            for end, after in zip(ends, [*ends[1:], None], strict=True):
                if after is None or filled[after - 1] - (filled[begin - 1] if begin else 0) > array_bytes:
                    yield _repeats(rows.slice(begin, end - begin))
                    begin = end
            held = [rows.slice(begin)]  # the last piece may go on
            size = held[0].nbytes
        if held:
            yield _repeats(pa.concat_tables(held).combine_chunks())

    return run


def repeated_strings(texts: DataFrame, hot_runs: int = HOT_RUNS, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """no_id, doc_id, text_key, first and size: runs of starts whose SPAN bytes also start earlier.

    ``texts`` has no_id, doc_id (0 without id), text_key and text, no nulls; rows without id come last.
    """
    order = [F.col(name) for name in ("piece", "bytes_key", *_ORDER)]

    def sifted(runs: DataFrame) -> DataFrame:
        return runs.repartition("piece").sortWithinPartitions(*order).mapInArrow(_sift, _RUN)

    found = pin(sifted(texts.mapInArrow(_runs, _RUN)))
    repeats = found.where("sure").select(*_ORDER, "size")
    left = found.where("not sure")
    sizes = left.groupBy("piece").agg(F.count(F.lit(1)).alias("runs"), F.sum(F.col("size") + SPAN).alias("bytes"))
    hot = sizes.where((F.col("runs") > hot_runs) | (F.col("bytes") > 2 * array_bytes)).drop("bytes")
    marked = left.join(hot, "piece", "left").withColumn("hot", F.col("runs").isNotNull())
    of_doc = marked.groupBy(*_KEY).agg(F.collect_list(F.struct("piece", "first", "size", "hot")).alias("runs"))
    read = of_doc.join(texts, _KEY)
    cut = read.mapInArrow(
        _cut(False), "piece long, no_id boolean, doc_id long, text_key long, first long, size long, bytes binary"
    )
    kinds = "no_id boolean, doc_id long, text_key long, first long, size long"
    in_order = cut.repartition("piece").sortWithinPartitions("piece").mapInArrow(_sorted_repeats(array_bytes), kinds)
    repeats = repeats.unionByName(in_order)
    if not hot.isEmpty():
        single = sifted(read.where(F.exists("runs", lambda run: run["hot"])).mapInArrow(_cut(True), _RUN))
        repeats = repeats.unionByName(single.where("sure").select(*_ORDER, "size"))
    return repeats


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _removed(batches, as_text=False)


def _remove_as_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _removed(batches, as_text=True)


def _removed(batches: Iterator[pa.RecordBatch], as_text: bool) -> Iterator[pa.RecordBatch]:
    """With ``as_text`` the remaining bytes as a string; a character that lost a byte goes whole."""
    for batch in slices(batches, 64):
        out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept")}
        columns = [batch.column(name).to_pylist() for name in ("text", "runs", "copy")]
        for text, runs, copy in zip(*columns, strict=True):
            data = text.encode()
            size = len(data)
            found = [(0, size - SPAN + 1)] if copy > 1 and size >= SPAN else [(run["first"], run["size"]) for run in runs or []]
            gone = np.zeros(size, bool)
            kept = data
            if found:
                edge = np.zeros(size + 1, np.int32)
                np.add.at(edge, [first for first, _ in found], 1)
                np.add.at(edge, [first + count + SPAN - 1 for first, count in found], -1)
                gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = kept.decode("utf-8", "ignore") if as_text else kept
            for name, value in zip(out, (size, int(gone.sum()), spans, kept), strict=True):
                out[name].append(value)
        kind = pa.string() if as_text else pa.binary()
        results = {name: pa.array(values, kind if name == "kept" else pa.int64()) for name, values in out.items()}
        yield pa.RecordBatch.from_pydict({"row": batch.column("row")} | results)


def _without_repeats(docs: DataFrame, rows: Column, hot_runs: int, array_bytes: int, as_text: bool) -> DataFrame:
    """``rows`` of ``docs`` (as row) with n_bytes, n_removed, n_spans and kept, the remaining bytes or text."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        rows.alias("row"),
    )
    repeats = repeated_strings(texts.drop("row"), hot_runs, array_bytes)
    of_doc = repeats.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "size")).alias("runs"))
    joined = texts.join(of_doc, _KEY, "left")
    copy = F.lit(1)
    if not texts.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        copy = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.lit(0)))
    kind = texts.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "runs", copy.alias("copy")).mapInArrow(
        _remove_as_text if as_text else _remove,
        f"row {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}",
    )


def remove_repeats(docs: DataFrame, hot_runs: int = HOT_RUNS, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row.

    A null text is empty. "Earlier" goes by doc_id, rows without one last, then by xxhash64 of the
    text where different texts share an id; of equal rows one is first, and the others lose all bytes
    if they have SPAN or more. Other columns are ignored. Works through stored tables when called.
    """
    found = _without_repeats(docs, F.struct("doc_id"), hot_runs, array_bytes, as_text=False)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of text; a character that loses a byte goes whole.

    n_chars, if there is one, follows the text. Null texts stay null; no row goes.
    """
    found = _without_repeats(docs, F.struct(*docs.columns), HOT_RUNS, ARRAY_BYTES, as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    fresh = found.withColumn("new_text", text)
    columns = {name: F.col(f"row.{name}") for name in docs.columns} | {"text": F.col("new_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("new_text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return fresh.select(*[column.alias(name) for name, column in columns.items()])


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    removed = remove_repeats(table(spark, folder, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int | None, str | None]]) -> list[tuple]:
    """The same result from a dictionary of all strings, for tests."""
    rows = sorted(enumerate(docs), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0]))
    seen: set[bytes] = set()
    out = []
    for _, (doc_id, text) in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - SPAN + 1):
            string = data[i : i + SPAN]
            if string in seen:
                gone[i : i + SPAN] = b"\1" * SPAN
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
