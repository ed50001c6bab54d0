"""Personal data by fixed patterns and a character model (bidirectional LSTM with CRF transitions).

Patterns find the usual forms of e-mail and IP addresses, card and phone numbers. Where they match,
they label a bounded sample of windows of text; the labelled spans, as they stand and rewritten into
forms that the patterns miss (without plus, with other separators, with at and dot written out), train
the model. Texts are then read in overlapping windows around every place that can hold such a span, all
windows are decoded, and what they say is reconciled over the whole text: of spans that overlap, the
most probable selection stays, and no span of a pattern is ever given up.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.bilstm_crf import KINDS, Tagger, classes
from tillhouse.llm.common import slices, table

#: Labelled windows that the model learns from at most, and windows that one text gives at most.
SAMPLE, SAMPLE_OF_TEXT = 1000, 4
#: Characters of a window, and of its overlap with the next: no span of the model is longer than the overlap.
WINDOW, OVERLAP = 160, 80
#: Characters of a window that the model learns from, and steps of learning.
LEARNED, STEPS = 100, 600
#: Characters read around a place, and least probability of a span.
AROUND, LEAST = 40, 0.5
_BATCH = 256

# The patterns of the kinds, written so that no text makes them go back over what they read.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile("[0-9]+")
_WRITTEN_AT = r"@|[\[({<]\s?at\s?[\])}>]"
_WRITTEN_DOT = r"\.|[\[({<]\s?dot\s?[\])}>]|\bdot\b"
#: Places that a span must have: digits, an at sign, or one of its written forms.
_PLACE = re.compile(rf"[0-9]|{_WRITTEN_AT}|\bdot\b", re.IGNORECASE)
_WRITTEN = re.compile(rf"{_WRITTEN_AT}|\bdot\b", re.IGNORECASE)
#: Digits and separators that may be a number of one of the kinds though no pattern says so.
_DOUBTFUL = re.compile(r"[0-9](?:[^A-Za-z\n]{0,3}[0-9]){6,}|" + _WRITTEN.pattern, re.IGNORECASE)

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            end = domain.end()
            yield begin, end
        at = text.find("@", max(at + 1, end))


def _short(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255


def base_spans(text: str) -> list[Span]:
    """kind, begin and end of the spans of the patterns, by kind and place."""
    found = [(0, *ends) for ends in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_short, m.group().split(".")))]
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15]
    return found


def _groups(digits: str, random: random.Random) -> list[str]:
    """Digits in groups of two to four."""
    out = []
    while digits:
        size = random.choice((2, 3, 4)) if len(digits) > 4 else len(digits)
        out.append(digits[:size])
        digits = digits[size:]
    return out


def rewritten(kind: int, text: str, random: random.Random) -> str:
    """The same address or number in another form, most of which no pattern matches."""
    if kind == 0:
        at = random.choice((" @ ", " [at] ", "[at]", "(at)", " (at) ", " {at} ", "@"))
        dot = random.choice((" . ", " [dot] ", "[dot]", "(dot)", " (dot) ", " dot "))
        local, _, domain = text.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return text.replace(".", random.choice((" . ", "[.]", "(.)", " dot ", "[dot]", ". ")))
    digits = "".join(_DIGITS.findall(text))
    if kind == 2:
        joint = random.choice((".", "/", "_", "  ", " - ", ":"))
        return joint.join([digits[i : i + 4] for i in range(0, len(digits), 4)])
    if len(digits) == 11 and random.random() < 0.7:
        area, first, last = digits[1:4], digits[4:7], digits[7:]
        forms = (f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"({area}){first}-{last}", f"1-{area}-{first}-{last}")
        return random.choice(forms)
    groups = _groups(digits, random)
    return random.choice(("00", "0", "+", "(0) ")) + random.choice((" ", "-", "/", ".")).join(groups)


def invented(kind: int, random: random.Random) -> str:
    """An address or number of a kind, so that corpora with few of them train a model too."""
    letters = lambda low, high: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(low, high)))
    number = lambda size: "".join(random.choice("0123456789") for _ in range(size))
    if kind == 0:
        local = random.choice((letters(3, 9), f"{letters(2, 7)}.{letters(3, 9)}", f"{letters(3, 7)}{number(2)}", f"{letters(1, 1)}_{letters(4, 9)}"))
        return f"{local}@{letters(3, 10)}.{random.choice(('com', 'org', 'net', 'de', 'example.com', 'co.uk'))}"
    if kind == 1:
        return ".".join(str(random.randint(1, 255)) for _ in range(4))
    if kind == 2:
        start = random.choice("3456") + number(14)
        return next(start + last for last in "0123456789" if luhn(start + last))
    return f"+{random.choice(('1', '44', '49', '33', '34'))} {number(3)} {number(3)} {number(4)}"


def harmless(random: random.Random) -> str:
    """Digits that are none of the kinds: dates, times, versions, amounts, sections, keys."""
    n = random.randint
    return random.choice((
        f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2099)}", f"{n(0, 23)}:{n(0, 59):02}:{n(0, 59):02}",
        f"{n(0, 9)}.{n(0, 20)}.{n(0, 20)}", f"v{n(0, 9)}.{n(0, 99)}", f"{n(1, 999)},{n(0, 999):03},{n(0, 999):03}", f"${n(1, 99999)}.{n(0, 99):02}",
        f"{n(1, 999999)}", f"{n(10**9, 10**12)}", f"({n(1, 99)})", f"{n(1, 99)}.", f"{n(0, 2**64):x}", f"AK{n(0, 2**40):X}",
        f"{n(1, 500)}-{n(1, 500)}", f"{n(1900, 2099)}-{n(1900, 2099)}", f"978-{n(0, 9)}-{n(100, 9999)}-{n(1000, 9999)}", f"{n(1, 20)} {n(1, 20)} {n(1, 20)}",
        f"@{n(1, 9999)}", "dot", "(at)", f"{n(0, 99)} @ {n(0, 99)}.{n(0, 99):02}",
    ))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few windows of each text, with the spans of the patterns in them: around spans, and around other places."""
    schema = pa.schema([("window", pa.string()), ("spans", pa.list_(pa.int64()))])
    for batch in slices(batches):
        windows, marks = [], []
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            spans = sorted((b, e, k) for k, b, e in base_spans(text))
            spans = [s for i, s in enumerate(spans) if not i or s[0] >= spans[i - 1][1]]
            centres = [b for b, e, _ in spans[:SAMPLE_OF_TEXT]]
            if not centres:
                place = _PLACE.search(text)
                centres = [place.start() if place else len(text) // 2]
            for centre in centres:
                begin = max(0, centre - WINDOW // 2)
                end = begin + WINDOW
                inside = [(b, e, k) for b, e, k in spans if b < end and e > begin]
                if inside:  # whole spans only
                    begin, end = min(begin, inside[0][0]), max(end, inside[-1][1])
                    if end - begin > 2 * WINDOW:
                        continue
                elif _DOUBTFUL.search(text, begin, end):
                    continue
                windows.append(text[begin:end])
                marks.append([x - (0 if i % 3 == 2 else begin) for i, x in enumerate(x for s in inside for x in s)])
        yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(marks, schema.field(1).type)], schema=schema)


def _tagged(text: str, spans: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    tags = np.zeros(len(text), np.int64)
    for begin, end, kind in spans:
        tags[begin:end] = 2 + 2 * kind
        tags[begin] = 1 + 2 * kind
    return classes(text), tags


def _varied(window: str, marks: list[int], random: random.Random) -> tuple[str, list[Span]]:
    """A labelled window with some of its spans rewritten, or invented ones and harmless numbers put in."""
    spans = list(zip(marks[::3], marks[1::3], marks[2::3], strict=True))
    parts, labels, at = [], [], 0
    put = []
    if not spans:
        gaps = [i for i, c in enumerate(window) if c == " "]
        put = sorted(random.sample(gaps, min(len(gaps), 2)))
    for begin, end, kind in [*spans, *((i, i, -1) for i in put)]:
        parts.append(window[at:begin])
        own = window[begin:end]
        if kind < 0:
            kind = random.choice((-1, 0, 1, 2, 3))
            own = harmless(random) if kind < 0 else invented(kind, random)
            parts.append(" ")
        if kind >= 0 and random.random() < 0.6:
            own = rewritten(kind, own, random)
        place = sum(map(len, parts))
        if kind >= 0:
            labels.append((place, place + len(own), kind))
        if kind >= 0 and random.random() < 0.1:  # two in a row
            joint = random.choice((" ", ", ", "; ", "\n"))
            labels.append((place + len(own) + len(joint), place + 2 * len(own) + len(joint), kind))
            own += joint + own
        parts.append(own)
        at = end
    text = "".join([*parts, window[at:]])
    return text, labels


def examples(rows: list[tuple[str, list[int]]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of windows: each labelled one as it is, and twice varied."""
    rng, found = random.Random(seed), []
    for window, marks in rows:
        found.append((window, list(zip(marks[::3], marks[1::3], marks[2::3], strict=True))))
        found += [_varied(window, marks, rng) for _ in range(2)]
    windows, tags = np.zeros((len(found), LEARNED), np.uint8), np.zeros((len(found), LEARNED), np.int64)
    for row, (text, spans) in enumerate(found):
        cut = 0
        if spans:  # the window moves about one of its spans
            begin, end, _ = rng.choice(spans)
            cut = rng.randint(max(0, min(begin, end + 5 - LEARNED)), begin)
            if rng.random() < 0.2:  # as in a short text
                cut, text = max(0, begin - rng.randint(0, 9)), text[: end + rng.randint(0, 9)]
        spans = [s for s in spans if s[0] >= cut and s[1] <= len(text)]  # what is left of a cut span is no span
        own, marked = _tagged(text, spans)
        own, marked = own[cut : cut + LEARNED], marked[cut : cut + LEARNED]
        windows[row, : len(own)], tags[row, : len(own)] = own, marked
    return windows, tags


def train(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Tagger | None:
    """A model from labelled windows of ``docs`` (text); None if no text has a window.

    At most ``sample`` windows with spans, and half as many without, of at most 320 characters each come to the
    driver: those with the least hashes. Null and empty texts give none.
    """
    windows = docs.select("text").mapInArrow(_sample, "window string, spans array<long>").distinct()
    chosen = []
    for some, most in ((F.size("spans") > 0, sample), (F.size("spans") == 0, sample // 2)):
        rows = windows.where(some).orderBy(F.xxhash64("window"), "window").limit(most).collect()
        chosen += [(row["window"], row["spans"]) for row in rows]
    if not chosen:
        return None
    model = Tagger.fresh()
    model.train(*examples(chosen), steps=steps)
    return model


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text around places that can hold a span; a number needs four digits, an address its at or dot."""
    found: list[list[int]] = []
    for match in _PLACE.finditer(text):
        begin, end = match.span()
        worth = 1 if match.group().isdigit() else 4
        if found and begin - found[-1][1] <= AROUND:
            found[-1][1] = end
            found[-1][2] += worth
        else:
            found.append([begin, end, worth])
    return [(max(0, begin - AROUND), min(len(text), end + AROUND)) for begin, end, worth in found if worth >= 4]


def windows_of(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all stretches of a text."""
    out = []
    for begin, end in stretches(text):
        while end - begin > WINDOW:
            out.append((begin, begin + WINDOW))
            begin += WINDOW - OVERLAP
        out.append((begin, end))
    return out


def holds(kind: int, own: str) -> bool:
    """Whether a span can be of its kind, whatever separates its parts."""
    digits = _DIGITS.findall(own)
    if kind == 0:
        halves = re.split(_WRITTEN_AT, own, flags=re.IGNORECASE)
        return len(halves) == 2 and bool(halves[0].strip()) and bool(re.search(rf"\w\s*(?:{_WRITTEN_DOT})\s*\w", halves[1], re.IGNORECASE))
    if kind == 1:
        return len(digits) == 4 and all(map(_short, digits))
    size = sum(map(len, digits))
    if kind == 2:
        return 13 <= size <= 19 and luhn("".join(digits))
    return 9 <= size <= 15 and len(digits) > 1


def reconciled(found: list[tuple[int, int, int, float]]) -> list[Span]:
    """Of spans (begin, end, kind, probability) of all windows the most probable selection without overlaps.

    What a window says of a span counts once; a span seen by several windows has its greatest probability.
    """
    most: dict[Span, float] = {}
    for begin, end, kind, chance in found:
        if chance >= LEAST:
            most[begin, end, kind] = max(chance, most.get((begin, end, kind), 0.0))
    spans = sorted(most, key=lambda s: (s[1], s))
    ends = [s[1] for s in spans]
    best = [(0.0, None)]  # gain of the first i spans, and whether the last of them is taken
    for i, span in enumerate(spans):
        chance = min(most[span], 1 - 1e-9)
        gain = math.log(chance / (1 - chance)) + 1e-3 + best[bisect.bisect_right(ends, span[0], 0, i)][0]
        best.append(max((best[i][0], False), (gain, True)))
    out, i = [], len(spans)
    while i:
        if best[i][1]:
            begin, end, kind = spans[i - 1]
            out.append((kind, begin, end))
            i = bisect.bisect_right(ends, begin, 0, i - 1)
        else:
            i -= 1
    return out


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for kind, begin, end in sorted(spans))


class Finder:
    """Spans of the patterns and of the model, for a few texts at a time."""

    def __init__(self, model: Tagger | None):
        self.model = model

    def _decoded(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        held: list[tuple[int, int, int]] = []

        def decode() -> None:
            held.sort(key=lambda w: w[2] - w[1])  # windows of like lengths share a batch
            for start in range(0, len(held), _BATCH):
                some = held[start : start + _BATCH]
                rows = np.zeros((len(some), max(end - begin for _, begin, end in some)), np.uint8)
                for row, (i, begin, end) in zip(rows, some, strict=True):
                    row[: end - begin] = classes(texts[i][begin:end])
                for (i, begin, end), spans in zip(some, self.model.spans(rows), strict=True):
                    for b, e, kind, chance in spans:
                        cut = (b == 0 and begin > 0) or (begin + e == end and end < len(texts[i]))
                        if not cut:  # the window beside has the whole of it
                            found[i].append((begin + b, begin + e, kind, chance))
            held.clear()

        for i, text in enumerate(texts):
            for window in windows_of(text):
                held.append((i, *window))
                if len(held) >= 16 * _BATCH:
                    decode()
        decode()
        return found

    def __call__(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Per text the spans of the patterns, and those that the model adds: none overlaps one of a pattern."""
        bases = [base_spans(text) for text in texts]
        if self.model is None:
            return [(base, []) for base in bases]
        out = []
        for text, base, decoded in zip(texts, bases, self._decoded(texts), strict=True):
            taken = sorted((begin, end) for _, begin, end in base)
            last = np.maximum.accumulate([end for _, end in taken]).tolist() if taken else []
            begins = [begin for begin, _ in taken]

            def free(begin: int, end: int, begins: list[int] = begins, last: list[int] = last) -> bool:
                before = bisect.bisect_left(begins, end)
                return not before or last[before - 1] <= begin

            fitting = [s for s in decoded if free(s[0], s[1]) and holds(s[2], text[s[0] : s[1]])]
            out.append((base, reconciled(fitting)))
        return out


_FOUND = (
    "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def _find(model: Tagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            hashes, spans, sizes = [], [], []
            for base, added in finder([text or "" for text in batch.column("text").to_pylist()]):
                for kind, column in enumerate(counts):
                    column.append(sum(span[0] == kind for span in base))
                hashes.append(hashlib.sha256(_written(base).encode()).hexdigest())
                spans.append(_written(base + added))
                sizes.append(len(added))
            columns = [batch.column("doc_id"), batch.column("text_key"), *counts, hashes, spans, sizes]
            names = [field.split()[0] for field in _FOUND.split(", ")]
            types = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def find(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """doc_id, text_key, counts by kind, base_sha256, spans and n_added of every row of ``docs`` (doc_id, text).

    Spans are ``kind:begin:end`` in code points, end exclusive, by kind (email, ip, card, phone), then place. The counts
    by kind and base_sha256 are of the spans of the patterns, spans are all, n_added counts those of the model. Null
    texts count as empty and have no spans; rows that repeat are all returned; other columns are ignored. text_key
    is xxhash64 of the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInArrow(_find(model), _FOUND)


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return find(docs, train(docs)).drop("text_key")


QUERIES = {"op12_personal_data": op12_personal_data}
