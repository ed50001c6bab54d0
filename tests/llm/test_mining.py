"""Hard negatives, personal data and spelling variants, by brute force and held-out forms."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillhouse.llm import bilstm_crf, hard_negatives, personal_data, variants

from tests.conftest import SMALL
from tests.helpers import row_set, rows_of

# ---- hard negatives


def brute_negatives(rows, is_anchor, positives=5, negatives=5, lowest=80, highest=100, scale=256):
    best = {}
    for own, label, vector in rows:
        if None in (own, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        best[own] = min(best.get(own, (label, vector)), (label, vector))
    whole = {own: (label, [math.floor(scale * x) for x in vector]) for own, (label, vector) in best.items()}
    out = []
    for own, (label, vector) in whole.items():
        if not is_anchor(own):
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i, other) for i, (other, v) in whole.items() if i != own and len(v) == len(vector))
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fitting = [(s, i) for s, i, other in scored if other != label and lowest * -score <= 100 * -s <= highest * -score]
            out += [(own, positive, rank, i, -score, -s) for rank, (s, i) in enumerate(fitting[:negatives], 1)]
    return sorted(out)


def test_hard_negatives_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 70)  # several blocks, and chunks of anchors
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 3)) if i % 4 else 1, (rng.integers(-3, 4, 12) / 7).tolist()) for i in range(400)]
    rows += [(i + 400, 1, rows[i][2]) for i in range(0, 60, 3)]  # ties
    rows += [rows[5], (6, 2, rows[7][2]), (500, None, [0.1] * 12), (501, 1, None), (502, 1, [0.1] * 11 + [None]), (510, 2, []), (None, 1, [0.5] * 12),
             (520, 1, [0.1] * 11 + [float("nan")]), (530, 2, [0.5] * 3), (540, 2, [0.25] * 3), (550, 1, [0.24] * 3), (560, 1, [])]
    schema = "vec_id long, label int, embedding array<double>, score string, rank int, width int"
    df = spark.createDataFrame([(*row, "x", 0, 1) for row in rows], schema)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, positives=2, negatives=30, lowest=-50, highest=70, scale=100)
    want = brute_negatives(rows, lambda i: i % 10 == 0, 2, 30, -50, 70, 100)
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == want
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.integers(-(2**25), 2**25, 6) / 8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, lowest=1)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 10 == 0, lowest=1)


def test_scan_keeps_what_is_needed():
    rng = np.random.default_rng(6)
    block = hard_negatives.Block.of(np.arange(300), rng.integers(0, 3, 300), rng.integers(-20, 20, (300, 32)).astype(float))
    anchor = rng.integers(-20, 20, 32).astype(float)
    rows, scores = block.scan(anchor, np.arange(300), hard_negatives._among_first(4))
    exact = anchor @ block.columns
    assert (scores == exact[rows]).all() and set(np.argsort(-exact)[:4]) <= set(rows.tolist()) and len(rows) < 10


def test_hard_negatives_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    result = con.execute(hard_negatives.ORACLE_SQL["op11_hard_negatives"])
    names = [d[0] for d in result.description]
    assert rows_of(hard_negatives.op11_hard_negatives(spark, SMALL)) == row_set(names, result.fetchall())


# ---- spelling variants


def brute_words(rows):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near_words(word, words):
    letters = sorted(set("".join(words)))
    forms = {word[:i] + word[i + 1 :] for i in range(len(word))}
    forms |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    forms |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return (forms - {word}) & words.keys()


def brute_variants(words):
    forms, rows = {}, {}
    for word, n in words.items():
        near = near_words(word, words)
        best = min(near, key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best and words[best] >= 2 * n else None
        rows[word] = (n, len(near))
    out = []
    for word, (n, near) in rows.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, forms[word], root, n, near, words[forms[word]] if forms[word] else None))
    return sorted(out)


def text_rows(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y") for row in rows], "doc_id long, text string, word string, n int, rank string")


def test_words_by_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    parts = ["Hello", "wörld", "ÀÉÎ×÷ÿxy", "naïve", "A", "abcdefg" * 30, "日本", "foo_bar", "don't", "12ab34", "x" * 70, "É" * 40]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(400))) for i in range(60)]
    rows += [rows[3], (None, "Hello Hello" * 50), (70, None), (71, ""), (72, "... 12"), (73, "longword " * 3 + "zz" * 5000 + " zz" * 4)]
    df = text_rows(spark, rows)
    want = brute_words(rows)
    assert len(want) > 10
    assert {r.word: r.n for r in variants.words(df).collect()} == want
    monkeypatch.setattr(variants, "_PIECE", 500)  # texts in pieces
    assert variants.Counts(5).least == 5
    counts = list(variants._count(5)(iter(df.select("doc_id", "text").toArrow().to_batches())))
    again = collections.Counter()
    for batch in counts:
        again.update(dict(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
    assert {w: n for w, n in again.items() if n >= 3} == want
    assert variants.words(df.limit(0)).count() == 0


def test_variants_by_brute_force(spark):
    rng = random.Random(3)
    words = {}
    while len(words) < 2500:
        words["".join(rng.choice("aabbcé") for _ in range(rng.randint(1, 7)))] = rng.randint(3, 400)
    words |= {"b" * 300: 5, "b" * 301: 20, "b" * 302: 90, "b" * 150 + "c" + "b" * 151: 3}  # long, and of equal letters
    words |= {f"zzzzz{chr(192 + i)}": i + 1 for i in range(64)} | {"zzzzz": 200}  # one place, all letters
    df = spark.createDataFrame([(*w, "x") for w in words.items()], "word string, n long, form string")
    got = variants.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == brute_variants(words)
    assert max(sum(1 for _ in itertools.takewhile(bool, iter_forms(w, rows))) for w in words) > 2  # chains of forms
    assert variants.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.variants(df, factor=1)


def iter_forms(word, rows):
    forms = {r[0]: r[1] for r in rows}
    while forms[word]:
        word = forms[word]
        yield word


def test_nodes_are_numbered_once(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(3000)} | {"a" * n for n in range(1, 40)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(8)
    for backwards in (False, True):
        found = variants.trie(df, backwards).collect()
        nodes = collections.defaultdict(set)
        for row in found:
            key = row.word[::-1] if backwards else row.word
            assert len(row.nodes) == len(key)
            for depth, node in enumerate(row.nodes, 1):
                nodes[key[:depth]].add(node)
        numbers = [n for some in nodes.values() for n in some]
        assert len(numbers) == len(nodes) == len(set(numbers))
        ranked = sorted(found, key=lambda r: r.rank)
        assert [r.word[::-1] if backwards else r.word for r in ranked] == sorted(w[::-1] if backwards else w for w in words)


def test_shared_paths_over_parts():
    ends = [(0, "abc", "abx"), (3, "abxa", "abxz"), (4, "abxzq", "abxzq"), (5, "b", "c")]
    assert variants.shared_paths(ends) == {0: ("abx", [0, 0, 0]), 3: ("abxz", [0, 0, 0, 3]), 4: ("abxzq", []), 5: ("c", [])}


def test_spelling_variants_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = variants.op13_spelling_variants(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == brute_variants(brute_words(docs))


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            doubled = sum(int(d) * (1 + i % 2) - 9 * (i % 2 and int(d) > 4) for i, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match.group().split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and doubled % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append(f"{kind}:{match.start()}:{match.end()}")
    return out


def written(spans):
    return [f"{bilstm_crf.KINDS[k]}:{b}:{e}" for k, b, e in spans]


def test_patterns_by_brute_force(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "x.y@", "@", "a.b", ".", "-", "12", "255", "256", "0.0.0.0", "1.2.3.4.5.6", "4041894974608795", " ", "+1", "(", ")", "+49 30 123456",
             "é", "%", "00001", "9" * 30, "1 2-3 4", "@b.c@d.e", "a@b..c", "\n", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r.text]
    found = 0
    for text in texts:
        spans = written(personal_data.base_spans(text))
        assert spans == brute_spans(text), text
        found += len(spans)
    assert found > 2000


@pytest.mark.parametrize("text", ["a" * 2_000_000, "1" * 2_000_000, "1." * 700_000, "@" * 500_000, "+1 " * 500_000, "a@" * 500_000, "1 " * 700_000 + "x"])
def test_long_texts_take_time_by_length(text):
    personal_data.base_spans(text)
    personal_data.windows_of(text)


def tiny_tagger():
    rng = np.random.default_rng(0)
    model = bilstm_crf.Tagger.fresh(width=3, hidden=4)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    model.weights["transitions"] += rng.normal(size=(9, 9))
    model.weights["starts"] += rng.normal(size=9)
    windows = rng.integers(1, bilstm_crf.CLASSES, (3, 4)).astype(np.uint8)
    windows[1, 3:], windows[2, 1:] = 0, 0
    return model, windows, np.array([[0, 1, 2, 2], [5, 6, 0, 0], [3, 0, 0, 0]])


def test_gradients():
    model, windows, tags = tiny_tagger()
    _, found = model.gradients(windows, tags)
    rng = np.random.default_rng(1)
    for name, weights in model.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, size) for size in weights.shape)
            kept, losses = weights[at], []
            for change in (1e-6, -1e-6):
                weights[at] = kept + change
                losses.append(model.gradients(windows, tags)[0])
            weights[at] = kept
            assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(found[name][at], abs=1e-5)


def test_sums_and_best_tags_by_enumeration():
    model, windows, _ = tiny_tagger()
    scores, _ = model._read(windows)
    lengths = (windows != 0).sum(axis=1)
    chain = model._chain(scores, lengths)
    best = model.best_tags(chain)
    for row, length in enumerate(lengths):
        weights = {}
        for tags in itertools.product(range(9), repeat=int(length)):
            if not bilstm_crf._STARTS[tags[0]] or not all(bilstm_crf.ALLOWED[a, b] for a, b in zip(tags, tags[1:], strict=False)):
                continue
            total = model.weights["starts"][tags[0]] + sum(scores[row, i, t] for i, t in enumerate(tags))
            weights[tags] = total + sum(model.weights["transitions"][a, b] for a, b in zip(tags, tags[1:], strict=False))
        whole = np.log(sum(map(math.exp, weights.values())))
        assert chain.total[row] == pytest.approx(whole)
        assert tuple(best[row, :length]) == max(weights, key=weights.get)
        for begin, end, kind in [(0, 1, 0), (0, 2, 2), (1, 3, 1), (1, 4, 3)]:
            if end <= length:
                tags = [1 + 2 * kind, *[2 + 2 * kind] * (end - begin - 1)]
                share = sum(math.exp(w - whole) for t, w in weights.items() if list(t[begin:end]) == tags and (end == length or t[end] != 2 + 2 * kind))
                assert chain.span(row, begin, end, kind) == pytest.approx(share, rel=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return personal_data.train(docs)


def test_forms_that_no_pattern_finds(model):
    """Held-out addresses and numbers, rewritten, in sentences that no document has."""
    rng, finder = random.Random(8), personal_data.Finder(model)
    before, after = "Please note the following line of this letter: ", " which was sent to us, thank you. Best wishes"
    found = asked = 0
    for _ in range(200):
        kind = rng.randrange(4)
        own = personal_data.rewritten(kind, personal_data.invented(kind, rng), rng)
        base, added = finder([before + own + after])[0]
        if not base:
            asked += 1
            found += (kind, len(before), len(before) + len(own)) in added
    assert asked > 150 and found / asked > 0.85
    false = sum(bool(finder([before + personal_data.harmless(rng) + after])[0][1]) for _ in range(300))
    assert false < 15


def test_windows_are_reconciled(model):
    """The same spans wherever a text is cut into windows; none overlaps another or one of a pattern."""
    rng, finder = random.Random(9), personal_data.Finder(model)
    parts, at, want = [], 0, []
    for _ in range(60):
        own = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        gap = " " + " ".join(rng.choice(["und", "the", "oeran", "reaux"]) for _ in range(rng.randint(3, 30))) + " "
        want.append((at + len(gap), at + len(gap) + len(own)))
        parts += [gap, own]
        at += len(gap) + len(own)
    text = "".join(parts) + " joe@example.com"
    base, added = finder([text])[0]
    found = {(b, e) for k, b, e in added if k == 3}
    assert len(found & set(want)) >= 54
    spans = sorted((b, e) for _, b, e in base + added)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert personal_data.reconciled([(0, 10, 3, 0.9), (5, 15, 2, 0.8), (10, 20, 3, 0.9), (0, 10, 3, 0.6), (30, 35, 1, 0.2)]) == [(3, 10, 20), (3, 0, 10)]


def test_find_over_odd_rows(spark, model):
    rows = [(1, "mail joe@example.com or ring (555) 123-4567 today"), (2, None), (3, ""), (None, "10.0.0.1"), (None, "10.0.0.1"), (5, "nothing at all"),
            (6, "x" * 300_000 + " a@b.de " + "7 " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id long, text string, spans string, n_email int")
    got = {(r.doc_id, r.text_key): r for r in personal_data.find(df, model).collect()}
    assert len(got) == 6 and personal_data.find(df, model).count() == 7
    for (doc, _), row in got.items():
        text = next(t for i, t in rows if i == doc) or ""
        base = brute_spans(text)
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(k) for s in base) for k in PATTERNS]
        assert set(base) <= set(row.spans.split(",")) | set()
    assert next(r.spans for (i, _), r in got.items() if i == 1) == "email:5:20,phone:29:43"
    assert personal_data.find(df.limit(0), None).count() == 0 and personal_data.train(df.limit(0)) is None
    assert personal_data.find(df, None).where("n_added > 0").count() == 0
