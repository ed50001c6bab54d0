"""Near duplicates, neighbours and learned models, by brute force and held-out accuracy; the pipeline."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillhouse.llm import attention, components, lm_score, minhash, neighbours, toxicity

from tests.conftest import SMALL


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return set(zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else {tuple(words)} if words else set()


def brute_components(docs, width, percent=80):
    sets = [shingles(text, width) for _, text in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, own in enumerate(sets):
        for b, other in enumerate(sets[:a]):
            if own and other and 100 * len(own & other) >= percent * len(own | other):
                parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for a, (doc, _) in enumerate(docs):
        groups[root(a)].append(doc)
    out = []
    for a, (doc, _) in enumerate(docs):
        ids = [i for i in groups[root(a)] if i is not None]
        out.append((doc, len(sets[a]), min(ids) if ids else None, doc == (min(ids) if ids else None)))
    return sorted(out, key=repr)


ODD = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "A b  c"), (4, "x"), (5, "X\n"), (None, "lonely words here"), (7, "a b"),
       (0, "p q r s t u v w x y z"), (9, "p q r s t u v w x y z k"), (9, "p q r s t u v w x y z k l"), (11, " \t\n")]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_by_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET", 3)  # chunks of buckets and families
    monkeypatch.setattr(minhash, "FAMILY", 3)
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(i + 100, t) for i, t in docs] + ODD
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, component_id int")
    got = minhash.near_duplicates(df, words=width).drop("text_key").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(docs, width)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(i, t, "l") for i, t in ODD], "doc_id long, text string, bands string")
    kept = minhash.keep_one(docs, words=2)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, None, 7, 0, 11], key=repr)


def test_signatures_estimate_similarity():
    rng, found = np.random.default_rng(0), []
    for _ in range(200):
        base = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
        found.append((minhash.signature(base[:900]) == minhash.signature(base[100:])).mean())
    assert abs(np.mean(found) - 0.8) < 0.01 and np.std(found) < 0.04


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {}
    for a, b in edges:
        want.setdefault(a, a), want.setdefault(b, b)
    for _ in range(60):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k not in loops}


def test_neighbours_by_brute_force(spark):
    found = collections.defaultdict(list)
    for r in neighbours.op1_nearest_neighbours(spark, SMALL).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = units @ units[q]
        cosine[q] = -9
        want = ids[np.lexsort((ids, -cosine))[:5]].tolist()
        assert len(found[ids[q]]) == 5
        assert [s for _, s in found[ids[q]]] == sorted((s for _, s in found[ids[q]]), reverse=True)
        hits += len(set(want) & {v for v, _ in found[ids[q]]})
    assert hits / (5 * len(found)) >= 0.9


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, 2.0, 3.0]),
            (None, [1.0, 0.0]), (6, [-1.0, 0.0]), (50, [1.0, 0.0]), (8, [None, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r)[:3] for r in got] == [(0, 1, 50), (0, 2, 1), (0, 3, 6), (50, 1, 0), (50, 2, 1), (50, 3, 6)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((600, 64))
    vectors[300:400] = vectors[:100]
    codes = neighbours.learn(vectors)
    code = codes.encode(vectors)
    shard = neighbours.Shard(np.arange(600), vectors, code)
    whole = code.view(np.uint64)
    apart = np.bitwise_count(whole[:40, None, :] ^ whole[None]).sum(axis=2)
    for radius in (0, 3, 17, 40, 64, 128):
        q, r = shard.within(code[:40], radius)
        assert sorted(zip(q.tolist(), r.tolist(), strict=True)) == [tuple(x) for x in np.argwhere(apart <= radius).tolist()]


def test_many_shards_chunks_and_outliers(spark, monkeypatch):
    """Clusters that give a small radius, and queries far from all rows, for which it is widened."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    monkeypatch.setattr(neighbours, "SHARD_QUERIES", 30)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 32))
    rows = [(i, (centres[i % 20] + 0.05 * rng.standard_normal(32)).tolist()) for i in range(1000) if i % 10]
    rows += [(i * 10, rng.standard_normal(32).tolist()) for i in range(100)]  # the queries
    rows += rows[:30] + [(15, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 10 == 0)
    assert got.groupBy("query_id").count().where("count = 5").count() == 100
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    units, hits = vectors / np.linalg.norm(vectors, axis=1, keepdims=True), 0
    best = collections.defaultdict(dict)
    for q in np.flatnonzero(ids % 10 == 0):
        for i, c in zip(ids.tolist(), (units @ units[q]).tolist(), strict=True):
            if i != ids[q]:
                best[ids[q]][i] = max(c, best[ids[q]].get(i, -2))
    for r in got.collect():
        assert r.score == pytest.approx(best[r.query_id][r.vec_id])
        hits += r.vec_id in sorted(best[r.query_id], key=lambda i: (-best[r.query_id][i], i))[:5]
    assert hits >= 0.8 * 500


def test_pigeonhole_shares():
    for radius in range(129):
        shares = neighbours.part_radii(radius)
        assert sum(share + 1 for share in shares) == radius + 1  # further in every part: further in all


def toxic_rows(count, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        toxic = bool(rng.random() < 0.3)
        sentences = [" ".join(rng.choice(["red", "green", "blue", "house"], 5)) for _ in range(rng.integers(1, 30))]
        if toxic:
            sentences[rng.integers(len(sentences))] += " idiotic"
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return rows


def test_toxicity_is_learned_and_located(spark):
    rows = toxic_rows(900, 5)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxicity_score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    held = {i: (t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    for r in toxicity.score(docs, model).collect():
        if r.doc_id in held:
            text, toxic = held[r.doc_id]
            assert (r.toxicity_score >= 0.7) == toxic
            if toxic:
                assert [("idiotic" in text[s.first : s.past]) for s in r.offending] == [True]
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.where("text like '%idiotic%'").count() == 0
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "an idiotic " * 20_000)], "doc_id long, text string")
    scores = {r.doc_id: r.toxicity_score for r in toxicity.score(odd, model).collect()}
    assert scores[1] == scores[None] < 0.1 and scores[2] > 0.99
    nothing = toxicity.train(docs.limit(0), labels.limit(0))
    assert {r.toxicity_score for r in toxicity.score(odd.limit(1), nothing).collect()} == {0.5}


def test_offences_inside_clauses_without_spaces_are_found(spark):
    rng, rows = np.random.default_rng(7), []
    for i in range(600):
        toxic = int(rng.random() < 0.3)
        parts = ["".join(rng.choice([*"今日天気良山川空海木花本人大小"], 12)) for _ in range(6)]
        if toxic:
            parts[3] = parts[3][:6] + "馬鹿" + parts[3][6:]
        rows.append((i, "。".join(parts) + "。", toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    held = {i: (t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    found = [r for r in toxicity.score(docs, model).collect() if r.doc_id in held]
    assert sum((r.toxicity_score >= toxicity.THRESHOLD) == held[r.doc_id][1] for r in found) >= 0.98 * len(found)
    spans = [held[r.doc_id][0][s.first : s.past] for r in found for s in r.offending]
    assert spans and sum("馬鹿" in s and "。" not in s for s in spans) >= 0.95 * len(spans)


def test_texts_without_sentence_ends(spark):
    """Long runs of clean words stay clean, however often one with a little weight comes; an offence in them is found."""
    rows = toxic_rows(900, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    scorer = toxicity.Scorer(model)
    chance = lambda text: scorer.chance(scorer.sentences(text)[1])
    words = " ".join(t.replace(".", "") for _, t, y in rows if not y).split()
    clean = " ".join((words * (100_000 // len(words) + 1))[:100_000])
    assert chance(clean) < 0.1
    worst = next(t for _, t, y in rows if y and chance(t) >= toxicity.THRESHOLD)
    assert chance(clean + " " + worst.replace(".", "") + " " + clean) >= toxicity.THRESHOLD
    spans, odds = scorer.sentences(clean)
    assert len(spans) > 3000 and max(b - a for a, b in spans) < 1000 and spans[-1][1] == len(clean)
    slight = toxicity.Scorer(toxicity.Model(-7.0, {"one": 0.3}))
    assert slight.chance(slight.sentences("one two three " * 1000)[1]) < 0.01


def test_windows_cover_all_words():
    for count in (1, 60, 61, 89, 90, 91, 1000):
        windows = toxicity._windows(count)
        assert set().union(*(range(a, b) for a, b in windows)) == set(range(count))
        assert all(b - a <= toxicity.WINDOW for a, b in windows) and windows[-1][1] == count


def test_one_formula_for_fit_and_score():
    rng = np.random.default_rng(3)
    odds = [rng.uniform(-6, high, size) for high, size in ((-4, 1000), (-2.9, 30), (1, 5), (-5, 1))]
    owner = np.repeat(np.arange(4), [len(o) for o in odds])
    clean, counts = toxicity.log_clean(np.concatenate(odds), owner, 4, -7.0)
    scorer = toxicity.Scorer(toxicity.Model(-7.0, {}))
    assert [scorer.chance(o) for o in odds] == pytest.approx((-np.expm1(clean)).tolist())
    assert counts.sum() == 1 + max(1, (odds[1] >= toxicity.SLIGHT).sum()) + max(1, (odds[2] >= toxicity.SLIGHT).sum()) + 1


def test_sample_is_bounded_by_rows_of_an_id_and_characters(spark, monkeypatch):
    rows = toxic_rows(300, 6)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(rows[0][0], rows[0][1])] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    seen, fit = [], toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda found, names: seen.append(len(found)) or fit(found, names, 5))
    toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", sum(len(t) for _, t, _ in rows) // 4)
    toxicity.train(docs, labels)
    learned = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, _ in rows)
    assert seen[0] == learned and 20 < seen[1] < learned / 2


def test_length_alone_makes_no_text_toxic(spark):
    rows = toxic_rows(900, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    plain = "red green blue house. " * 100_000
    long = spark.createDataFrame([(1, plain), (2, f"{plain} an idiotic house. {plain}"), (3, "red")], "doc_id long, text string")
    scores = {r.doc_id: r.toxicity_score for r in toxicity.score(long, model).collect()}
    assert scores[1] == scores[3] < toxicity.THRESHOLD <= scores[2]
    assert {r.doc_id for r in toxicity.clean(long, model).collect()} == {1, 3}


def test_slight_evidence_does_not_add_up():
    model = toxicity.Model(-6.0, {"slight": 1.5, "grave": 9.0})
    chance = lambda text: (scorer := toxicity.Scorer(model)).chance(scorer.sentences(text)[1])
    assert chance("none") < chance("a slight one. " * 100_000) == chance("a slight one") < 0.02
    assert chance("a slight one. " * 100_000 + "a grave one") > 0.9


IN_FOLD = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5, -1) != 1"


@pytest.mark.parametrize("head_words", [100, 1_000_000])
def test_word_base_by_brute_force(spark, head_words, monkeypatch):
    monkeypatch.setattr(lm_score, "EPOCHS", 1)
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs += [(None, "no id"), (-1, None), (-2, "again"), (-2, "again")]
    counts = collections.Counter()
    words = {n: [*(t or "").encode().lower().split(), None] for n, (_, t) in enumerate(docs)}
    for n, (i, _) in enumerate(docs):
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words[n])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for n, (i, _) in enumerate(docs):
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words[n])
        want.append((i, len(words[n]), sum(counts[w] > 0 for w in words[n]), total, round(base, 6)))
    df = spark.createDataFrame([(*d, 3) for d in docs], "doc_id long, text string, score int")
    got = lm_score.score_texts(df, IN_FOLD, head_words=head_words).collect()
    assert sorted(((*tuple(r)[:4], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_word_shares_do_not_depend_on_the_head(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "EPOCHS", 1)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).coalesce(1)
    scores = [{r.doc_id: r.score for r in lm_score.score_texts(docs, IN_FOLD, head_words=n).collect()} for n in (1, 100, 1_000_000)]
    assert scores[0].keys() == scores[1].keys() == scores[2].keys()
    for i, score in scores[2].items():
        assert math.isclose(scores[0][i], score, rel_tol=1e-5) and math.isclose(scores[1][i], score, rel_tol=1e-5)


def test_order_of_words_outside_the_sample_counts(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SAMPLE_DOCS", 1)
    monkeypatch.setattr(lm_score, "EPOCHS", 1)
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40).collect()]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    training = frame(docs).where(IN_FOLD).select("doc_id")
    first = training.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    trained = {r.doc_id for r in training.collect()}
    turned = [(i, " ".join(t.split()[::-1]) if i in trained and i != first else t) for i, t in docs]
    scores = [{r.doc_id: r.score for r in lm_score.score_texts(frame(rows), IN_FOLD).collect()} for rows in (docs, turned)]
    held = [i for i, _ in docs if i not in trained]
    assert held and all(not math.isclose(scores[0][i], scores[1][i], rel_tol=1e-6) for i in held)


def test_all_windows_are_learned_from(spark):
    path = lm_score.RANKS
    rows = [(i, "one two three four five " * (i * 30)) for i in range(1, 30)] + [(None, None), (3, "again"), (3, "again")]
    rows += [(50, "a very long text of words " * 20_000)]
    texts = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string").repartition(3)
    ids = [np.array([i for words in lm_score.words_of(t) for w in words for i in lm_score._subwords(w, path)] + [lm_score.encoding(path).n_vocab]) for _, t in rows]
    total = lm_score.encoding(path).n_vocab + 1
    counts = np.bincount(np.concatenate(ids), minlength=total)
    pieces = [x[:48] for x in ids]
    topics = lm_score._Topics.found(lm_score._by_frequency(counts)[:256], total, pieces)
    encoded = lm_score.encode_texts(texts, path)
    assert np.array_equal(lm_score.count_topics(encoded, topics).reshape(total, -1).sum(axis=1), counts)
    vocabulary = lm_score.Vocabulary.of(counts, path, pieces)
    start = lm_score.LanguageModel(vocabulary, attention.fresh(*vocabulary.sizes))
    model, windows = lm_score.learn_from_all(encoded, start, int(counts.sum()))
    assert windows == sum(-(-len(x) // attention.SCORED) for x in ids)
    inputs, targets, marks = vocabulary.windows(ids)
    assert model.network.log_chance(inputs, targets)[marks].mean() > start.network.log_chance(inputs, targets)[marks].mean() + 0.3


def test_windows_of_parts_are_those_of_the_whole():
    size = lm_score.encoding(lm_score.RANKS).n_vocab + 1
    rng = np.random.default_rng(6)
    vocabulary = lm_score.Vocabulary.of(rng.integers(1, 50, size).astype(float), lm_score.RANKS, [])
    batch = pa.RecordBatch.from_pylist([{"key": 5, "text": " ".join(rng.choice(["on", "thor", "reaux", "x"], 9000).tolist())}])
    ids = next(iter(lm_score._texts_as_ids(iter([batch]), lm_score.RANKS)))
    parts, leads = lm_score._ids(next(iter(lm_score._encode_texts(lm_score.RANKS)(iter([batch])))))
    assert len(parts) > 3 and np.array_equal(np.concatenate([p[lead:] for p, lead in zip(parts, leads, strict=True)]), ids)
    for a, b in zip(vocabulary.windows([ids]), vocabulary.windows(parts, leads), strict=True):
        assert np.array_equal(a, b)


def test_frequent_words_are_one_id_and_rare_ones_are_spelled(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "OWN_WORDS", 2)
    monkeypatch.setattr(lm_score, "_REMEMBERED_IDS", 3)
    texts = ["thorreaux " * 5 + "zzyzx", "\t Thorreaux qwertz\x1cqwertz \v", "zzyzx zzyzx", "", " \n", "\u00a0\u00c9t\u00c9 12,5 12,5"]
    counted = spark.createDataFrame([(t,) for t in texts], "text string").mapInArrow(lm_score._count_words, "word binary, c long")
    counted = counted.groupBy("word").agg(F.sum("c").alias("c"))
    want = collections.Counter(w for t in texts for words in lm_score.words_of(t) for w in words) + collections.Counter({lm_score.END: len(texts)})
    assert {bytes(r.word): r.c for r in counted.collect()} == want
    own = lm_score._own_words(counted)
    assert own == [b"thorreaux"]  # the end is the other of the two
    shared = spark.sparkContext.broadcast(lm_score._Known(lm_score.RANKS, own))
    end = lm_score.encoding(lm_score.RANKS).n_vocab
    spell = lambda w: [end + 1] if w in own else lm_score._subwords(w, lm_score.RANKS)
    batch = pa.RecordBatch.from_pydict({"text": texts * 3})
    got = [x.tolist() for x in lm_score._texts_as_ids(iter([batch.slice(2)]), lm_score.RANKS, shared)]
    assert got == [[i for words in lm_score.words_of(t) for w in words for i in spell(w)] + [end] for t in (texts * 3)[2:]]


def test_classes_of_a_kind_are_neighbours_and_all_begin_a_word_or_none():
    rng = np.random.default_rng(2)
    end = lm_score.encoding(lm_score.RANKS).n_vocab
    counts = rng.zipf(1.3, end + 1001).clip(0, 10**6).astype(float)
    vocabulary = lm_score.Vocabulary.of(counts, lm_score.RANKS, [rng.integers(0, len(counts), 48) for _ in range(60)])
    assert sum(vocabulary.kinds) == len(vocabulary.begins) and len(vocabulary.kinds) > 2
    for marks in np.split(vocabulary.begins, np.cumsum(vocabulary.kinds)[:-1]):
        assert len(set(marks.tolist())) == 1
    assert vocabulary.begins[vocabulary.classes[end:]].all()
    network = attention.fresh(*vocabulary.sizes)
    inputs, targets, _ = vocabulary.windows([rng.integers(0, len(counts), 70)])
    every = np.stack([network.log_chance(inputs, np.full_like(targets, c)) for c in range(vocabulary.sizes[1])])
    begins = network.log_chances(inputs, targets, vocabulary.begins)[1]
    assert np.allclose(np.exp(every[vocabulary.begins > 0]).sum(axis=0), np.exp(begins), atol=1e-4)


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "EPOCHS", 1)
    monkeypatch.setattr(lm_score, "SHARD_IDS", 3000)  # several shards
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("doc_id < 80")
    docs = docs.unionByName(docs.where("doc_id < 5"))
    scores = [sorted((r.doc_id, r.score) for r in lm_score.score_texts(docs.repartition(n), IN_FOLD).collect()) for n in (1, 3, 7)]
    for other in scores[1:]:
        assert [i for i, _ in other] == [i for i, _ in scores[0]]
        assert [s for _, s in other] == pytest.approx([s for _, s in scores[0]], rel=1e-5)


def test_chances_of_words_sum_to_one_at_most():
    """Over a closed lexicon in many contexts, with the end; the words' ends are what keeps the sum down."""
    path, rng = lm_score.RANKS, np.random.default_rng(8)
    lexicon = [b"a", b"an", b"ana", b"on", b"ont", b"thor", b"thorn", b"x", b"xx", b"reaux", b"re", b"12", b"\xc3\xa9t\xc3\xa9"]
    texts = [[lexicon[i] for i in rng.integers(0, len(lexicon), 30)] for _ in range(60)]
    as_ids = lambda words: [np.array(lm_score._subwords(w, path)) for w in [*words, lm_score.END]]
    flat = [np.concatenate(as_ids(words)) for words in texts]
    counts = np.bincount(np.concatenate(flat), minlength=lm_score.encoding(path).n_vocab + 1)
    vocabulary = lm_score.Vocabulary.of(counts, path, [])
    network = attention.fresh(*vocabulary.sizes)
    network = attention.train(network, *vocabulary.windows(flat), 60)
    model = lm_score.LanguageModel(vocabulary, network)

    def chance(words):
        ids = as_ids(words)
        lengths = [np.array([len(x) for x in ids])]
        return model.score([np.concatenate(ids)], lengths, [np.zeros(len(ids), np.int64)], 0, False)[0][0]

    # Chance of a beginning of a text: what all texts that go on from it add up to, a few words deep.
    for words in texts[:6]:
        for cut in (0, 2, 5):
            ended = 10.0 ** chance(words[:cut])
            one_more = sum(10.0 ** chance([*words[:cut], w]) for w in lexicon)
            two_more = sum(10.0 ** chance([*words[:cut], v, w]) for v in lexicon for w in lexicon)
            assert ended + one_more + two_more <= 1 + 1e-3
    # Given what stands before, the words and the end share one.
    for words in texts[:6]:
        for cut in (1, 4):
            before, begins = [], []
            for w in [*lexicon, lm_score.END]:
                ids = as_ids(words[:cut])[:-1] + [np.array(lm_score._subwords(w, path))] + ([] if w == lm_score.END else [np.array(lm_score._subwords(lm_score.END, path))])
                inputs, targets, marks = vocabulary.windows([np.concatenate(ids)])
                by_id, starts = (x[marks].astype(float) for x in network.log_chances(inputs, targets, vocabulary.begins))
                by_id += vocabulary.log_share[np.concatenate(ids)]
                first = sum(map(len, ids[:cut]))
                past = first + len(ids[cut])
                before.append(by_id[first:past].sum() - starts[first] + (0 if w == lm_score.END else starts[past]))
                begins.append(starts[first])
            assert 0.5 < np.exp(before).sum() <= 1 + 1e-4 and np.allclose(begins, begins[0])


def test_without_training_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in lm_score.score_texts(df, "false").collect()}
    assert rows[1].n_tokens == 1 and rows[2].base_score == 0 and rows[2].score < rows[1].score < 0
    assert lm_score.score_texts(df.limit(0), "true").count() == 0


def test_chances_sum_to_one_and_windows_score_once():
    rng = np.random.default_rng(1)
    size = lm_score.encoding(lm_score.RANKS).n_vocab + 1
    counts = rng.integers(0, 50, size).astype(float)
    pieces = [rng.integers(0, size, 48) for _ in range(40)]
    vocabulary = lm_score.Vocabulary.of(counts, lm_score.RANKS, pieces)
    assert np.allclose(np.bincount(vocabulary.classes, np.exp(vocabulary.log_share)), 1)
    network = attention.fresh(*vocabulary.sizes)
    ids = rng.integers(0, size, 100)
    inputs, targets, marks = vocabulary.windows([ids, ids[:1]])
    assert marks.sum() == 101 and targets[marks].tolist() == [*vocabulary.classes[ids], vocabulary.classes[ids[0]]]
    every = np.stack([network.log_chance(inputs, np.full_like(targets, c)) for c in range(vocabulary.sizes[1])])
    assert np.allclose(np.exp(every).sum(axis=0), 1, atol=1e-4)
    changed = inputs.copy()
    changed[:, -1] = 5  # what comes last changes nothing before it
    assert np.allclose(network.log_chance(changed, targets)[:, :-1], network.log_chance(inputs, targets)[:, :-1])


def test_scoring_equals_the_trained_model():
    rng = np.random.default_rng(4)
    network = attention.fresh(12, 7)
    inputs, targets = rng.integers(0, 12, (70, attention.CONTEXT + attention.SCORED)), rng.integers(0, 7, (70, attention.SCORED))
    inputs[:, attention.CONTEXT] = 1
    logits = network._forward(inputs)["logits"].reshape(70, attention.SCORED, -1)
    want = np.take_along_axis(logits, targets[:, :, None], 2)[:, :, 0] - np.log(np.exp(logits).sum(axis=2))
    assert np.allclose(network.log_chance(inputs, targets), want, atol=1e-4)
    network.weights["bias"] = network.weights["bias"] + np.float32(100)  # a constant changes nothing
    assert np.allclose(network.log_chance(inputs, targets), want, atol=1e-3)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(3)
    network = attention.fresh(12, 7)
    inputs, targets = rng.integers(1, 12, (3, attention.CONTEXT + attention.SCORED)), rng.integers(0, 7, (3, attention.SCORED))
    marks = np.ones(targets.shape, bool)
    network.weights = {name: x.astype(np.float64) for name, x in network.weights.items()}
    loss = lambda: -network.log_chance(inputs, targets).astype(np.float64).mean()
    for name, gradient in network._gradients(inputs, targets, marks).items():
        at = tuple(rng.integers(0, n) for n in network.weights[name].shape)
        at = (int(inputs[0, 20]), *at[1:]) if name == "embedding" else at
        before = network.weights[name][at]
        network.weights[name][at] = before + 1e-2
        above = loss()
        network.weights[name][at] = before - 1e-2
        below = loss()
        network.weights[name][at] = before
        assert abs((above - below) / 2e-2 - gradient[at]) < 2e-3 + 0.05 * abs(gradient[at]), name


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kinds, counts = docs.dtypes, [docs.count()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        counts.append(docs.count())
        assert n == len(corpus_pipeline.STAGES) - 1 or docs.dtypes == kinds, name
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] == counts[5] > 0
