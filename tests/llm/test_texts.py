"""Encoding, counting, extraction, url rules, decontamination and repeated strings, by brute force."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from tillhouse.llm import bpe, decontamination, html_text, suffix_dedup, token_counts, url_filter
from tillhouse.llm.common import repeat_rows
from tillhouse.llm.suffix_array import suffix_array

from tests.conftest import SMALL
from tests.helpers import row_set, rows_of

DOCS = "doc_id long, text string, n_tokens string, ids string, row_id int"


def documents(spark, rows):
    """Rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, "x", "y", 1) for row in rows], DOCS)


def odd_texts():
    rng = random.Random(1)
    texts = ["a", "  b\n\n c's don't ", "x" * 5000, "", None, " " * 3000, "<|endoftext|>", "héé 日本語", "12 3\t\r\n  f", "\x1c\x1d \x85\xa0z"]
    parts = ["the ", "an'll", "  ", "\n", "12", "!?", "é", "<|endoftext|>", "日本"]
    for _ in range(12):
        texts.append("".join(rng.choice([*parts, "w" * rng.randint(1, 300), " " * rng.randint(1, 80)]) for _ in range(300)))
    rows = list(enumerate(texts))
    return [*rows, rows[-1], (None, "no id")]


@pytest.mark.parametrize("step,overlap", [(65_536, 512), (1000, 100), (300, 60)])
def test_bpe_equals_the_library(spark, step, overlap):
    rows = odd_texts()
    got = bpe.decode(bpe.encode(documents(spark, rows), step=step, overlap=overlap))
    library = bpe.encoding(bpe.RANKS)
    want = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert sorted(((r[0], bytes(r[1]), bytes(r[2])) for r in got.collect()), key=repr) == sorted(want, key=repr)
    at_once = bpe.encode(documents(spark, rows), step=step, overlap=overlap, decoded=True)
    assert sorted(((r[0], bytes(r[1]), bytes(r[2])) for r in at_once.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("step,overlap", [(65_536, 512), (300, 60)])
def test_counts_equal_the_library(spark, step, overlap):
    rows = odd_texts()
    library = token_counts.tokenizer(token_counts.TOKENIZER)
    counts = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, counts, strict=True)]
    got = token_counts.count_tokens(documents(spark, rows), step=step, overlap=overlap).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_documents(spark):
    none = documents(spark, [])
    assert bpe.digests(none).count() == token_counts.count_tokens(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_url_rules_equal_sql(spark):
    pages = [(1, "HTTP://News.Example.ORG/en/12?x"), (2, None), (3, "no scheme"), (4, "http://org"), (5, "http://a.com/fr/x#y"),
             (5, "http://a.com/fr/x#y"), (6, "http://a.com/de/"), (7, "http://notexample.org/es/"), (None, "http://example.org/es/1"),
             (8, "x://://example.org/es/"), (9, "http://"), (10, "http://.com/de/")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, verdict string")
    connection = duckdb.connect()
    connection.execute("create table pages (page_id bigint, url varchar)")
    connection.executemany("insert into pages values (?, ?)", pages)
    result = connection.execute(url_filter.ORACLE_SQL["op7_url_filter"])
    want = row_set([c[0] for c in result.description], result.fetchall())
    for blocks in (1, 4096):  # a full filter passes everything on, with the same result
        assert rows_of(url_filter.filter_urls(df, spark.sql(url_filter.RULES), blocks=blocks)) == want
    none = spark.sql(url_filter.RULES).limit(0)
    assert {r.verdict for r in url_filter.filter_urls(df, none, unlisted="block").collect()} == {"block"}
    assert url_filter.filter_urls(df.limit(0), spark.sql(url_filter.RULES)).count() == 0


def brute_hits(docs, items):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda text: word.findall((text or "").encode().lower())
    windows = {}
    for item, text in items:
        words = split(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1) if words else ():
            windows.setdefault((size, tuple(words[i : i + size])), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for size in {size for size, _ in windows}:
            for i in range(len(words) - size + 1):
                if here := windows.get((size, tuple(words[i : i + size]))):
                    hit.update(range(i, i + size))
                    found |= here
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_by_brute_force(spark):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").select(key, "text").collect()]
    docs = read("documents", "doc_id") + [(None, "x y Z É é z"), (-1, "q " * 100), (-2, "one two three"), (-2, "one two three"), (-3, None), (-4, ""), (-5, "p q " * 40)]
    items = read("benchmark", "item_id") + [(-1, "É é"), (-2, None), (None, "two"), (-3, "q " * 12), (-3, "q " * 12), (-4, "p q " * 9), (-5, "!!")]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, hash int")
    got = repeat_rows(decontamination.find_hits(documents(spark, docs), benchmark), "copies", decontamination.RESULT)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_hits(docs, items)
    kept = decontamination.uncontaminated(documents(spark, docs), benchmark)
    clean = [d for d in docs if not brute_hits([d], items)[0][5]]
    assert kept.columns == documents(spark, []).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)
    assert decontamination.find_hits(documents(spark, []), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<div><p>x<p>y</div>z", "x\n\ny\n\nz"),
    ("<title>t</title><script>var a='</p>'</script><style>p{}</style>", ""),
    ("<nav>menu</nav><article><h1>T &amp; U</h1><p>a,  b<br>c</p></article><footer>f</footer>", "T & U\n\na, b c"),
    ("<div class=comments><p>Long comment, with commas, and more of them, too.</p></div><div><h2>T</h2><p>Body text, with commas, and so on.</p><ul><li>one<li>two</ul></div>", "T\n\nBody text, with commas, and so on.\n\none\n\ntwo"),
    ("<aside><p>side, side, side, side, side, side</p></aside><main><p>short</p></main>", "short"),
    ("<form><p>log in, please, now, or never, ever</p></form><div id='cookie-notice'>We use cookies</div><p>The text of the page, as it is.</p>", "The text of the page, as it is."),
    ("<table><tr><td>a<td>b</table>", "a\n\nb"), ("<p>unclosed <a href='x", "unclosed <a href='x"),
])
def test_main_text(source, text):
    assert html_text.main_text(source) == text


PROSE = "<p>The text of the page, as it is, with commas, and some length.</p>"
PROSE_TEXT = PROSE[3:-4]


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "content-sidebar-wrap", "elementor-widget-container", "post-with-comments", "ad-free", "widget", "sidebar-left"])
@pytest.mark.parametrize("inside", ["<main>{}</main>", "<article>{}</article>", "{}"])
def test_wrappers_with_compound_names_keep_the_article(name, inside):
    page = f"<div class='{name}'>{inside.format(PROSE)}</div><div class='widget-area'><p>Side text.</p></div>"
    assert html_text.main_text(page) == PROSE_TEXT
    assert html_text.main_text(page.replace("class", "id")) == PROSE_TEXT


def test_named_parts_stay_out_beside_the_article():
    junk = "<div class='{}'><article><p>Another one, of the same length, with commas, and more of it.</p></article></div>"
    for name in ("related", "comments", "siteFooter", "share social", "cookie-notice", "x sidebar"):
        assert html_text.main_text(f"<article>{PROSE}</article>{junk.format(name)}") == PROSE_TEXT
    assert html_text.main_text("<div class=ad>A long advert, with commas, and words.</div><article><h1>T</h1><p>T</article>") == "T\n\nT"
    assert html_text.main_text(f"<div>{PROSE}<p>One <span class=ad>AD</span>two, three.</p></div>") == f"{PROSE_TEXT}\n\nOne two, three."


def test_short_sections_beside_the_best_stay():
    first, second = "abcde fgh, " * 10 + "x" * 490, "klmno pqr, " * 2 + "y" * 178
    rest = "<ul><li>one<li>two</ul><ol><li>three</ol><table><tr><td>four</table><blockquote>five</blockquote><pre>six</pre>"
    page = f"<div id=c><div><p>{first}</p></div><div><p>{second}</p></div>{rest}<ul><li><a href=x>menu</a><li><a href=y>more</a></ul></div>"
    assert html_text.main_text(page) == "\n\n".join([first, second, "one", "two", "three", "four", "five", "six"])


def test_formulas_stay():
    page = "<p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math>, as is known.</p>"
    assert html_text.main_text(page) == "Energy is E=m, as is known."


def test_long_and_deep_pages(spark):
    assert html_text.main_text("<div><div><p>" * 20_000) == ""
    assert len(html_text.main_text("<p>" + "word, " * 200_000)) == 6 * 200_000 - 1
    pages = spark.createDataFrame([(1, "u", "<p>é", "t"), (1, "u", "<p>é", "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text.extract_text(pages)
    assert rows_of(got) == row_set(got.columns, [(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)])


HOSTILE = {
    "no end": "<a ", "ends in quotes": "<a ='>'", "quotes of two kinds": "<a =\"<b ='", "declarations": "<!x", "nested": "<b>x", "signs": "<",
    "empty": "<svg/>", "list": "<li>x", "comments": "<a <!--",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_time_by_length(name):
    """Megabytes each; any of them took hours when a tag without end was looked for again and again."""
    html_text.main_text(HOSTILE[name] * (3_000_000 // len(HOSTILE[name])))


@pytest.mark.parametrize("before", ["<div>", "<i><div>", "<i>", "<p>"])
@pytest.mark.parametrize("after", ["</i>", "<h1></h1>", "</q>", "<tr>"])
def test_stray_tags_behind_open_ones(before, after):
    html_text.main_text(before + "<b>" * 100_000 + after * 100_000)


def test_tags_without_end_are_text():
    assert html_text.main_text("<p>One <a href='x'>two</a> three <a four") == "One two three <a four"
    assert html_text.main_text("<p>a <b c='>' d='<p>e</p>") == "a e"
    assert html_text.main_text("<p>a <!-- never ended <p>b") == "a"
    assert html_text.main_text("<p>1 < 2 <3 <!x") == "1 < 2 <3 <!x"


@pytest.mark.parametrize("name", ["ad-slot-1", "js-cookie-consent", "user-comments", "related-posts", "comment-count", "sidebar-2"])
def test_compound_names_of_junk(name):
    junk = f"<div class='{name}'><p>Some other words, with commas, that nobody asked for, at some length.</p></div>"
    assert html_text.main_text(f"<div>{PROSE}{junk}</div>") == PROSE_TEXT
    assert html_text.main_text(f"<article>{PROSE}{junk}</article>") == PROSE_TEXT


def test_articles_in_main():
    comment = "<article class='comment'><p>I, as a reader, think otherwise, and say so at some length here.</p></article>"
    assert html_text.main_text(f"<main><article>{PROSE}</article>{comment}</main>") == PROSE_TEXT
    assert html_text.main_text(f"<main><article>{PROSE}</article><article>{PROSE}</article></main>") == f"{PROSE_TEXT}\n\n{PROSE_TEXT}"
    teaser = "<article><a href=x>Another article, with a title, and no more than that title here</a></article>"
    assert html_text.main_text(f"<main><article>{PROSE}</article>{teaser}</main>") == PROSE_TEXT
    assert html_text.main_text(f"<article class='post-with-comments'>{PROSE}</article>") == PROSE_TEXT


@pytest.mark.parametrize("symbols", [1, 2, 4, 300])
def test_suffix_array(symbols):
    rng = np.random.default_rng(symbols)
    for size in [*range(30), 100, 700]:
        text = rng.integers(1, symbols + 1, size)
        assert suffix_array(text).tolist() == sorted(range(size), key=lambda i: text[i:].tolist())


def repetitive_documents():
    rng = random.Random(3)
    words = ["alpha", "bé", "c ", "delta\n", "ee", "fox ", "of the "]
    shared = "".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        if i % 3 == 0:
            text = text[:40] + shared[rng.randint(0, 50) : rng.randint(120, 400)] + text[40:]
        text += "ab" * 150 if i % 7 == 0 else ""
        rows.append((i, "z" * rng.randint(90, 300) if i % 11 == 0 else text))
    return [*rows, (70, rows[3][1]), (71, None), (72, ""), (73, "periodic " * 40), (None, rows[9][1]), (None, "x" * 99), (None, rows[9][1]), (5, rows[5][1])]


@pytest.mark.parametrize("options", [{}, {"hot_runs": 1}, {"hot_runs": 3, "array_bytes": 500}])
def test_repeated_strings_by_brute_force(spark, options):
    rows = repetitive_documents()
    removed = suffix_dedup.remove_repeats(documents(spark, rows), **options)
    got = removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(suffix_dedup.brute_force(rows), key=repr)


def periodic(period, size, seed=5):
    rng = random.Random(seed + period)
    letters = "".join(rng.choice("abcdefgh") for _ in range(period))
    return (letters * (size // period + 1))[:size]


def test_long_periodic_texts_by_brute_force(spark):
    """Runs of one piece that are longer than one run may be, alone, repeated, and among other text."""
    rows = [(1, "=" * 30_000), (2, periodic(7, 20_000)), (3, periodic(71, 16_000)), (4, "x" * 200 + "=" * 11_000 + "y" * 200), (5, periodic(7, 12_345)),
            (6, periodic(11, 11_000) + periodic(400, 9000)), (7, "".join(f"{'-' * (i % 190)}\n" for i in range(150))), (8, periodic(13, 5040 + 99))]
    want = sorted(suffix_dedup.brute_force(rows), key=repr)
    for options in ({}, {"array_bytes": 3000}):
        removed = suffix_dedup.remove_repeats(documents(spark, rows), **options)
        got = removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_very_long_periodic_texts(spark):
    sizes = {1: (1, 12_000_000), 7: (2, 12_000_003), 60: (3, 9_000_001)}
    df = documents(spark, [(i, periodic(period, size)) for period, (i, size) in sizes.items()]).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).drop("kept").collect()}
    assert got == {i: (size, size - period, 1) for period, (i, size) in sizes.items()}


def test_runs_are_bounded():
    rows = pa.RecordBatch.from_pylist([{"no_id": False, "doc_id": 1, "text_key": 5, "text": periodic(7, 9_000_000)}])
    runs = pa.Table.from_batches(list(suffix_dedup._runs(iter([rows]))))
    assert max(runs["size"].to_pylist()) <= suffix_dedup.LONGEST
    assert sum(runs["size"].to_pylist()) == 9_000_000 - 99
    left = list(suffix_dedup._sift(iter(runs.filter(pa.compute.invert(runs["sure"])).sort_by([("piece", "ascending"), ("bytes_key", "ascending"), ("first", "ascending")]).combine_chunks().to_batches())))
    assert sum(sum(b["size"].filter(pa.compute.invert(b["sure"])).to_pylist()) for b in left) < 100_000


def test_repeated_strings_of_whole_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = suffix_dedup.op5_suffix_dedup(spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(suffix_dedup.brute_force(rows), key=repr)


def test_cutting_keeps_rows_columns_and_whole_characters(spark):
    rows = [(1, "é" * 80), (2, "x" + "é" * 80 + "y"), (3, None), (4, "n")]
    docs = spark.createDataFrame([(i, t, i, "l") for i, t in rows], "doc_id long, text string, n_chars long, row string")
    got = {r.doc_id: r for r in suffix_dedup.cut_repeats(docs).collect()}
    assert suffix_dedup.cut_repeats(docs).dtypes == docs.dtypes
    assert len(got) == 4 and got[2].text == "xy" and got[2].n_chars == 2 and got[3].text is None and got[4].n_chars == 4


def test_windows_are_found_at_every_offset_by_few_runs(spark):
    """A document gives one run for each six words, and each place of a window is found by them."""
    plain = [f"w{i}" for i in range(60)]
    docs = [(first, " ".join(plain[:first] + [f"b{i}" for i in range(10)] + plain[first:])) for first in range(51)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([("item", " ".join(["x", "y"] + [f"b{i}" for i in range(10)] + ["z"]))], "item_id string, text string")
    found = decontamination.find_hits(docs, benchmark)
    assert {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in found.collect()} == {(i, 70, 10, 1) for i in range(51)}
    runs = docs.select(F.size(decontamination._prints(decontamination.words_of(F.col("text")), 6)).alias("n"))
    assert {r["n"] for r in runs.collect()} == {11}
