"""Operators against brute force on the small tables, and on rows with nulls, ties, repeats and odd texts."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from contrail.llm import decontam, extraction, jaccard, langid, licenses, mixing, omh, quality, suffix, warc
from tests.conftest import SF001
from tests.llm import brute

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(6000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly boxed five dozen liquor jugs " * 2
ODD = [
    (1, PASSAGE + "first tail of its own kind", "en", "a", 1), (2, "an unlike start, then " + PASSAGE, "en", "a", 1), (3, None, None, None, None),
    (4, "", "fr", "b", 0), (5, "   \t\n ", None, "b", 5), (6, PASSAGE + "first tail of its own kind", "en", None, 1), (7, "one two", "de", "c", 7),
    (8, "One TWO", "de", "c", 7), (9, LONG, "en", "a", 9), (10, LONG.replace("word5x5", "changed", 3), "en", "a", 9), (None, PASSAGE, "en", "a", 1),
    (11, "1234 !!! 5678", "en", "a", 1), (12, "é" * 60 + "x" + "é" * 60, "fr", "d", 1), (13, "è" + "é" * 60, "fr", "d", 1),
    (14, "ab" * 80, "en", "d", 1), (15, "ab" * 90, "en", "d", 1), (15, "ab" * 90, "en", "d", 1), (16, "日本語のテキスト", None, "e", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns whose names the operators use themselves
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(i) for i, c in enumerate(("size", "score", "spans", "block", "row", "n", "keep", "copies"))})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_suffix_spans(spark, request, which):
    docs = request.getfixturevalue(which)
    found, _ = suffix.duplicate_spans(spark, docs, block_bytes=2000)
    got = sorted((r.doc_id or -1, bytes(r.kept), len(r.spans), sum(s.end - s.begin for s in r.spans)) for r in found.collect())
    rows = pairs(docs)
    assert got == sorted((i or -1, *e) for (i, _), e in zip(rows, brute.spans_removed(rows)))


def test_suffix_documents(spark, odd, none):
    out = suffix.deduplicated_documents(spark, odd)
    assert out.columns == odd.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert 6 not in rows and rows[1].text == ODD[0][1] and rows[3].text is None and rows[4].text == ""
    assert rows[2].text.startswith("an unlike start") and rows[2].n_chars == len(rows[2].text)
    assert suffix.deduplicated_documents(spark, none).count() == 0


def test_interval_tree():
    # abab, ab, b... : common prefixes 2, 0, 3, 3 give one interval of 2 and one of 3 over three suffixes
    assert suffix.interval_tree([2, 0, 3, 3], 2) == [(2, 0, 1, 0), (3, 2, 4, 0)]
    assert suffix.interval_tree([1, 4, 1], 1) == [(4, 1, 2, 1), (1, 0, 3, 0)]


def test_repeat_groups_are_maximal_with_all_occurrences(spark):
    mid = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRST"  # 56 bytes
    docs = spark.createDataFrame([(1, "A<" + mid + ">B"), (2, "C[" + mid + "]D"), (3, "E(" + mid + ")F")], "doc_id long, text string")
    got = suffix.repeat_groups(spark, docs).collect()
    whole = [r for r in got if bytes(r.sample).decode() == mid]
    assert whole and sorted(o.doc_id for o in whole[0].occurrences) == [1, 2, 3]


@pytest.mark.parametrize("which,cap,leaf", [("small", 4096, 64), ("odd", 4096, 64), ("small", 4, 2), ("odd", 2, 1)])
def test_jaccard(spark, request, which, cap, leaf):
    docs = request.getfixturevalue(which)
    found = jaccard.classes(spark, docs, cap=cap, leaf=leaf, block_bytes=2000)[1].collect()
    rows = pairs(docs)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in found)
    assert got == sorted((i or -1, *e) for (i, _), e in zip(rows, brute.jaccard_components(rows)))


def test_jaccard_large_region_of_near_copies(spark):
    base = [f"w{i}" for i in range(300)]
    docs = []
    for k in range(120):
        words = list(base)
        for j in range(k % 9):
            words[(37 * k + 31 * j) % 300] = f"edit{k}x{j}"
        docs.append((k, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted((i, *e) for (i, _), e in zip(docs, brute.jaccard_components(docs)))
    for cap in (4096, 16):
        got = jaccard.classes(spark, frame, cap=cap, leaf=8)[1].collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_documents(spark, odd, none):
    out = jaccard.distinct_documents(spark, odd)
    assert out.columns == odd.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids.count(15) == 1 and 6 not in ids and 8 not in ids and {3, 4, 5} <= set(ids)
    assert jaccard.distinct_documents(spark, none).count() == 0


def test_decontamination(spark, odd, none):
    items = [(1, "Jumps OVER the lazy dog while seven wizards quietly boxed five dozen"), (2, "one, two"), (3, None), (4, ""), (None, "lazy dog"), (2, "one, two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = pairs(odd)
    want = sorted((i or -1, *e) for (i, _), e in zip(rows, brute.contamination(rows, items)))
    for most in (100_000, 3):
        found = decontam.scan(spark, odd, bench, max_windows=most).collect()
        assert sorted((r.doc_id or -1, r.n_words, sum(s["last"] - s["first"] + 1 for s in r.spans), list(r["items"])) for r in found) == want
    out = decontam.decontaminate(spark, odd, bench)
    assert out.columns == odd.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert 7 not in kept and kept[9].text == LONG and "lazy dog" not in kept[1].text and kept[1].n_chars == len(kept[1].text)
    assert decontam.scan(spark, none, bench).count() == 0 and decontam.scan(spark, odd, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_mixing(spark, odd, none):
    rows = mixing.mix(spark, odd).collect()
    assert len(rows) == len(ODD)
    total = sum(r["size"] for r in rows)
    goals = {r.source: (r.source_size, r.target) for r in rows}
    assert all(t <= 3 * s + 1e-9 for s, t in goals.values()) and abs(sum(t for _, t in goals.values()) - total) < 1e-6 * total
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    for source, (size, target) in goals.items():
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - target) <= 3 * max((r["size"] for r in own), default=0)
    assert sorted((r.doc_id or -1, r.copies) for r in rows) == sorted((r.doc_id or -1, r.copies) for r in mixing.mix(spark, odd).collect())
    out = mixing.mixed_documents(spark, odd)
    assert out.columns == [*odd.columns, "mix_copy"] and out.count() == sum(r.copies for r in rows)
    assert mixing.mix(spark, none).count() == 0


def test_language(spark, small, odd, none):
    labelled = small.select("doc_id", "lang")
    got = langid.identify(spark, small).join(labelled, "doc_id")
    assert got.where("held_out").count() and got.where("lang_pred != lang").count() == 0
    assert got.where("score < 0 or score > 1").count() == 0
    # neither the languages nor the small hot table of a run change what is right
    a, b = (sorted(tuple(r) for r in langid.identify(spark, odd, hot_cells=c).select("doc_id", "lang_pred", F.round("score", 9)).collect()
                   if r.doc_id is not None) for c in (600_000, 8))
    assert a == b
    by_id = {r[0]: r for r in a}
    assert all(by_id[i][1] == "und" for i in (3, 4, 5, 11)) and by_id[16][1] != "und"
    assert langid.identify(spark, none).count() == 0
    assert {r.lang_pred for r in langid.identify(spark, odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identified_documents(spark, odd).columns == odd.columns


def test_order_minhash(spark, small, odd, none):
    rows = pairs(small)
    got = {r.doc_id: r for r in omh.fingerprints(spark, small, buckets=7).collect()}
    for (i, text), follow in zip(rows, brute.next_texts(rows)):
        assert got[i].edited_text == omh.edited(text, follow) and got[i].n_chars == len(text)
        assert got[i].near_next == omh.likeness(omh.signature(text), omh.signature(follow))
    assert sum(r.near_edited for r in got.values()) > 5 * sum(r.near_next for r in got.values())
    by = {}
    for r in omh.fingerprints(spark, odd).collect():
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[15]) == 2 and by[3][0].fingerprint == by[4][0].fingerprint and by[1][0].fingerprint == by[6][0].fingerprint
    assert omh.fingerprints(spark, none).count() == 0
    words = [f"w{i}" for i in range(200)]
    same, swapped = " ".join(words), " ".join(words[100:] + words[:100])
    moved = " ".join(sorted(words))
    sign = [omh.signature(t) for t in (same, swapped, moved)]
    assert omh.likeness(sign[0], sign[0]) == 1 and omh.likeness(sign[0], sign[2]) < omh.likeness(sign[0], sign[1]) < 1  # order counts


def test_warc_round_trip(spark, tmp_dir):
    big = "<p>" + "x\r\n\r\nWARC/1.1\r\n é" * 5000
    rows = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None), (4, "http://a/\r\nx", ""),
            (None, "http://a/5", big), (6, "http://a/6", big), (7, "u", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(spark, pages, chunk=1000, archive_bytes=1)
    chunks = warc.read_archives(spark, manifest, chunk=777).collect()
    first = {}
    for r in sorted((r for r in chunks if r.record_type == "response"), key=lambda r: (r.record_id, r.chunk_no)):
        data = first.setdefault(r.record_id, bytearray())
        data += r.chunk
        assert r.offset == len(data) and r.digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert sorted(bytes(v).decode() for v in first.values()) == sorted({"<p>same</p>", "", big})
    pages.write.parquet(f"{tmp_dir}/pages.parquet")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.query(spark, tmp_dir).collect()), key=str)
    least = {}
    for i, _, h in rows:
        least[h or ""] = min(least.get(h or "", 99), 99 if i is None else i)
    seen, want = set(), []
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        again = data in seen
        seen.add(data)
        want.append((i or 0, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", least[h or ""] if again else None))
    assert got == sorted(want, key=str)
    pages.limit(0).write.parquet(f"{tmp_dir}/none/pages.parquet")
    assert warc.query(spark, f"{tmp_dir}/none").count() == 0


def test_extraction(spark):
    page = ("<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body>"
            "<nav><ul><li><a href=/x>menu</a></li></ul></nav><!-- no --><div class=\"ad\">buy</div>"
            "<div class='post-7 content'><h1>Head &amp; line</h1><p><b>One.<br><p>Two,&nbsp;  three\n four &lt;5.</p><ul><li>a<li>b</ul>"
            "<div class='share'>share</div><form>f</form></div><div id='comments'><p>reader says a lot, and more, and more.</p></div>"
            "<aside>side</aside><footer>&copy; foot</footer></body></html>")
    rows = [(1, "http://h/1", page), (2, "http://h/2", page.replace("post-7", "post-88")), (3, "http://h/3", None), (4, None, ""), (5, "http://x", "plain & simple <b>text"),
            (6, "http://h/6", "<body><div class='content post-3'><p>short</p><p>cut &am"), (7, "http://h/7", "<nav>only menu</nav>"), (7, "http://h/7", "<nav>only menu</nav>")]
    got = {r.page_id: r for r in extraction.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Head & line\n\nOne.\n\nTwo, three four <5.\n\na\n\nb"
    assert got[1].text == want and got[2].text == want and got[1].path == got[2].path == "/html/body/div.content.post-#"
    assert (got[3].text, got[4].text, got[5].text, got[6].text, got[7].text) == ("", "", "plain & simple text", "short\n\ncut &am", "")


def test_extraction_of_layouts():
    def text(page):
        found = extraction.blocks(page)
        return extraction.main_text(found, extraction.best_path(found)[0])

    body = "<p>A first paragraph of some length, as articles have.</p><p>And a second one, longer than the first, to fill the body.</p>"
    want = "Head\n\nA first paragraph of some length, as articles have.\n\nAnd a second one, longer than the first, to fill the body."
    side = "<div class='sidebar'><p>Most read this week, a long list of things, none of them here.</p></div>"
    # the layout's name tells what lies beside it
    assert text(f"<body><div class='content with-sidebar'><h1>Head</h1>{body}</div>{side}</body>") == want
    # a headline beside the text, in a part named header or not; the byline of a header goes
    assert text(f"<body><div class=post><div class='entry-header'><h1>Head</h1><span>by X</span></div><div class=body>{body}</div></div>{side}</body>") == want
    assert text(f"<body><div class=post><h1>Head</h1><div class=body>{body}</div></div>{side}</body>") == want
    # a site's header and a comment thread stay out
    assert text(f"<body><div id=siteHeader><h1>The Site</h1></div><div class=post><h1>Head</h1>{body}<div id=userComments>{body}</div></div></body>") == want
    assert text(f"<body><div class=cookieConsent>{body}</div><article><header><h1>Head</h1><p>by X</p></header>{body}</article></body>") == want


def test_extraction_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    for r in extraction.extract(spark, pages).collect():
        assert r.path.endswith("/article") and r.text and "<" not in r.text.replace("<<<", "")


def test_licenses(spark, odd, none):
    texts = [(1, "x y. Licensed under the Apache License, Version 2.0. z"), (2, "Released under the M I T License"), (3, None), (4, ""),
             (5, "This work is licensed under the GNU General Public License, version 3."),
             (6, LONG + " Permission is hereby granted, free of charge, to any individual obtaining a copy of this software and associated documentation "
                        "files (the Software), to deal in the Software without restriction " + LONG), (6, "licensed under")]
    got = [(r.doc_id, [(m.license, m.coverage) for m in r.matches], r.matches) for r in licenses.scan(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    by = {i: m for i, m, _ in got if m}
    assert [m[0] for m in by[1]] == ["Apache-2.0 (short)"] and [m[0] for m in by[5]] == ["GPL-3.0 (short)"]
    assert by[6][0][0] == "MIT (grant)" and 0.9 < by[6][0][1] < 1 and set(by) == {1, 5, 6}
    span = next(m for i, _, m in got if i == 6 and m)[0]
    assert texts[5][1][span.begin:span.end].startswith("Permission is") and texts[5][1][span.begin:span.end].endswith("without restriction")
    assert licenses.scan(spark, none).count() == 0 and licenses.scan(spark, odd).count() == len(ODD)


def test_quality_model_sums_to_one_and_matches_the_chain(spark):
    texts = [b"abracadabra", b"abba", b"cad", b""]
    model = quality.train(spark, spark.createDataFrame([(t,) for t in texts], "text binary"), order=3)
    contexts = [b"ab", b"ra", b"zz"]
    grams = [int.from_bytes(c + bytes([x]), "big") for c in contexts for x in range(256)]
    probabilities = {r.gram: r.logp for r in quality.log_probability(model, spark.createDataFrame([(g,) for g in grams], "gram long")).collect()}
    import math
    for c in contexts:
        assert abs(sum(math.exp(probabilities[int.from_bytes(c + bytes([x]), "big")]) for x in range(256)) - 1) < 1e-9


def test_quality_perplexity_does_not_depend_on_the_hot_table(spark, small):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    a, b = ({r.doc_id: r for r in quality.classify(spark, small, labels, hot=h).collect()} for h in (300_000, 50))
    assert len(a) == small.count() and all(abs(a[i].perplexity - b[i].perplexity) < 1e-6 * a[i].perplexity for i in a)
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert sum(not a[i].keep for i in good) <= max(2, 0.02 * len(good))


def test_quality_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 0), (9, 1, 1), (None, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.classify(spark, odd, labels).collect()}
    assert rows[3].perplexity is None and not rows[3].keep and not rows[4].keep and rows[9].perplexity < rows[16].perplexity
    assert quality.classify(spark, none, labels).count() == 0
    assert quality.classify(spark, odd, labels.limit(0)).where("keep").count() == sum(bool(t) for _, t, *_ in ODD)


def test_quality_recall_on_documents_not_fitted(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    report = quality.part() == 1  # neither trained on nor fitted
    rows = quality.classify(spark, spark.read.parquet(f"{sf}/documents.parquet"), labels.where(~report)).join(labels.where(report), "doc_id").collect()
    gone = lambda kind: sum(not r.keep for r in rows if kind(r)) / sum(map(kind, rows))
    assert gone(lambda r: r.quality == 0) >= 0.95
    assert gone(lambda r: r.quality == 1 and r.toxic == 1) >= 0.5
    assert gone(lambda r: r.quality == 1 and r.toxic == 0) <= 0.15


def test_quality_limits_follow_the_labels(spark):
    good = [("x", 100 + i / 10, True, False) for i in range(1000)]
    bad = [("x", 50.0, False, True)] * 30 + [("x", 195.5, False, False)] * 30  # texts that repeat one word, texts just inside the loosest limit
    limits, upper, lower = quality.language_limits(spark, spark.createDataFrame(good + bad, "of string, ppl double, good boolean, low boolean"))
    row = limits.first()
    assert 190 < row.upper < 195.5 and row.upper == pytest.approx(upper) and 100 < row.lower < 103 and row.lower == pytest.approx(lower)
    limits, _, lower = quality.language_limits(spark, spark.createDataFrame(good, "of string, ppl double, good boolean, low boolean"))
    assert limits.first().lower is None and lower is None


def test_quality_limits_of_rare_languages_change_smoothly(spark):
    def upper(n):
        rows = [("hot", 100 + i / 10, True, False) for i in range(1000)] + [("rare", 10 + i / n, True, False) for i in range(n)]
        limits, _, _ = quality.language_limits(spark, spark.createDataFrame(rows, "of string, ppl double, good boolean, low boolean"))
        return {r.of: r.upper for r in limits.collect()}["rare"]

    one, few, more, many = map(upper, (1, 49, 50, 400))
    assert 200 > one > few > more > many > 10 and few / more < 1.05


def test_pipeline(spark, odd, tmp_dir):
    import corpus_pipeline
    odd.write.parquet(f"{tmp_dir}/documents.parquet")
    bench = spark.createDataFrame([(1, "seven wizards quietly boxed five dozen liquor jugs the quick brown")], "item_id long, text string")
    bench.write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs, counts = spark.read.parquet(f"{tmp_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == [*odd.columns, *(["mix_copy"] if name == "mix" else [])]
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        counts.append(docs.count())
    assert counts[0] == len(ODD) - 4  # null, empty, blank, no letters
    assert sorted(map(str, corpus_pipeline.run(spark, tmp_dir).collect())) == sorted(map(str, docs.collect()))
    odd.limit(0).write.parquet(f"{tmp_dir}/none/documents.parquet")
    bench.write.parquet(f"{tmp_dir}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_dir}/none").count() == 0


@pytest.mark.parametrize("name", ["op8_mixing", "op10_decontamination"])
def test_sql(spark, name):
    import duckdb
    from contrail.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall()) and sorted(df.columns) == sorted(columns)
