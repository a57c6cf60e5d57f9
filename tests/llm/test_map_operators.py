"""Operators that read documents one by one: license scans, BPE, token counts,
HTML, toxicity."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import bpe_chunks, html_text, license_scan, token_counts, toxicity
from strata.llm.common import WordHash, python_words, slices, word_spans, words


def key(row):
    return tuple((x is not None, x) for x in row)


def test_words_agree(spark, corpus, frame):
    rows = corpus + [(900, "A-b_C ÀÉ d\x00e 9\x7f! Z"), (901, "--"), (902, "ÄB cD")]
    df = frame(rows)
    got = sorted((r.text or "", r.w) for r in df.select("text", words(df["text"]).alias("w")).collect())
    assert got == sorted((t or "", python_words(t)) for _, t in rows)
    batch = pa.record_batch([pa.array([t for _, t in rows])], ["text"])
    seen = []
    for part, raw, off in slices(batch, limit=500):
        low, starts, ends, first = word_spans(raw, off)
        h = WordHash()(low, starts, ends)
        for d in range(len(part)):
            ws = [low[a:b].tobytes().decode() for a, b in zip(starts[first[d]:first[d + 1]], ends[first[d]:first[d + 1]], strict=True)]
            seen.append(ws)
            assert len(set(ws)) == len(set(h[first[d]:first[d + 1]].tolist()))
    assert seen == [python_words(t) for _, t in rows]


def base_places(text):
    ws, found = python_words(text), []
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(ws)) if ws[i:i + len(p)] == p]
    return len(ws), found


def test_license_scan(spark, corpus, frame):
    texts = ["Licensed under the Apache License, Version 2.0", "gnu\n * General-Public License; MIT License mit license, cc by",
             "cc bye acc by", "permission is hereby granted, free of charge, to any persom obtaining a copie", "GNU GENERAL PUBLIC",
             "license mit", "apache license apache license", "redistribution and use in source and binary form with or without modification are permited"]
    rows = corpus + [(1000 + i, t) for i, t in enumerate(texts)]
    got = {key((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in license_scan.report(frame(rows)).collect()}
    want = set()
    for i, t in rows:
        n, found = base_places(t)
        at = [a for a, _ in found]
        want.add(key((i, n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))))
    assert got == want
    by = {r.doc_id: r for r in license_scan.report(frame(rows)).collect()}
    assert by[1003].labels == "mit" and 0.9 < by[1003].score < 1 and by[1003].n_base == 0
    assert by[1007].labels == "bsd" and by[1004].labels == "" and by[1004].score == 0
    assert by[1000].found.startswith("apache:3:2:0") and "apache:0:8:0" in by[1000].found
    assert license_scan.report(frame([])).collect() == []


def test_pigeonhole_misses_nothing():
    """Every notice with random edits within the bound is found."""
    regex = pytest.importorskip("regex")
    rnd = random.Random(1)
    notices = license_scan.NOTICES
    patterns = []
    for notice, _ in notices:
        k = max(1, len(notice) // license_scan.EDIT_EVERY)
        patterns.append((k, regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice, special_only=True)}){{e<={k}}}(?= )")))
    for notice, label in notices:
        for _ in range(12):
            k, text = max(1, len(notice) // license_scan.EDIT_EVERY), list(notice)
            for _ in range(rnd.randint(0, k)):
                at = rnd.randrange(1, len(text) - 1)
                kind = rnd.choice("rid")
                if kind == "r":
                    text[at] = rnd.choice("abcxyz")
                elif kind == "i":
                    text.insert(at, rnd.choice("abcxyz"))
                else:
                    del text[at]
            whole = "some words before " + "".join(text) + " and after"
            raw = np.frombuffer(whole.encode(), np.uint8)
            _, spans = license_scan.scan_batch(raw, np.array([0, len(raw)]), (), notices, patterns)
            assert label in {s["label"] for s in spans[0]}, (notice, "".join(text))


def test_bpe_equals_the_library(spark, corpus, frame):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe_chunks.vocabulary_paths()[0])
    rnd = random.Random(3)
    signs = "ab é\u0085　 \n\t'sI’😀漢字ñ ​ǅʼ0٣²_"
    odd = ["".join(rnd.choice([rnd.choice(signs)] * 9 + ["<|endoftext|>", " word", "'ll", "  \n", "<|endof"]) for _ in range(rnd.randrange(120))) for _ in range(300)]
    rows = corpus + [(2000 + i, t) for i, t in enumerate([*odd, "<|endoftext|>", "x" * 5000, " " * 3000])]
    got = sorted((key((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in bpe_chunks.report(frame(rows)).collect()))
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert text == (t or "")
        want.append(key((i, len(ids), bpe_chunks.digest_ids(ids), hashlib.sha256(text.encode()).hexdigest())))
    assert got == sorted(want)
    assert bpe_chunks.report(frame([])).collect() == []


def test_bpe_keeps_columns_and_decodes_any_ids(spark, frame):
    df = bpe_chunks.encode(frame([(1, "salt and bread"), (2, None)]))
    assert [c for c in df.columns if c != "ids"] == [c for c in frame([]).columns if c != "ids"]
    back = {r.doc_id: r.decoded for r in bpe_chunks.decode(df).collect()}
    assert back == {1: "salt and bread", 2: ""}
    half = spark.createDataFrame([(1, [0xC3 - 0x5E]), (2, None)], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe_chunks.decode(half).collect()}[2] == ""


def test_chunks_are_shared():
    """A passage in other surroundings falls into the same pieces."""
    rnd = random.Random(2)
    passage = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(900))
    cut = []
    for text in ("one two " + passage, passage[100:] + " tail " * 50):
        raw = np.frombuffer(text.encode(), np.uint8)
        at = bpe_chunks.borders(raw, np.array([0, len(raw)]))
        cut.append({text[a:b] for a, b in zip(at, at[1:], strict=False)})
    assert len(cut[0] & cut[1]) > 0.7 * min(map(len, cut))


def best_split(word, scores, byte):
    word = token_counts.MARK + word
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(best[-1][0] + width * byte, best[-1][1] - width)]
        options += [(best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores]
        best.append(max(options))
    return -best[-1][1], best[-1][0]


def test_token_counts(spark, corpus, frame):
    scores, byte = token_counts.piece_scores(token_counts.vocabulary_path())
    rows = corpus + [(3000, "thereafter there therein the therefore 漢字😀 ▁ ▁▁a"), (3001, "w" * 3000)]
    rows = [(i, t if t is None else t[:6000]) for i, t in rows]
    got = sorted(key((r.doc_id, r.n_pretokens, r.n_tokens, r.score)) for r in token_counts.count_tokens(frame(rows)).collect())
    memo = {w: best_split(w, scores, byte) for w in {w for _, t in rows for w in (t or "").split() if len(w) < 3000}}
    memo["w" * 3000] = best_split("w" * 3000, scores, byte)
    want = []
    for i, t in rows:
        ws = (t or "").split()
        want.append(key((i, len(ws), sum(memo[w][0] for w in ws), sum(memo[w][1] for w in ws))))
    assert got == sorted(want)
    assert token_counts.count_tokens(frame([])).collect() == []


def test_html_blocks_and_tree():
    x, y = html_text.labelled_rows()
    tree = html_text.train()
    assert all(html_text.accepts(tree, row) == label for row, label in zip(x, y, strict=True))
    page = """<!doctype html><html class="has-sidebar"><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head>
    <body class="no-sidebar"><nav><a href='/x>y'>Menu</a></nav><div class='cookie-banner'>We use cookies and so on, for all we know.</div>
    <article><header><h1>Head &amp; tail</h1></header><p>First&nbsp;para<b>graph</b> is<br>long
    enough &#x41; to read, with a <a href="/l">link</a> inside.<p>Second &lt;one&gt;.</p><!-- <p>not</p> --><aside>Ad text here</aside>
    <ul><li>Point 1</li><li>Point 2</li></ul><div class="comments"><p>A reader comment that is long enough to look like text.</p></div>
    </article><form><input><p>Search the site for more of the same kind of text</p></form><footer>Imprint</footer></body></html>"""
    assert html_text.main_text(page, tree) == (
        "Head & tail\nFirst paragraph is long enough A to read, with a link inside.\nSecond <one>.\nPoint 1\nPoint 2")
    assert html_text.main_text("", tree) == "" and html_text.main_text("<p", tree) in ("", "<p")
    assert html_text.blocks("<script>x") == [] and html_text.blocks("</p></div>a</nav>")[0].text == "a"


def test_html_rest_of_the_page_stays():
    text = lambda page: " ".join(b.text for b in html_text.blocks(page))
    assert text('<p>a<svg class="i"/>b</p><p>rest</p>') == "ab rest"
    assert text("<p>a<svg-icon></svg-icon>b</p><canvas-x><p>rest</p></canvas-x>") == "ab rest"
    assert text("<p>a</p><canvas><p>b</p><iframe class=ad><object data='x'><p>c</p>") == "a b c"
    assert text("<p>a<svg><text>x</text></svg>b</p><script>if (a<b) '</p>'</script><template/><p>x</p></template>c<style>d") == "ab c"
    tree = html_text.train()
    long = "The long text of the page, which goes on for a good while and is what readers came for."
    for page in (f'<div class="wrapper has-sidebar"><article><p>{long}</p></article></div>',
                 f'<form id="all"><article><p>{long}</p></article></form>',
                 f'<div class="page with-toolbar"><div class="content"><p>{long}</p></div></div>'):
        assert html_text.main_text(f"<body>{page}</body>", tree) == long
    for page in (f"<aside><article><p>{long}</p></article></aside>", f'<div class="comments"><div class="text"><p>{long}</p></div></div>',
                 f'<article><p>{long}</p><div class="sidebar"><div class="content"><p>Not this</p></div></div></article>'):
        assert html_text.main_text(f"<body>{page}</body>", tree) in ("", long)


def test_html_on_pages(spark, sf):
    """On the given pages the main text is what stands in the article."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = spark.createDataFrame([(9001, None, None), (9002, "u", ""), (9002, "u", "")], "page_id bigint, url string, html string")
    got = html_text.extract(pages.unionByName(odd).selectExpr("*", "'x' AS text", "1 AS n_chars")).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    assert len(got) == len(source) + 3
    for r in got:
        page = source.get(r.page_id)
        parts = []
        if page:
            inner = page[page.find("<article>") + 9:page.find("</article>")]
            parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_toxicity_learns_and_handles_edges(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    docs = docs.join(labels.select("doc_id"), "doc_id").union(
        spark.createDataFrame([(None, None), (None, ""), (10**7, ""), (10**7, "")], docs.schema))
    rows = toxicity.report(docs, labels.union(labels.limit(5))).collect()
    assert len(rows) == len(truth) + 4
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (None, 10**7)}) == 1
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = np.array([s for s, t in held if t]), np.array([s for s, t in held if not t])
    assert (pos[:, None] > neg[None]).mean() > 0.95
    assert (neg >= 0.3).mean() < 0.01 and (pos >= 0.3).mean() > 0.7


def test_toxicity_ftrl_update_by_hand():
    """One coordinate, one example, against the textbook formulas."""
    z, n = np.zeros(3), np.zeros(3)
    toxicity.learn([(np.array([0]), 1)], z, n)
    g = 0.5 - 1
    assert n[0] == pytest.approx(g * g) and z[0] == pytest.approx(g) and n[1] == 0
    w = toxicity.weights(np.array([-4.0]), np.array([1.0]))[0]
    assert w == pytest.approx((4.0 - toxicity.L1) / ((toxicity.BETA + 1) / toxicity.ALPHA + toxicity.L2))
    assert toxicity.weights(np.array([toxicity.L1 / 2]), np.array([1.0]))[0] == 0


def test_toxicity_without_labels(spark, frame):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    rows = toxicity.report(frame([(1, "a"), (2, None)]), labels).collect()
    assert len({r.score for r in rows}) == 1 and toxicity.report(frame([]), labels).collect() == []
    kept = toxicity.score(frame([(1, "a")]), toxicity.Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0))
    assert kept.first().score == 0.5 and kept.columns.count("score") == 1
