"""No text may stop a run: very long and odd texts through the registered
operators, and what they must give."""

import collections
import hashlib
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from strata.llm import bpe_chunks, decontamination, html_text, jaccard_join, license_scan, pseudonyms

MB = 1_000_000


def within_a_minute(run):
    start = time.time()
    got = run()
    assert time.time() - start < 60
    return got


def test_pseudonyms_of_long_runs(spark, frame):
    texts = ["a@" + "b." * 3000 + "com 5", "a@" + "b." * (MB // 2) + "com", "a@" + "b" * MB, "1" * MB, "1." * (MB // 2), "4 " * (MB // 2),
             "A1 " * (MB // 3), "a-" * (MB // 2) + "@x.com", "+49 " * (MB // 4), "(" * MB, "write to someone@mail.example.com now"]
    rows = within_a_minute(lambda: pseudonyms.pseudonymize(frame(list(enumerate(texts)), extra=False)).collect())
    got = {r.doc_id: r.text for r in rows}
    assert len(got) == len(texts) and all(len(got[i]) == len(t) for i, t in enumerate(texts))
    assert "someone@" not in got[10] and "@mail.example.com" in got[10]


def test_bpe_of_long_blank_runs(spark, frame):
    texts = [" " * MB, "\n" * MB, "a" + "\t" * (MB // 2) + " b", "x \n" * (MB // 3), "漢字" * 40_000, "a" * 50_000]
    rows = within_a_minute(lambda: bpe_chunks.report(frame(list(enumerate(texts)), extra=False)).collect())
    library = Tokenizer.from_file(bpe_chunks.vocabulary_paths()[0])
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == bpe_chunks.digest_ids(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_store_is_bounded_by_bytes():
    encoder = bpe_chunks.Encoder(*bpe_chunks.vocabulary_paths())
    for i in range(200):
        raw = np.frombuffer((f"{i}漢字" * 2000).encode(), np.uint8)
        encoder.documents(raw, np.array([0, len(raw)]))
    assert encoder.held <= bpe_chunks.STORE and all(len(p) <= bpe_chunks.LONGEST for p in encoder.store)


def test_html_is_read_once():
    tree = html_text.train()
    pages = ["<a " * 300_000, '<a x="' * 150_000 + ">", "<a ' " * 200_001 + ">", "<" * MB, "<!-- " * 200_000, "</" * 500_000, "<div>" * 100_000 + "</p>" * 100_000,
             "<svg>" * 100_000, '<p class="a"">x</p>' * 10_000]
    within_a_minute(lambda: [html_text.main_text(p, tree) for p in pages])


SAID = "The harbour council met on Monday to discuss the new bridge and what it would cost the town."
MORE = "Another long paragraph says what was decided in the evening, and who had voted against the plan."
ADVERT = "Buy our wonderful product now today, in all shops near you, before the last one has been sold."


@pytest.mark.parametrize(("inner", "want"), [
    (f'<article><p class="a"">{SAID}</p></article>', [SAID]),
    (f"<article><p title=it's>Hello first para. It's fine, and long enough to be text.</p><p>{SAID}</p></article>", ["Hello first para. It's fine, and long enough to be text.", SAID]),
    (f'<article><p>{SAID}</p><p class="advert">{ADVERT}</p><p>{MORE}</p></article>', [SAID, MORE]),
    (f"<article><p>{SAID}</p><p hidden>{ADVERT}</p></article>", [SAID]),
    (f'<article><p>{SAID}</p><p class="post-footer">{ADVERT}</p></article>', [SAID]),
    (f'<article><p>{SAID}</p><div id="pageFooter"><p>{ADVERT}</p></div><p>{MORE}</p></article>', [SAID, MORE]),
    (f'<article><ul><li class="shareThis">{ADVERT}<li>{SAID}</ul></article>', [SAID]),
    (f'<div id="content" class="newsletter-page"><p>{SAID}</p><p>{MORE}</p></div>', [SAID, MORE]),
    (f'<div class="story search-result"><p>{SAID}</p><p>{MORE}</p></div>', [SAID, MORE]),
    (f'<div class="content-footer"><p>{ADVERT}</p></div><article><p>{SAID}</p></article>', [SAID]),
    ("<article><p>One &lt; two, and 3 > 2 < 4 is true in this long paragraph of text, as all know.</p></article>", ["One < two, and 3 > 2 < 4 is true in this long paragraph of text, as all know."]),
])
def test_html_names_and_attributes(inner, want):
    page = f'<html><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>{inner}<footer>Copyright, all rights reserved</footer></body></html>'
    assert html_text.main_text(page, html_text.train()) == "\n".join(want)


def test_decontamination_of_many_equal_rows(spark, frame):
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words[5:20])
    rows = [(None, " ".join(words))] * 10_000 + [(1, "clean words only")]
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = within_a_minute(lambda: decontamination.report(frame(rows, extra=False), benchmark).groupBy("doc_id", "n_words", "n_hit", "contaminated").count().collect())
    assert {tuple(r) for r in got} == {(None, 40, 15, True, 10_000), (1, 3, 0, False, 1)}


def test_decontamination_proximity_excludes_exact(spark, frame):
    words = [f"w{i}" for i in range(13)]
    item = " ".join(words)
    near = " ".join(words[:6] + ["more"] + words[6:])  # one word put in
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    rows = [(1, item), (2, near), (3, item + " and then " + near), (4, "nothing of it")]
    got = {r.row.doc_id: r for r in decontamination.matches(frame(rows, extra=False), benchmark).collect()}
    assert [len(got[i].spans) for i in (1, 2, 3, 4)] == [1, 0, 1, 0]
    assert not got[1].near and not got[3].near and not got[4].near
    assert got[2].near and all(n["items"] == ["7"] and n.distance <= decontamination.SLOP for n in got[2].near)


def test_license_score_is_of_the_notice_found(spark, frame):
    notice, label = min(((n, x) for n, x in license_scan.NOTICES if sum(x == y for _, y in license_scan.NOTICES) > 1), key=lambda p: len(p[0]))
    assert max(len(n) for n, x in license_scan.NOTICES if x == label) > len(notice)
    edited = notice[:-3] + notice[-2:]  # one character lost
    r = license_scan.report(frame([(1, f"x\n{edited}\ny")], extra=False)).first()
    spans = license_scan.scan(frame([(1, f"x\n{edited}\ny")], extra=False)).first().spans
    assert label in r.labels.split(",") and r.score == max(1 - s.edits / s.size for s in spans)
    assert {s.size for s in spans if s.label == label} <= {len(n) for n, x in license_scan.NOTICES if x == label}


def test_jaccard_of_chained_clusters(spark, frame, monkeypatch):
    """Texts chained by common passages: verified by band buckets."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rows = []
    for i in range(40):  # each shares much with its neighbours, nothing with others
        rows.append((i, " ".join(f"p{(i + j) // 4}x{j % 50}" for j in range(200))))
    rows += [(100 + i, rows[0][1].replace("p0x1 ", f"q{i} ", 1)) for i in range(12)]
    grams = {i: {tuple(t.split()[a:a + 5]) for a in range(len(t.split()) - 4)} for i, t in rows}
    linked = {(a, b) for a in grams for b in grams if a != b and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])}
    want = collections.Counter(a for a, _ in linked)
    got = {r.doc_id: r.n_links for r in jaccard_join.report(frame(rows)).collect()}
    assert got == {i: want[i] for i in grams}
