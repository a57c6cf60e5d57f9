"""The corpus pipeline against its stages done by hand."""

import hashlib

import corpus_pipeline
from strata.llm import pseudonyms, toxicity
from strata.llm.bpe_chunks import digest_ids, vocabulary_paths
from strata.llm.common import python_words, table

from test_corpus_operators import jaccard_by_hand


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]


def test_pipeline(spark, sf):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs, model).filter(f"score < {toxicity.THRESHOLD}")
    rows = sorted((r.doc_id, r.text) for r in scored.collect())
    named, _ = jaccard_by_hand(rows)
    text = dict(rows)
    rows = [(i, text[i]) for i, c, _ in named if i == c]
    windows = set()
    for r in table(spark, sf, "benchmark").collect():
        w = python_words(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes, clean = {len(w) for w in windows}, []
    for i, t in rows:
        w, hit = python_words(t), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append((i, t))
    library = Tokenizer.from_file(vocabulary_paths()[0])
    hidden = pseudonyms.report(spark.createDataFrame(clean, "doc_id bigint, text string")).collect()
    want = set()
    for r in hidden:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), digest_ids(ids), hashlib.sha256(r.text.encode()).hexdigest()))
    got = {tuple(r) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 40")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes
