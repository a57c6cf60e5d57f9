"""Benchmark decontamination with a distributed positional inverted index.

The index holds the postings (document, term, position) of every word of the
training texts that is a word of the benchmark, written once to the shared
checkpoint folder.  A window is ``WINDOW`` consecutive words of an item (all
of a shorter item).  The two rarest terms of a window are looked up; their
lists, shifted by the terms' offsets, meet where the window may stand: equal
shifted places are candidates for the exact phrase, which the document's own
words then confirm; places at most ``SLOP`` apart are proximity matches.

DataFrame functions only.  Documents are keyed by id and text hash, so
repeated rows and null ids are answered row by row and equal rows alike.
Null and wordless texts and items have no words; null item ids are not
listed; an empty benchmark or document table gives no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import small, words

WINDOW = 13
SLOP = 3
SHARE = 20


def keyed(docs: DataFrame) -> DataFrame:
    """(row, text, k, h): a whole row as a struct; k and h tell documents apart,
    and rows that agree in both have the same text and so the same answer."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text",
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k"), F.xxhash64("text").alias("h"))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(wid, phrase, items): the distinct windows and the items they are of."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    each = items.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), size).alias("phrase"))
    return (each.groupBy("phrase").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
            .withColumn("wid", F.xxhash64("phrase")))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(k, h, text), one row each: rows that agree in k and h are found by
    their hashes and reduced by a partial aggregate, others are not moved."""
    rows = keyed(docs).select("k", "h", "text")
    again = small(materialize(rows.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "h")))
    many = rows.join(again, ["k", "h"], "left_semi").groupBy("k", "h").agg(F.first("text").alias("text"))
    return rows.join(again, ["k", "h"], "left_anti").unionByName(many)


def postings(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """The index: (k, h, term, pos) of benchmark words, written once."""
    terms = wins.select(F.explode("phrase").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    each = distinct_texts(docs).select("k", "h", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    each = each.select("k", "h", F.xxhash64("word").alias("term"), "pos")
    return materialize(each.join(small(terms), "term", "left_semi"))


def rarest(wins: DataFrame, index: DataFrame) -> DataFrame:
    """(term, wid, off, nth, n): the two rarest places of every window all of
    whose words the index has."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    places = wins.select("wid", F.size("phrase").alias("n"), F.posexplode("phrase").alias("off", "word"))
    places = places.withColumn("term", F.xxhash64("word")).join(counts, "term")
    by = Window.partitionBy("wid")
    return (places.withColumn("known", F.count(F.lit(1)).over(by))
            .withColumn("nth", F.row_number().over(by.orderBy("cf", "off")))
            .filter((F.col("known") == F.col("n")) & (F.col("nth") <= 2)).select("term", "wid", "off", "nth", "n"))


def meet(wins: DataFrame, index: DataFrame, slop: int = SLOP) -> DataFrame:
    """(k, h, wid, start, distance, exact): where the shifted lists of a
    window's two rarest terms meet, exactly or within ``slop`` words.  Each
    document and window is one sorted pass over its two lists."""
    lists = (index.join(small(rarest(wins, index)), "term")
             .select("k", "h", "wid", "nth", "n", (F.col("pos") - F.col("off")).alias("start")))
    order = Window.partitionBy("k", "h", "wid").orderBy("start", "nth").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda nth: F.last(F.when(F.col("nth") == nth, F.col("start")), ignorenulls=True).over(order)
    met = lists.withColumn("one", last(1)).withColumn("two", last(2))
    single = F.col("n") == 1
    return met.filter(single | (F.abs(F.col("one") - F.col("two")) <= slop)).select(
        "k", "h", "wid", "start", F.when(single, 0).otherwise(F.abs(F.col("one") - F.col("two"))).alias("distance"),
        (single | (F.col("one") == F.col("two"))).alias("exact"))


def covered(spans: Column) -> Column:
    """Words inside a union of spans {start, end}."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto"))
    step = lambda a, s: F.struct(
        (a["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("total"),
        F.greatest(a["upto"], s["end"]).alias("upto"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda a: a["total"])


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Per document: the whole ``row``, its word count, the exact places
    ``spans`` of windows, the ``items`` they are of, and the proximity matches
    ``near`` (start, distance, items): windows without an exact place in the
    document whose rarest terms stand within ``slop`` words of their places."""
    wins = materialize(windows(benchmark, size))
    index = postings(docs, wins)
    found = (meet(wins, index, slop).join(small(wins), "wid")
             .groupBy("k", "h").agg(
                 F.collect_list(F.when(F.col("exact"), F.struct("start", "phrase", "items", "wid"))).alias("places"),
                 F.collect_list(F.struct("start", "distance", "items", "wid")).alias("close")))
    rows = keyed(docs).join(found, ["k", "h"], "left").withColumn("w", words(F.col("text")))
    there = F.filter(F.coalesce("places", F.array().cast(found.schema["places"].dataType)), lambda p: (
        (p["start"] >= 0) & (F.slice(F.col("w"), F.greatest(p["start"], F.lit(0)) + 1, F.size(p["phrase"])) == p["phrase"])))
    rows = rows.withColumn("there", there)
    close = F.coalesce("close", F.array().cast(found.schema["close"].dataType))
    wids = lambda places: F.transform(places, lambda p: p["wid"])
    rows = rows.withColumn("only_close", F.array_except(wids(close), wids(F.col("there"))))
    near = F.transform(F.filter(close, lambda p: F.array_contains(F.col("only_close"), p["wid"])),
                       lambda p: F.struct(p["start"].alias("start"), p["distance"].alias("distance"), p["items"].alias("items")))
    return rows.select(
        "row", F.size("w").alias("n_words"),
        F.transform("there", lambda p: F.struct(p["start"].alias("start"), (p["start"] + F.size(p["phrase"])).alias("end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("there", lambda p: p["items"])))).alias("items"),
        near.alias("near"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: hit words, the items found and the decision."""
    rows = matches(docs.select("doc_id", "text"), benchmark).withColumn("hit", covered(F.col("spans")).cast("long"))
    return rows.select(
        "row.doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("hit").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated(F.col("hit"), F.col("n_words")).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    rows = matches(docs, benchmark)
    return rows.filter(~contaminated(covered(F.col("spans")), F.col("n_words"))).select("row.*")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS phrase
    FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(s)),
hits AS (SELECT r, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase),
words AS (SELECT r, count(DISTINCT s + o) AS n_hit FROM hits, unnest(range(0, n)) AS t(o) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
