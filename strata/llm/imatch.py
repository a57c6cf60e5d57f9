"""Document fingerprints by I-Match.

The lexicon holds the words whose inverse document frequency lies in a band,
counted over distinct texts, so copies do not push their own words out.
Words in more than ``MIN_SHARE`` of the texts are at most (mean distinct
words of a text) / MIN_SHARE, whatever the corpus size, so the lexicon is
broadcast once its size is checked.  A document's distinct lexicon words,
sorted, are hashed for several randomised subsets of the lexicon (each keeps
a word with probability 2**-rate, by seeded hashes).  A text without lexicon
words is hashed by all its own words instead, and one whose words are in no
subset by all of them in the first place, so only texts without any word have
an empty fingerprint.  The
fingerprint is the row of these hashes; small subsets still agree after edits
that change every large one.  Likeness of two fingerprints is the share of
equal subset hashes among those where either has a word; two fingerprints
without any word are alike (1.0).

DataFrame functions only.  Documents are numbered by one range sort on (id,
first characters and hash of the text), descending; every ``BLOCK`` consecutive numbers are a block
that finds its next texts in one task, and a block's last row gets the first
text of the following block.  Neither a null id, nor a repeated one, nor
many equal rows gather in a task, and sparse ids cost no more than dense ones.

Null and empty texts have no words.  Null ids come last (below all others);
repeated ids are ordered by the first ``PREFIX`` characters of their text,
then by its hash, so equal rows are neighbours.  A single document is its own next one.  Words are lower-cased by
Unicode's rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SEPARATORS, placed, small

MIN_SHARE, MAX_SHARE = 1 / 500, 1 / 10
RATES = (1, 4, 5, 6, 7, 8)  # a subset keeps 2**-rate of the lexicon
PER_RATE = 5
BLOCK = 256
PREFIX = 32
EMPTY = "0" * 8


def pieces(text: Column) -> Column:
    """Lower-cased words of a text, with an empty one where it begins or ends
    with a separator."""
    return F.split(F.lower(text), SEPARATORS)


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """(term): hashes of the words with a frequency in the band, among the
    distinct texts.  Only texts that occur more than once are shuffled, to
    keep one of each."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    hashes = materialize(texts.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    total = hashes.count()
    repeated = small(hashes.filter("n > 1").select("h"))
    once = texts.join(repeated, "h", "left_anti").select("text")
    texts = once.unionByName(texts.join(repeated, "h", "left_semi").select("text").distinct())
    each = texts.select(F.explode(F.array_distinct(pieces(F.col("text")))).alias("word"))
    counts = each.filter("word != ''").groupBy(F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("df"))
    return counts.filter((F.col("df") >= total * min_share) & (F.col("df") <= max(1.0, total * max_share))).select("term")


def membership(term: Column) -> Column:
    """One bit per randomised subset of the lexicon that a term hash is in."""
    subsets = [(rate, 100 * rate + i) for rate in RATES for i in range(PER_RATE)]
    bits = [F.when(F.xxhash64(term, F.lit(seed)).bitwiseAND((1 << rate) - 1) == 0, F.lit(1 << j)).otherwise(F.lit(0)).cast("long") for j, (rate, seed) in enumerate(subsets)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprint(marked: Column) -> Column:
    """Subset hashes of sorted distinct (term, mask), 8 hex digits each; the
    bits of a mask say which subsets the term is in."""
    terms = F.transform(marked, lambda t: t["term"])
    of = lambda j: F.transform(F.filter(marked, lambda t: t["mask"].bitwiseAND(F.lit(1 << j).cast("long")) != 0), lambda t: t["term"])
    one = lambda kept: F.when(F.size(kept) == 0, F.lit(EMPTY)).otherwise(
        F.lpad(F.lower(F.hex(F.xxhash64(kept).bitwiseAND(0xFFFFFFFF))), 8, "0"))
    parts = [one(of(j)) for j in range(len(RATES) * PER_RATE)]
    none = EMPTY * (len(parts) - 1)
    # A few words may be in no subset: then all of them, in the first place.
    return F.get(F.transform(F.array(F.concat(*parts)), lambda x: F.when(
        x == EMPTY + none, F.concat(one(terms), F.lit(none))).otherwise(x)), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes among those that are not both empty."""
    n = len(RATES) * PER_RATE
    pairs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        F.substr(a, i * 8 + 1, F.lit(8)).alias("a"), F.substr(b, i * 8 + 1, F.lit(8)).alias("b")))
    used = F.size(F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY)))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != EMPTY) & (p["a"] == p["b"])))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def with_next(docs: DataFrame) -> DataFrame:
    """(block, place, doc_id, text, next, last): every document with the text
    of the next one in descending id, the last one with that of the first.
    ``last`` marks a block's last row, whose next one is in another block."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Short sort keys: a range sort samples them to the driver.
    rows = rows.withColumns({"start": F.substring("text", 1, PREFIX), "h": F.xxhash64("text")})
    rows = placed(rows, "place", F.col("doc_id").desc_nulls_last(), F.desc("start"), F.desc("h")).drop("start", "h")
    rows = rows.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    blocks = (rows.agg(F.max("block")).first()[0] or 0) + 1
    heads = rows.filter(F.col("place") % BLOCK == 0)
    heads = heads.select(F.pmod(F.col("block") - 1, F.lit(blocks)).alias("block"), F.col("text").alias("head"))
    down = Window.partitionBy("block").orderBy("place")
    rows = rows.withColumn("inside", F.lead("text").over(down))
    return rows.join(heads, "block").select(
        "block", "place", "doc_id", "text", F.coalesce("inside", "head").alias("next"), F.col("inside").isNull().alias("last"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text
    (second half replaced by the beginning of the next document), and the
    likeness of its fingerprint to that one's and to the next document's."""
    rows = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next", F.lit(1), half)))
    # The empty word marks every text, so none is lost without lexicon words,
    # and carries what is to be returned and the text itself.
    texts = F.array(F.struct(F.lit(0).alias("part"), F.col("text").alias("t")),
                    F.struct(F.lit(1).alias("part"), F.col("edited").alias("t")),
                    F.struct(F.lit(2).alias("part"), F.when(F.col("last"), F.col("next")).alias("t")))
    info = F.struct("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    each = rows.select("block", "place", info.alias("info"), texts.alias("texts")).select("block", "place", "info", F.explode("texts").alias("t"))
    each = each.filter("t.t IS NOT NULL").select("block", "place", "t.part", "info", F.col("t.t").alias("text"))
    each = each.select("*", F.explode(F.concat(F.array(F.lit("")), pieces(F.col("text")))).alias("word"))
    each = each.select("block", "place", "part", F.xxhash64("word").alias("term"),
                       F.when(F.col("word") == "", F.struct("info", "text")).alias("held"))
    empty = F.xxhash64(F.lit(""))
    marker = docs.sparkSession.range(1).select(empty.alias("term"))
    # A lexicon word's subsets are hashed once, where the lexicon is made.
    known = materialize(lexicon(docs).union(marker).withColumn("mask", membership(F.col("term"))))
    kept = each.join(small(known), "term")
    # Rows are dealt by block already, so with a broadcast lexicon this
    # aggregate shuffles nothing.
    prints = kept.groupBy("block", "place", "part").agg(F.first("held", ignorenulls=True).alias("held"), F.collect_set(F.struct("term", "mask")).alias("terms"))
    # Only a text without lexicon words is split again, for its own words.
    own = F.transform(F.array_distinct(F.transform(pieces(F.col("held.text")), lambda w: F.xxhash64(w))),
                      lambda w: F.struct(w.alias("term"), membership(w).alias("mask")))
    terms = F.array_sort(F.filter(F.when(F.size("terms") > 1, F.col("terms")).otherwise(own), lambda t: t["term"] != empty))
    prints = prints.select("block", "place", "part", "held.info", terms.alias("terms"))
    prints = prints.withColumn("print", fingerprint(F.col("terms")))
    pick = lambda part: F.max(F.when(F.col("part") == part, F.col("print")))
    one = prints.groupBy("block", "place").agg(F.max(F.when(F.col("part") == 0, F.col("info"))).alias("info"),
                                               pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"), pick(2).alias("head"))
    down = Window.partitionBy("block").orderBy("place")
    one = one.withColumn("next", F.coalesce(F.lead("fingerprint").over(down), "head"))
    return one.select("info.doc_id", "info.n_chars", "info.edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))
