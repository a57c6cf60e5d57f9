"""Conversation prefix trie, its subtree totals by parallel tree contraction.

Conversations are rebuilt (the first few turns come from a shared base
conversation), and every distinct sequence of first turns is a trie node:

1. Turns are numbered by one range sort (``placed``), so a conversation with a
   large share of all rows is numbered over many tasks.
2. A node is named by its depth and two sums of hashes of (position, turn);
   the sums run along a conversation in segments of ``SEGMENT`` turns whose
   totals are added up, and a parent's name is the child's less its last turn.
   Members, smallest member and words come from one aggregate.
3. Subtree totals: rounds of joins on the shrinking tree.  Rake: leaves give
   their total to their parent and go.  Compress: in unary chains, nodes whose
   hash of the round is less than their parent's and child's go (a third of a
   chain, never two neighbours); what a node holds moves to its child's edge.
   Rounds grow with the log of the tree's size, whatever its depth.
4. Re-expansion: a compressed node's total is its child's total plus what
   moved; these links are shortened by doubling until they end at raked nodes.
5. Digests of the conversations that end at a node: ids are dealt by range
   over (node, id) and joined to strings of bounded length, which one more
   pass per node feeds to SHA-256 in order, holding one batch at a time.

Null roles and texts are empty; a null turn comes first; turns that agree in
number are ordered by the SHA-256 of role and text, repeated rows stay.  Rows
with a null conv_id belong to no conversation.  A conversation whose rebuilt
form has no turns is a member of the root.  Very long texts and conversations
are cut nowhere.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SQL_CRC_TABLE, count_words, placed, small, sql_crc

SHARED = 20
HEADS = 4
SEGMENT = 4096
CHUNK_IDS = 10_000
ROUNDS = 400


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, words) of every turn, positions from 1, and
    (conv_id, n, h, base, m): each conversation's number of turns, the number
    of its first turns that are replaced, and whose first ``m`` come instead."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", F.unhex(digest).alias("digest"), count_words(text).alias("words"))
    turns = placed(turns, "place", F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"))
    convs = turns.groupBy("conv_id").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS)
    convs = materialize(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0)))).drop("n_base")
    convs = materialize(convs)
    turns = turns.join(convs.select("conv_id", "start"), "conv_id")
    return turns.select("conv_id", (F.col("place") - F.col("start") + 1).alias("pos"), "digest", "words"), convs.drop("start")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, words) of the rebuilt turns, and (conv_id,
    length) of every conversation."""
    turns, convs = numbered(conversations)
    turns = materialize(turns)
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("pos > h")
    own = own.select("conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "digest", "words")
    heads = turns.filter(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base")
    taken = heads.join(convs.select("conv_id", "base", "m"), "base").filter("pos <= m")
    taken = taken.select("conv_id", F.col("pos").alias("depth"), "digest", "words")
    lengths = convs.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return own.union(taken), lengths


def name(depth: Column, s1: Column, s2: Column) -> Column:
    """128-bit name of a node."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(",", depth.cast("string"), s1.cast("string"), s2.cast("string")).cast("binary"), 256), 1, 32))


def prefixes(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, depth, words, node, parent): every rebuilt turn with the node
    it ends at and that node's parent."""
    wide = "decimal(38,0)"
    v = [F.xxhash64(F.lit(seed), F.col("depth"), F.col("digest")).cast(wide) for seed in (1, 2)]
    turns = turns.select("conv_id", "depth", "words", v[0].alias("v1"), v[1].alias("v2"), F.floor((F.col("depth") - 1) / segment).alias("seg"))
    run = Window.partitionBy("conv_id", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    turns = materialize(turns.select("*", F.sum("v1").over(run).cast(wide).alias("s1"), F.sum("v2").over(run).cast(wide).alias("s2")))
    # Only conversations longer than a segment have anything to add.
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    ends = turns.groupBy("conv_id", "seg").agg(F.sum("v1").cast(wide).alias("a1"), F.sum("v2").cast(wide).alias("a2"))
    longer = turns.filter("seg > 0").select("conv_id").distinct()
    ends = ends.join(longer, "conv_id", "left_semi").select(
        "conv_id", "seg", *(F.coalesce(F.sum(a).over(before).cast(wide), F.lit(0).cast(wide)).alias(a) for a in ("a1", "a2")))
    turns = turns.join(small(materialize(ends)), ["conv_id", "seg"], "left")
    s1, s2 = ((F.col(s) + F.coalesce(F.col(a), F.lit(0).cast(wide))).cast(wide) for s, a in (("s1", "a1"), ("s2", "a2")))
    turns = turns.select("conv_id", "depth", "words", "v1", "v2", s1.alias("s1"), s2.alias("s2"))
    zero = F.lit(0).cast(wide)
    root = name(F.lit(0), zero, zero)
    parent = name(F.col("depth") - 1, (F.col("s1") - F.col("v1")).cast(wide), (F.col("s2") - F.col("v2")).cast(wide))
    return turns.select("conv_id", "depth", "words", name(F.col("depth"), F.col("s1"), F.col("s2")).alias("node"),
                        F.when(F.col("depth") == 1, root).otherwise(parent).alias("parent"))


def subtree_totals(tree: DataFrame, values: list[str], rounds: int = ROUNDS) -> DataFrame:
    """(node, *values): sums over subtrees of ``tree`` (node, parent, kids,
    *values; one root, whose parent is null; kids: number of children), by
    rake and compress."""
    acc, edge = values, [f"edge_{v}" for v in values]
    left = tree.select("node", "parent", "kids", *acc, *(F.lit(0).cast("long").alias(e) for e in edge))
    raked, links = [], []
    for r in range(rounds):
        raked.append(left.filter("kids = 0").select("node", *acc))
        # Per parent: what its leaves give it, and which children stay.
        leaf = F.col("kids") == 0
        given = left.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *(F.sum(F.when(leaf, F.col(a) + F.col(e)).otherwise(0)).alias(f"add_{a}") for a, e in zip(acc, edge, strict=True)),
            F.count_if(~leaf).alias("kids"), F.min(F.when(~leaf, F.col("node"))).alias("kid"))
        inner = left.filter("kids > 0").drop("kids").join(given, "node")
        inner = materialize(inner.select("node", "parent", "kids", "kid", *((F.col(a) + F.col(f"add_{a}")).alias(a) for a in acc), *edge))
        if inner.isEmpty():
            break
        rank = lambda c: F.xxhash64(F.lit(r), F.col(c))  # noqa: E731,B023
        unary = (F.col("kids") == 1) & F.col("parent").isNotNull()
        gone = F.coalesce(unary & (rank("node") < rank("kid")) & (rank("node") < rank("parent")), F.lit(False))
        moved = inner.filter(gone).select(F.col("kid").alias("node"), F.col("node").alias("above"), F.col("parent").alias("grand"),
                                          *(F.col(a).alias(f"from_{a}") for a in acc), *(F.col(e).alias(f"from_{e}") for e in edge))
        kept = materialize(inner.filter(~gone).drop("kid").join(moved, "node", "left"))
        # The removed node's total: its child's, what its child's edge held
        # before, and what the node itself had gathered.
        links.append(kept.filter("above IS NOT NULL").select(
            F.col("above").alias("node"), F.col("node").alias("to"), *((F.col(e) + F.col(f"from_{a}")).alias(a) for a, e in zip(acc, edge, strict=True))))
        left = kept.select("node", F.coalesce("grand", "parent").alias("parent"), "kids", *acc, *(
            (F.col(e) + F.coalesce(F.col(f"from_{a}") + F.col(f"from_{e}"), F.lit(0))).alias(e) for a, e in zip(acc, edge, strict=True)))
    else:
        raise RuntimeError("the tree is not contracted after the limit of rounds")
    done = raked[0]
    for x in raked[1:]:
        done = done.union(x)
    if not links:
        return done
    done, found = materialize(done), links[0]
    for x in links[1:]:
        found = found.union(x)
    found = materialize(found)
    # A link leads to a node that went in a later round: at most len(links)
    # steps, halved by every doubling.
    for _ in range(max(0, math.ceil(math.log2(len(links))))):
        onward = found.select(F.col("node").alias("to"), F.col("to").alias("next"), *(F.col(a).alias(f"next_{a}") for a in acc))
        found = materialize(found.join(onward, "to", "left").select(
            "node", F.coalesce("next", "to").alias("to"), *((F.col(a) + F.coalesce(F.col(f"next_{a}"), F.lit(0))).alias(a) for a in acc)))
    ends = done.select(F.col("node").alias("to"), *(F.col(a).alias(f"end_{a}") for a in acc))
    return done.union(found.join(ends, "to").select("node", *((F.col(a) + F.col(f"end_{a}")).alias(a) for a in acc)))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ascending, comma-joined conv_ids of
    ``ends`` (node, conv_id)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

        for batch in batches:
            for x, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (x != node or len(ids) == CHUNK_IDS):
                    yield out()
                    ids = []
                node = x
                ids.append(c)
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for x, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if state is None or x != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = x, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    ends = ends.select("node", F.col("conv_id").cast("long").alias("conv_id"))
    parts = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(join, "node binary, first bigint, ids string")
    return parts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt(conversations)
    lengths = materialize(lengths)
    steps = materialize(prefixes(turns))
    zero = F.lit(0).cast("decimal(38,0)")
    root = name(F.lit(0), zero, zero)
    nodes = steps.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").cast("long").alias("depth"), F.min("parent").alias("parent"),
                                      F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"))
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        root.alias("node"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = materialize(nodes.unionByName(top))
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    tree = nodes.select("node", "parent", F.col("n_children").alias("kids"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ends = steps.join(lengths, "conv_id").filter("depth = length").select("node", "conv_id")
    ends = ends.union(lengths.filter("length = 0").select(root.alias("node"), "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "node").join(end_digests(ends), "node", "left").join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


SQL = f"""
WITH {SQL_CRC_TABLE}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, n, h, conv_id - conv_id % {SHARED} AS base
  FROM (SELECT conv_id, count(*) AS n, ({sql_crc('conv_id::VARCHAR')}) % {HEADS} AS h FROM turns, crc_table GROUP BY conv_id, crc_list)
), placed AS (
  SELECT c.conv_id, c.base, c.n, c.h, least(c.h, coalesce(b.n, 0)) AS m FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
  SELECT conv_id, m + pos - h AS depth, role, text FROM turns JOIN placed USING (conv_id) WHERE pos > h
  UNION ALL SELECT p.conv_id, t.pos, t.role, t.text FROM turns t JOIN placed p ON t.conv_id = p.base WHERE t.pos <= p.m
), steps AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS node
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, [] FROM placed
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, depth, count(*) AS n_convs, min(words) AS words FROM steps GROUP BY node, depth
), kids AS (
  SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), tree AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * words AS saved FROM nodes LEFT JOIN kids USING (node)
), totals AS (
  SELECT s.node, sum((t.n_children = 0)::BIGINT) AS n_leaves, sum(t.saved) AS saved_tokens
  FROM tree t JOIN steps s ON s.conv_id = t.conv_id AND s.depth <= t.depth GROUP BY s.node
), ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM steps JOIN placed USING (conv_id) WHERE depth = m + greatest(n - h, 0) GROUP BY node
)
SELECT t.conv_id::BIGINT AS conv_id, t.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, t.n_convs::BIGINT AS n_convs,
  t.n_children::BIGINT AS n_children, totals.n_leaves::BIGINT AS n_leaves, totals.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM tree t JOIN totals USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes p ON t.depth > 0 AND p.node = list_slice(t.node, 1, t.depth - 1)
"""
