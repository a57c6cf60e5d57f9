"""Suffix-array dedup: removes every byte of a repeated string of ``LENGTH``
bytes but its first occurrence.

Order of positions: document (smaller id; equal ids by text hash; null ids
last), then place in the text.  A byte goes if some LENGTH bytes around it also
start earlier.

The suffixes of all documents are dealt to tasks by an anchor: the smallest
hash of ``K`` bytes among the LENGTH bytes a suffix begins with.  Equal strings
have equal anchors, and neighbouring suffixes mostly share one, so a run of
suffixes with one anchor travels as one entry (about one per 39 bytes) without
its text.

1. K-grams that anchor many different runs (``HEAVY`` of the documents: a
   common line in changing surroundings) are found first, together with the
   equally common k-grams beside them; they come last in the order, so
   suffixes that have anything else to go by are not gathered under them.  At
   most a fixed number of k-grams can be that common, whatever the corpus size.
2. Entries meet by anchor, after the entries of a task's chunk of documents
   have been reduced to the first of every run's text.  Later copies of the
   same run are repeats as a whole.  Anchors with several different texts stay
   open.
3. The texts of open entries are fetched, and the suffixes of the entries under
   one anchor are put in suffix order.  In it, previous and next smaller
   positions give each suffix its longest previous factor, here up to LENGTH;
   those that reach LENGTH are repeats.
4. Every document cuts out the union of its repeats.

Results are exact (a 64-bit anchor and a 64-bit text hash must both collide to
change one).  Tasks work on buckets of about ``BUCKET`` bytes of text.

Null and empty texts have no bytes and keep none.  Rows with equal id and
equal text are one document: neither removes the other's bytes.  Rows with
equal id and different text are ordered by a hash of their text.  An empty
table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import mix, slices

LENGTH = 100
K = 24
BUCKET = 8 << 20
CHUNK = 1_500_000  # entries of a chunk of documents within a task
HEAVY = 1 / 1000
HEAVY_LEAST = 64
LAST_ID = (1 << 63) - 1

ENTRY = "bucket int, dbucket int, a binary, c binary, k binary, h binary, p binary, n binary"
ENTRY_NAMES = ["bucket", "dbucket", "a", "c", "k", "h", "p", "n"]
TYPES = {"a": np.uint64, "c": np.uint64, "k": np.int64, "h": np.int64, "p": np.int32, "n": np.uint8, "d": np.int32}


class Grams:
    """Hashes of all spans of 8, 16, 24, 32 bytes of a slice, by doubling."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, raw: np.ndarray) -> None:
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        h, width, by = values[raw], 1, {}
        while width < 32:
            h = self.join(h[:-width], h[width:]) if len(h) > width else h[:0]
            width *= 2
            by[width] = h
        n = max(0, len(by[16]) - 8)
        self.k = self.join(by[16][:n], by[8][16:16 + n])
        self.h32 = by[32]

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * self.FACTOR + b
        x ^= x >> np.uint64(32)
        return x * np.uint64(0xBF58476D1CE4E5B9)

    def text(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hash of spans of 32 to 192 bytes."""
        out = size.astype(np.uint64)
        for at in range(0, 192, 32):
            out = self.join(out, self.h32[start + np.minimum(at, size - 32)])
        return mix(out)


class Heavy:
    """Membership in a set of k-gram hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.first = np.zeros(1 << 20, bool)
        self.first[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        if len(self.hashes):
            at = np.flatnonzero(self.first[(x >> np.uint64(44)).astype(np.int64)])
            i = np.minimum(np.searchsorted(self.hashes, x[at]), len(self.hashes) - 1)
            out[at] = self.hashes[i] == x[at]
        return out


def entries(raw: np.ndarray, off: np.ndarray, heavy: Heavy) -> dict[str, np.ndarray]:
    """The runs of suffixes of a slice: anchor hash ``a``, text hash ``c``,
    document ``d``, first suffix ``p`` and number of further ones ``n``; also
    the k-gram hashes and the anchors' places."""
    size = np.diff(off)
    total = int(np.maximum(size - LENGTH + 1, 0).sum())
    if not total:
        return {x: np.zeros(0, t) for x, t in TYPES.items() if x in "acdpn"} | {"grams": np.zeros(0, np.uint64), "at": np.zeros(0, np.int64)}
    grams = Grams(raw)
    # The order: heavy last, then by hash, then leftmost, in one number.
    low = np.uint64(31)
    key = (grams.k >> np.uint64(1)) | (heavy(grams.k).astype(np.uint64) << np.uint64(63))
    key = (key >> low << low) | np.arange(len(key), dtype=np.uint64)
    width, window = 1, LENGTH - K + 1
    while width * 2 <= window:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if window > width:
        key = np.minimum(key[:-(window - width)], key[window - width:])
    anchor = (key & np.uint64((1 << 31) - 1)).astype(np.int64)
    # Suffixes of at least LENGTH bytes within their document.
    long = np.flatnonzero(size >= LENGTH)
    count = size[long] - LENGTH + 1
    doc = np.repeat(long, count)
    start = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + off[doc]
    anchor = anchor[start]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, total)) - 1
    return {"a": grams.k[anchor[first]], "c": grams.text(start[first], n + LENGTH), "d": doc[first].astype(np.int32),
            "p": (start[first] - off[doc[first]]).astype(np.int32), "n": n.astype(np.uint8),
            "grams": grams.k, "at": anchor[first]}


def chunks(batches: Iterator[pa.RecordBatch], heavy: Heavy, around: bool = False) -> Iterator[dict[str, np.ndarray]]:
    """Entries of chunks of documents, with keys k, h and dbucket per document
    (``d`` counts documents of the chunk); the last chunk may be empty.  With
    ``around``, ``near`` has the k-grams of each entry's surroundings whose
    anchor is common within its slice."""
    held: list[dict] = []
    docs, size = 0, 0
    for batch in batches:
        for rows, raw, off in slices(batch):
            e = entries(raw, off, heavy)
            grams, at = e.pop("grams"), e.pop("at")
            if around:
                e["near"] = common_around(e["a"], e["c"], grams, at)
            e["d"] = e["d"] + np.int32(docs)
            e |= {x: np.asarray(rows[x]) for x in ("k", "h", "dbucket")}
            docs, size = docs + len(rows), size + len(e["a"])
            held.append(e)
            if size >= CHUNK:
                yield {x: np.concatenate([e[x] for e in held]) for x in held[0]}
                held, docs, size = [], 0, 0
    if held:
        yield {x: np.concatenate([e[x] for e in held]) for x in held[0]}


def common_around(a: np.ndarray, c: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """K-grams beside anchors that stand under several texts of a slice, if
    they themselves are beside several."""
    order = np.lexsort((c, a))
    a, c, at = a[order], c[order], at[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    a, at = a[new], at[new]
    _, inverse, times = np.unique(a, return_inverse=True, return_counts=True)
    at = at[times[inverse] > 4]
    if not len(at):
        return np.zeros(0, np.uint64)
    place = (at[:, None] + np.arange(-(LENGTH - K), LENGTH - K + 1)[None]).ravel()
    near = grams[np.unique(place[(place >= 0) & (place < len(grams))])]
    value, times = np.unique(near, return_counts=True)
    return np.repeat(value[times > 4], times[times > 4])


def heavy_grams(docs: DataFrame, share: float = HEAVY, least: int = HEAVY_LEAST) -> np.ndarray:
    """Hashes of the k-grams that stand beside many different runs.  A chunk
    reports those found in at least half the share of its documents, so none
    that has the whole share overall is missed."""
    total = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for e in chunks(batches, Heavy(np.zeros(0, np.uint64)), around=True):
            value, times = np.unique(e["near"], return_counts=True)
            keep = times >= max(8, share / 2 * len(e["k"]))
            yield pa.record_batch([pa.array(value[keep].view(np.int64)), pa.array(times[keep], pa.int64())], ["gram", "times"])

    found = docs.mapInArrow(run, "gram bigint, times bigint").groupBy("gram").agg(F.sum("times").alias("times"))
    # At most (bytes of a mean document) / (share / 2) k-grams can be left.
    rows = found.filter(F.col("times") >= max(least, share / 2 * total)).select("gram").toArrow()
    return np.asarray(rows["gram"].combine_chunks()).astype(np.int64).view(np.uint64)


def blobs(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, list[list[bytes]]]:
    """Columns as byte strings, one row per bucket."""
    order = np.argsort(bucket, kind="stable")
    value, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first, len(bucket))
    out = []
    for x in columns.values():
        x = x[order]
        out.append([x[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)])
    return value, out


def unblob(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def later(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Entries sorted by anchor, text and position; which are the first of
    their text, and which stand later than that first one."""
    order = np.lexsort((e["p"], e["h"], e["k"], e["c"], e["a"]))
    e = {x: v[order] for x, v in e.items()}
    first = np.ones(len(order), bool)
    first[1:] = (e["a"][1:] != e["a"][:-1]) | (e["c"][1:] != e["c"][:-1])
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.zeros(0, np.int64)
    after = np.zeros(len(order), bool)
    for x in ("k", "h", "p"):
        after |= e[x] != e[x][head]
    return e, first, after


def entry_blobs(docs: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """Rows by anchor bucket, columns of entries as byte strings.  Of the
    equal runs of a chunk only the first keeps its anchor, with the entries'
    document buckets in ``at`` and -1 in ``dbucket``; the later ones are
    repeats already (empty ``a``), one row per document bucket, dealt evenly."""
    names = ENTRY_NAMES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for e in chunks(batches, Heavy(heavy)):
            d = e.pop("d")
            e |= {x: e[x][d] for x in ("k", "h", "dbucket")}
            e, first, after = later(e)
            bucket = (mix(e["a"]) % np.uint64(buckets)).astype(np.int32)
            value, out = blobs(bucket[first], {x: e[x][first] for x in names[2:]} | {"dbucket": e["dbucket"][first].astype(np.int32)})
            yield pa.record_batch([pa.array(value, pa.int32()), pa.array(np.full(len(value), -1), pa.int32()),
                                   *(pa.array(x, pa.binary()) for x in out[:-1]), pa.array(out[-1], pa.binary())], [*names, "at"])
            value, out = blobs(e["dbucket"][after].astype(np.int32), {x: e[x][after] for x in names[4:]})
            spread = (np.arange(len(value)) + turn) % buckets
            turn += len(value)
            none = pa.array([b""] * len(value), pa.binary())
            yield pa.record_batch([pa.array(spread, pa.int32()), pa.array(value, pa.int32()), none, none,
                                   *(pa.array(x, pa.binary()) for x in out), none], [*names, "at"])

    return docs.mapInArrow(run, f"{ENTRY}, at binary")


def meet(frame: DataFrame) -> DataFrame:
    """By document bucket: repeats (empty ``a``) and open entries."""

    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        done = table.filter(pc.greater_equal(table["dbucket"], 0))
        new = table.filter(pc.less(table["dbucket"], 0))
        e = {x: unblob(new[x], TYPES[x]) for x in ENTRY_NAMES[2:]} | {"dbucket": unblob(new["at"], np.int32)}
        e, first, after = later(e)
        out = [done.select(["dbucket", "a", "k", "h", "p", "n"]).cast(SPANS_ARROW)]
        out.append(span_table(e["dbucket"][after], {x: e[x][after] for x in "khpn"}))
        # Anchors with several different texts.
        a = e["a"][first]
        if len(a):
            same = np.concatenate([[False], a[1:] == a[:-1]])
            shared = same | np.concatenate([same[1:], [False]])
            out.append(span_table(e["dbucket"][first][shared], {x: e[x][first][shared] for x in "akhpn"}))
        return pa.concat_tables(out)

    return frame.groupBy("bucket").applyInArrow(run, SPANS)


SPANS = "dbucket int, a binary, k binary, h binary, p binary, n binary"
SPANS_ARROW = pa.schema([("dbucket", pa.int32()), *((x, pa.binary()) for x in "akhpn")])


def span_table(dbucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    value, out = blobs(dbucket, columns)
    found = dict(zip(columns, out, strict=True))
    return pa.table([pa.array(value, pa.int32()), *(pa.array(found.get(x, [b""] * len(value)), pa.binary()) for x in "akhpn")], schema=SPANS_ARROW)


def rows_of(k: np.ndarray, h: np.ndarray, doc_k: np.ndarray, doc_h: np.ndarray) -> np.ndarray:
    """Row of the first document with each key."""
    both = np.unique(np.stack([np.concatenate([doc_k, k]), np.concatenate([doc_h, h])]), axis=1, return_inverse=True)[1].ravel()
    n = len(doc_k)
    where = np.full(both.max() + 1 if len(both) else 0, -1)
    where[both[:n][::-1]] = np.arange(n)[::-1]
    return where[both[n:]]


def texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column ``text``."""
    col = table["text"].combine_chunks().cast(pa.large_string()).fill_null("")
    col = pa.concat_arrays([col]) if not isinstance(col, pa.ChunkedArray) else pa.concat_arrays(col.chunks)
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset:] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def open_texts(keyed: DataFrame, spans: DataFrame, buckets: int) -> DataFrame:
    """Texts of open entries by anchor bucket: (bucket, dbucket, k, h, p, n,
    text), all but the numbers as byte strings."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        raw, off = texts_of(docs)
        e = {x: unblob(found[x], TYPES[x]) for x in "akhpn"}
        row = rows_of(e["k"], e["h"], np.asarray(docs["k"]), np.asarray(docs["h"]))
        start, size = off[row] + e["p"], e["n"].astype(np.int64) + LENGTH
        order = np.argsort(mix(e["a"]) % np.uint64(buckets), kind="stable")
        bucket = (mix(e["a"]) % np.uint64(buckets)).astype(np.int32)[order]
        value, first = np.unique(bucket, return_index=True)
        ends = np.append(first, len(order))
        data = raw.tobytes()
        text = [b"".join(data[s:s + z] for s, z in zip(start[order[i:j]].tolist(), size[order[i:j]].tolist(), strict=True))
                for i, j in zip(ends, ends[1:], strict=False)]
        cols = [[e[x][order[i:j]].tobytes() for i, j in zip(ends, ends[1:], strict=False)] for x in "khpn"]
        dbucket = docs["dbucket"][0].as_py() if len(docs) else 0
        return pa.table([pa.array(value, pa.int32()), pa.array(np.full(len(value), dbucket), pa.int32()),
                         *(pa.array(x, pa.binary()) for x in cols), pa.array(text, pa.binary())],
                        names=["bucket", "dbucket", "k", "h", "p", "n", "text"])

    return keyed.groupBy("dbucket").cogroup(spans.groupBy("dbucket")).applyInArrow(
        run, "bucket int, dbucket int, k binary, h binary, p binary, n binary, text binary")


def longest_previous_factor(words: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows of ``words`` (first LENGTH bytes as big-endian
    numbers) and, in it, whether the longest previous factor reaches LENGTH:
    within a stretch of equal rows the previous or next smaller position, by
    running minima from either side, is an earlier match."""
    order = np.lexsort(words.T[::-1])
    w, pos = words[order], position[order]
    n = len(order)
    cut = np.ones(n, bool)  # the common prefix with the row above is shorter
    cut[1:] = (w[1:] != w[:-1]).any(1)
    stretch = np.cumsum(cut) - 1
    # Running minima restart at every stretch: later stretches rank lower.
    top = n + 1
    down = np.minimum.accumulate(pos + (stretch.max(initial=0) - stretch) * top)
    before = np.concatenate([[True], (stretch[1:] != stretch[:-1])])
    smaller_before = ~before & (np.concatenate([[0], down[:-1]]) < pos + (stretch.max(initial=0) - stretch) * top)
    up = np.minimum.accumulate((pos + stretch * top)[::-1])[::-1]
    after = np.concatenate([(stretch[1:] != stretch[:-1]), [True]])
    smaller_after = ~after & (np.concatenate([up[1:], [0]]) < pos + stretch * top)
    return order, smaller_before | smaller_after


def repeats(frame: DataFrame) -> DataFrame:
    """Repeats among the open entries of an anchor bucket, by suffix order."""

    def run(table: pa.Table) -> pa.Table:
        e = {x: unblob(table[x], TYPES[x]) for x in "khpn"}
        sizes = [len(x) // 8 for x in table["k"].to_pylist()]
        dbucket = np.repeat(np.asarray(table["dbucket"]), sizes)
        raw = unblob(table["text"], np.uint8)
        if not len(e["k"]):
            return span_table(dbucket, {x: e[x] for x in "khpn"})
        n = e["n"].astype(np.int64) + 1
        begin = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        owner = np.repeat(np.arange(len(n)), n)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        start = begin[owner] + shift
        # Suffixes whose first LENGTH bytes occur once by their hash are done.
        h = Grams(raw)
        value = h.text(start, np.full(len(start), LENGTH))
        _, inverse, times = np.unique(value, return_inverse=True, return_counts=True)
        keep = times[inverse] > 1
        owner, shift, start = owner[keep], shift[keep], start[keep]
        if not len(owner):
            return span_table(dbucket[:0], {x: e[x][:0] for x in "khpn"})
        wide = -(-LENGTH // 8) * 8
        padded = np.concatenate([raw, np.zeros(wide, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, wide)[start].copy()
        view[:, LENGTH:] = 0
        words = view.view(">u8").astype(np.uint64)
        place = e["p"][owner].astype(np.int64) + shift
        rank = np.empty(len(owner), np.int64)
        by = np.lexsort((place, e["h"][owner], e["k"][owner]))
        new = np.ones(len(by), bool)
        for i, x in enumerate((place, e["h"][owner], e["k"][owner])):
            new[1:] = (x[by][1:] != x[by][:-1]) | (new[1:] if i else False)
        rank[by] = np.cumsum(new)
        order, again = longest_previous_factor(words, rank)
        hit = np.sort(order[again])
        # Neighbouring suffixes of an entry make one repeat.
        first = np.ones(len(hit), bool)
        first[1:] = (owner[hit][1:] != owner[hit][:-1]) | (shift[hit][1:] != shift[hit][:-1] + 1)
        head = hit[first]
        more = np.diff(np.append(np.flatnonzero(first), len(hit))) - 1
        o = owner[head]
        return span_table(dbucket[o], {"k": e["k"][o], "h": e["h"][o], "p": place[head].astype(np.int32), "n": more.astype(np.uint8)})

    return frame.groupBy("bucket").applyInArrow(run, SPANS)


def cut_out(keyed: DataFrame, spans: DataFrame, id_type: str) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        raw, off = texts_of(docs)
        k, h = np.asarray(docs["k"]), np.asarray(docs["h"])
        e = {x: unblob(found[x], TYPES[x]) for x in "khpn"}
        row = rows_of(e["k"], e["h"], k, h) if len(k) else np.zeros(0, np.int64)
        gone = np.zeros(len(raw) + 1, np.int32)
        np.add.at(gone, off[row] + e["p"], 1)
        np.add.at(gone, off[row] + e["p"] + e["n"].astype(np.int64) + LENGTH, -1)
        gone = np.cumsum(gone[:-1]) > 0
        data = raw.tobytes()
        same = rows_of(k, h, k, h) if len(k) else row  # equal rows share a result
        results: dict[int, tuple[list, bytes]] = {}
        spans_out, kept = [], []
        for d in same.tolist():
            if d not in results:
                a, b = int(off[d]), int(off[d + 1])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
                cuts = edge.reshape(-1, 2).tolist()
                parts, at = [], a
                for s, z in cuts:
                    parts.append(data[at:a + s])
                    at = a + z
                results[d] = [{"start": s, "end": z} for s, z in cuts], b"".join([*parts, data[at:b]])
            spans_out.append(results[d][0])
            kept.append(results[d][1])
        pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table([docs["doc_id"], pa.array(np.diff(off), pa.int64()), pa.array(spans_out, pairs), pa.array(kept, pa.binary())],
                        names=["doc_id", "n_bytes", "spans", "kept"])

    return keyed.groupBy("dbucket").cogroup(spans.groupBy("dbucket")).applyInArrow(
        run, f"doc_id {id_type}, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")


def dedup(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed byte spans (maximal runs)
    and the remaining bytes of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket))
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("k"), F.xxhash64("text").alias("h"), "text")
    keyed = keyed.withColumn("dbucket", F.pmod(F.xxhash64("k", "h"), F.lit(buckets)).cast("int"))
    texts = keyed.select("k", "h", "dbucket", "text")
    heavy = heavy_grams(texts)
    spans = materialize(meet(entry_blobs(texts, heavy, buckets)))
    still = spans.filter(F.length("a") > 0)
    found = repeats(open_texts(keyed, still, buckets))
    return cut_out(keyed, spans.filter(F.length("a") == 0).unionByName(found), id_type)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs, and a digest
    of the bytes that stay."""
    rows = dedup(docs.select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + (s["end"] - s["start"]))
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))
