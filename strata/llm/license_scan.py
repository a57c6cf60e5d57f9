"""License scans: fuzzy search for short notices.

A notice of n characters may differ by ``k = n // EDIT_EVERY`` edits (at
least one).  Cut into k + 1 pieces, one piece must occur exactly
(pigeonhole), so exact byte searches for the pieces locate every candidate;
the regex library's bounded-error matching then verifies it and gives the
span and the number of edits.  Searches run on the words of a text joined by
single spaces, so line breaks, comment marks and case do not matter.

Null, empty and wordless texts have no words, spans or labels and score 0.
Repeated rows are scanned one by one.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, word_spans

# Exact phrases that give a label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Short notices searched with edits, and their labels.
NOTICES = (
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons attribution", "cc-by"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)
EDIT_EVERY = 12

SPANS = "array<struct<label:string,base:boolean,first_word:bigint,n_words:bigint,edits:bigint,size:bigint>>"


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """The notice cut into k + 1 parts of nearly equal length, with offsets."""
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def places(data: bytes, what: bytes) -> list[int]:
    """All starts of ``what``, overlapping ones too."""
    found, at = [], data.find(what)
    while at >= 0:
        found.append(at)
        at = data.find(what, at + 1)
    return found


def scan_batch(raw: np.ndarray, off: np.ndarray, base, notices, patterns) -> tuple[np.ndarray, list[list[dict]]]:
    """Word counts and spans of each document of a slice."""
    low, starts, ends, first = word_spans(raw, off)
    n_words = np.diff(first)
    spans: list[list[dict]] = [[] for _ in n_words]
    if not len(starts):
        return n_words, spans
    # Words with one byte between them: a space, or a line feed after a
    # document's last word.
    lengths = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    out = np.full(at[-1], 32, np.uint8)
    inside = np.zeros(len(low) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    hole = np.zeros(at[-1], bool)
    hole[at[1:] - 1] = True
    out[~hole] = low[keep]
    closes = first[1:][n_words > 0] - 1
    out[at[closes + 1] - 1] = 10
    data = b"\n" + out.tobytes()
    begin = at[:-1] + 1
    doc_of = lambda word: int(np.searchsorted(first, word, "right")) - 1

    def note(label: str, is_base: bool, a: int, b: int, edits: int, size: int) -> None:
        w = int(np.searchsorted(begin, a, "right")) - 1
        d = doc_of(w)
        n = int(np.searchsorted(begin, b - 1, "right")) - w
        spans[d].append({"label": label, "base": is_base, "first_word": w - int(first[d]), "n_words": n, "edits": edits, "size": size})

    for phrase, label in base:
        what = phrase.encode()
        for a in places(data, what):
            if data[a - 1] in b" \n" and data[a + len(what)] in b" \n":
                note(label, True, a, a + len(what), 0, len(what))
    for (notice, label), (k, pattern) in zip(notices, patterns, strict=True):
        seen: set[tuple[int, int]] = set()
        for skip, piece in pieces(notice, k):
            for a in places(data, piece.encode()):
                lo, hi = max(0, a - skip - k - 1), min(len(data), a - skip + len(notice) + k + 1)
                lo = data.rfind(b"\n", lo, a) + 1 or lo
                stop = data.find(b"\n", a, hi)
                hi = hi if stop < 0 else stop
                edge_l, edge_r = lo == 0 or data[lo - 1] in b" \n", hi == len(data) or data[hi] in b" \n"
                text = data[lo:hi].decode("latin-1")
                for m in pattern.finditer((" " if edge_l else "\x00") + text + (" " if edge_r else "\x00")):
                    s, e = lo + m.start() - 1, lo + m.end() - 1
                    if (s, e) not in seen:
                        seen.add((s, e))
                        note(label, False, s, e, sum(m.fuzzy_counts), len(notice))
    return n_words, spans


def scan(docs: DataFrame, base=BASE, notices=NOTICES, edit_every: int = EDIT_EVERY) -> DataFrame:
    """(doc_id, n_words, spans): all exact base places and all fuzzy notice
    matches of every document.  No shuffle."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, spans {SPANS}"
    id_type = pa.int64() if docs.schema["doc_id"].dataType.simpleString() == "bigint" else None
    span_type = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()),
                                    ("n_words", pa.int64()), ("edits", pa.int64()), ("size", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        patterns = []
        for notice, _ in notices:
            k = max(1, len(notice) // edit_every)
            patterns.append((k, regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice, special_only=True)}){{e<={k}}}(?= )")))
        for batch in batches:
            for rows, raw, off in slices(batch):
                n_words, spans = scan_batch(raw, off, base, notices, patterns)
                ids = rows.column(0)
                yield pa.record_batch([ids if id_type is None else ids.cast(id_type), pa.array(n_words, pa.int64()),
                                       pa.array(spans, span_type)], ["doc_id", "n_words", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base places and labels, the labels of both, and a
    score (1 for an exact base phrase or notice, else the share of a notice's
    characters that needed no edit, the best match of any notice counting)."""
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))))
    starts = F.transform(base, lambda s: s["first_word"])
    quality = F.transform("spans", lambda s: F.when(s["base"], F.lit(1.0)).otherwise(1 - s["edits"] / s["size"]))
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(quality), F.lit(0.0)).alias("score"),
        F.concat_ws(";", F.transform("spans", lambda s: F.concat_ws(
            ":", s["label"], s["first_word"].cast("string"), s["n_words"].cast("string"), s["edits"].cast("string")))).alias("found"))
