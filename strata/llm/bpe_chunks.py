"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last ``WINDOW`` bytes cuts every text into chunks whose
borders depend on nearby content only, so equal passages of different
documents fall into equal chunks.  A chunk's core lies between its first and
last position where a space or line feed follows a printable ASCII character:
the byte-level pre-tokenizer always breaks there, whatever stands around, so
a core has the same tokens in every context.  Cores are encoded once per task
and reused.  What lies between two cores is a join: it is encoded anew over
the whole stretch between the two nearest such positions, across as many
chunks as it takes, which is where both neighbours' tokens agree exactly.

Encoding uses the ranks of the vocabulary (tiktoken) for characters on which
all Unicode versions agree, and the tokenizers library for the rest.  The
special token's string is one token, as in the library.

Null and empty texts have no tokens and decode to the empty text.  Repeated
rows are encoded row by row (from the same cores).  The chunk store holds at
most ``STORE`` bytes a task and is emptied when full; pieces over ``LONGEST``
bytes are not kept.  It changes no result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, slices

WINDOW = 16
CHUNK_BITS = 9
STORE = 24 << 20  # bytes of pieces, ids and the objects that hold them
ENTRY = 300
LONGEST = 4096
BLANKS = 50_000
DECODE_TOKENS = 200_000  # tokens decoded at a time (a longer document alone)
SPECIAL = "<|endoftext|>"
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Bytes of U+0000 to U+024F in UTF-8.
PLAIN = bytes(range(0x80)) + bytes(range(0x80, 0xC0)) + bytes(range(0xC2, 0xCA))


def vocabulary_paths() -> tuple[str, str]:
    """Files of the public vocabulary: the library's and the ranks."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that begin at each position, by doubling."""
    with np.errstate(over="ignore"):
        h = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[raw]
        width = 1
        while width < WINDOW:
            h = h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:]
            h ^= h >> np.uint64(29)
            width *= 2
    return h


def borders(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of all pieces (cores and joins) of a slice, and its end."""
    n = len(raw)
    if n <= WINDOW:
        return np.unique(off)
    after = np.zeros(n, bool)
    after[1:] = (raw[:-1] > 0x20) & (raw[:-1] < 0x7F) & ((raw[1:] == 32) | (raw[1:] == 10))
    after[off[:-1][off[:-1] < n]] = False
    safe = np.flatnonzero(after)
    cut = np.flatnonzero((rolling(raw) >> np.uint64(64 - CHUNK_BITS)) == 0) + WINDOW
    cut = cut[cut < n]
    doc = np.searchsorted(off, cut, "right") - 1
    cut = cut[(cut - WINDOW >= off[doc]) & (raw[cut] & 0xC0 != 0x80)]
    ends = np.unique(np.concatenate([off, cut]))
    first, last = np.searchsorted(safe, ends[:-1]), np.searchsorted(safe, ends[1:]) - 1
    has = last >= first
    return np.unique(np.concatenate([off, safe[first[has]], safe[last[has]]]))


class Encoder:
    """Token ids of byte strings, with a bounded store of chunks."""

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        table = read_ranks(ranks)
        self.special = len(table)
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.vocabulary, self.library = vocabulary, None
        self.store: dict[bytes, np.ndarray] = {}
        self.held = 0

    def piece(self, piece: bytes) -> np.ndarray:
        ids = self.store.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(piece) <= LONGEST:  # long pieces hardly come again
                self.held += len(piece) + ids.nbytes + ENTRY
                if self.held > STORE:
                    self.store.clear()
                    self.held = 0
                self.store[piece] = ids
        return ids

    def encode(self, piece: bytes) -> np.ndarray:
        # Very long runs of blanks exhaust the stack of the other encoder.
        if not piece.translate(None, PLAIN) and (len(piece) < BLANKS or not re.search(rb"\s{%d}" % BLANKS, piece)):
            return np.array(self.plain.encode_ordinary(piece.decode()), np.int32)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.vocabulary)
            self.library.no_truncation()
            self.library.no_padding()
        return np.array(self.library.encode(piece.decode(), add_special_tokens=False).ids, np.int32)

    def documents(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice, and where each document's begin."""
        data, at = raw.tobytes(), borders(raw, off)
        mark = SPECIAL.encode()
        found, where = [], data.find(mark)
        while where >= 0:
            d = int(np.searchsorted(off, where, "right")) - 1
            inside = where + len(mark) <= off[d + 1]
            found += [where] if inside else []
            where = data.find(mark, where + (len(mark) if inside else 1))
        if found:
            at = np.unique(np.concatenate([at, found, np.add(found, len(mark))]))
        special, one = set(found), np.array([self.special], np.int32)
        ends = at.tolist()
        parts = [one if a in special else self.piece(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        sizes = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(x) for x in parts], out=sizes[1:])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return ids, sizes[np.searchsorted(at, off)]


def encode(docs: DataFrame, ids: str = "ids", paths: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the token ids of every whole ``text`` in a further column
    (replacing one of that name).  No shuffle."""
    docs = docs.drop(ids)
    names, paths = docs.columns, paths or vocabulary_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*paths)
        for batch in batches:
            for rows, raw, off in slices(batch):
                flat, at = encoder.documents(raw, off)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*names, ids])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(frame: DataFrame, ids: str = "ids", column: str = "decoded", paths: tuple[str, str] | None = None) -> DataFrame:
    """``frame`` with the text of its token ids in place of them: the tokens'
    bytes one after another, invalid UTF-8 replaced.  Null ids give ''."""
    paths, names = paths or vocabulary_paths(), [c for c in frame.columns if c not in (ids, column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = sorted((b, a) for a, b in read_ranks(paths[1]).items())
        tokens = [a for _, a in ranks] + [SPECIAL.encode()]
        lengths = np.array([len(x) for x in tokens], np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            lists = batch.column(len(names))
            lists = lists.fill_null([]) if lists.null_count else lists
            off = np.asarray(lists.offsets)
            lo = 0
            while lo < len(lists):
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + DECODE_TOKENS, "right")) - 1)
                hi = min(hi, len(lists))
                at = np.asarray(lists.values)[off[lo]:off[hi]]
                size = lengths[at]
                total = np.concatenate([[0], np.cumsum(size)])
                where = np.repeat(begin[at] - total[:-1], size) + np.arange(total[-1])
                data, cut = flat[where].tobytes(), total[off[lo:hi + 1] - off[lo]].tolist()
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:-1], pa.array(texts, pa.string())], names=[*names, column])
                lo = hi

    schema = T.StructType([*(frame.schema[c] for c in names), T.StructField(column, T.StringType())])
    return frame.select(*names, ids).mapInArrow(run, schema)


def digest_ids(ids: np.ndarray) -> str:
    """SHA-256 of decimal ids joined by commas (for tests)."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def report(docs: DataFrame) -> DataFrame:
    """One row per document: token count, and digests of ids and decoded text."""
    encoded = encode(docs.select("doc_id", "text")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    return decode(encoded).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
