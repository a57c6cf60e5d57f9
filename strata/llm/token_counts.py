"""Token counts: unigram segmentation by a trie with shared forward scores.

Texts are split at white space; every pre-token gets the word-start mark of
the vocabulary.  The distinct new pre-tokens of a slice go into a trie, and the
best forward score and token count are computed once per trie node, that is
once per shared prefix, level by level.  Terminal nodes give a pre-token's
count and score, kept for the rest of the task; documents add them up.  No
shuffle.

The unigram log-probabilities come from the rank of a piece in a public
vocabulary (Zipf: proportional to 1 / (rank + OFFSET)), in millionths, so
sums are exact.  A character in no piece costs one byte token for each of its
UTF-8 bytes.  Equal scores are settled for fewer tokens.

Null, empty and white-space texts have no tokens and score 0.  Repeated rows
are counted row by row.  The store of known pre-tokens is bounded by
``STORE`` entries a task and emptied when full, which changes no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordHash, mix, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
OFFSET = 10
STORE = 400_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def piece_scores(path: str) -> tuple[dict[str, int], int]:
    """Log-probabilities of the pieces in millionths, and a byte token's."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(ids, key=lambda i: (-model.get_score(i), i))
    total = sum(1 / (r + OFFSET) for r in range(len(ranked) + 256))
    log = lambda r: round(1e6 * math.log(1 / (r + OFFSET) / total))
    return {model.id_to_piece(i): log(r) for r, i in enumerate(ranked)}, log(len(ranked) + 255)


class Trie:
    """Counts and scores of pre-tokens, kept by pre-token.

    ``insert`` lays the new pre-tokens out in sorted order, where the words
    that share a prefix stand together: a prefix is a trie node, owned by the
    first word that has it.  Levels are scored one after another for all nodes
    at once; words that share a node copy its score."""

    PROBES = 22

    def __init__(self, scores: dict[str, int], byte: int) -> None:
        self.byte = byte
        # Every ending of a piece: its score if it is a piece itself, else 0,
        # so a search for pieces that end here stops at the first unknown one.
        endings = {p[i:]: 0 for p in scores for i in range(1, len(p))} | scores
        self.longest = max(map(len, scores))
        self.up = self.down = np.ones(1, np.uint64)
        code, start, end = self.spell(list(endings))
        found = self.hashes(code, start, end)
        value = np.fromiter(endings.values(), np.int64, len(endings))
        # Hash slots; entries that meet in a slot go to further tables.
        self.tables = []
        while len(found):
            slot = (found >> np.uint64(64 - self.PROBES)).astype(np.int64)
            first = np.unique(slot, return_index=True)[1]
            at = np.full(1 << self.PROBES, -1, np.int32)
            at[slot[first]] = np.arange(len(first))
            self.tables.append((at, found[first], value[first]))
            rest = np.ones(len(found), bool)
            rest[first] = False
            found, value = found[rest], value[rest]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.count, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all words, and where each begins and ends."""
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        start = np.concatenate([[0], end[:-1]]).astype(np.int64)
        return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), start, end

    def prefix_sums(self, code: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(code):
            base, size = WordHash.BASE, len(code) + 1
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(base))]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(pow(base, -1, 1 << 64)))]), dtype=np.uint64)
        out = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(mix(code.astype(np.uint64) + np.uint64(1)) * self.up[:len(code)], out=out[1:])
        return out

    def span_hash(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def hashes(self, code, start, end) -> np.ndarray:
        return self.span_hash(self.prefix_sums(code), start, end)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Score of each hash, 0 for an ending only, 1 for unknown."""
        out = np.ones(len(h), np.int64)
        slot = (h >> np.uint64(64 - self.PROBES)).astype(np.int64)
        todo = np.arange(len(h))
        for at, keys, value in self.tables:
            i = at[slot[todo]]
            has = i >= 0
            todo, i = todo[has], i[has]
            same = keys[i] == h[todo]
            out[todo[same]] = value[i[same]]
            todo = todo[~same]
        return out

    def insert(self, pretokens: set[str]) -> None:
        words = sorted(pretokens)
        if not words:
            return
        code, start, end = self.spell([MARK + w for w in words])
        sums, length, n = self.prefix_sums(code), end - start, len(words)
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        keep = self.longest + 1
        best, count = np.zeros((keep, n), np.int64), np.zeros((keep, n), np.int64)
        last_best, last_count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alike = np.ones(n, bool)  # the word above has the same prefix so far
        alike[0] = False
        active, depth = np.arange(n), 0
        while len(active):
            depth += 1
            here, row, above = start[active] + depth - 1, depth % keep, np.maximum(active - 1, 0)
            same = alike[active] & (length[above] >= depth)
            same[same] = code[here[same]] == code[start[above[same]] + depth - 1]
            alike[active] = same
            new = active[~same]
            back = (depth - 1) % keep
            top = best[back, new] + width[here[~same]] * self.byte
            tokens = count[back, new] + width[here[~same]]
            left, stop = np.arange(len(new)), start[new] + depth
            for size in range(1, min(depth, self.longest) + 1):
                s = self.lookup(self.span_hash(sums, stop[left] - size, stop[left]))
                left, s = left[s < 1], s[s < 1]
                if not len(left):
                    break
                piece = s < 0
                at, from_ = left[piece], (depth - size) % keep
                s = s[piece] + best[from_, new[at]]
                c = count[from_, new[at]] + 1
                better = (s > top[at]) | ((s == top[at]) & (c < tokens[at]))
                top[at[better]], tokens[at[better]] = s[better], c[better]
            owner = np.cumsum(~same) - 1
            best[row, active], count[row, active] = top[owner], tokens[owner]
            done = length[active] == depth
            last_best[active[done]], last_count[active[done]] = best[row, active[done]], count[row, active[done]]
            active = active[~done]
        self.known.update(zip(words, range(len(self.count), len(self.count) + n), strict=True))
        self.count, self.score = np.concatenate([self.count, last_count]), np.concatenate([self.score, last_best])


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, score): whole texts, score in
    millionths of a natural logarithm."""
    path = path or vocabulary_path()
    docs = docs.select("doc_id", "text")
    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pretokens bigint, n_tokens bigint, score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*piece_scores(path))
        for batch in batches:
            for rows, _, _ in slices(batch):
                split = [(t or "").split() for t in rows.column(1).to_pylist()]
                flat = list(chain.from_iterable(split))
                if len(trie.known) > STORE:
                    trie.clear()
                trie.insert(set(flat).difference(trie.known))
                at = np.fromiter(map(trie.known.__getitem__, flat), np.int64, len(flat))
                ends = np.concatenate([[0], np.cumsum([len(ws) for ws in split])]).astype(np.int64)
                total = lambda x, at=at, ends=ends: np.diff(np.concatenate([[0], np.cumsum(x[at])])[ends])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(ends)), pa.array(total(trie.count)), pa.array(total(trie.score))],
                    names=["doc_id", "n_pretokens", "n_tokens", "score"])

    return docs.mapInArrow(run, out)
