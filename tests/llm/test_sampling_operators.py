"""Importance resampling, conversation prefix trie, source mixing."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import common, importance, mixing, prefix_trie
from strata.llm.common import python_words


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_placed_and_count_words(spark):
    rows = [(i % 3 if i % 5 else None, "same") for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(4)
    got = common.placed(df, "at", F.col("a").desc_nulls_last(), F.col("b")).collect()
    assert sorted(r["at"] for r in got) == list(range(100))
    assert [r["a"] for r in sorted(got, key=lambda r: r["at"])] == sorted((r[0] for r in rows), key=lambda a: (a is None, -(a or 0)))
    assert common.placed(df.filter("false"), "at", F.col("a")).collect() == []
    texts = [None, "", "  ", "a", " a b\tc\n", "x y z\x0b\x0cw", "\U0001F600 é", "a" * 100_000 + " " * 100_000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", common.count_words(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts}


# ---- importance resampling -------------------------------------------------

def resampled(rows, target, n, buckets, percent, min_words):
    def features(text):
        ws = python_words(text)
        return ws, ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])] if n > 1 else ws

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = collections.Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        ws, fs = features(text)
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(ws), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), text])
    fit = sorted((o for o in out if o[1] >= min_words), key=lambda o: (-o[4], o[0] is None, o[0] or 0))
    drawn = fit[:percent * len(fit) // 100]
    return out, drawn


@pytest.mark.parametrize("n", [1, 2])
def test_importance(spark, corpus, frame, monkeypatch, n):
    monkeypatch.setattr(importance, "PIECE", 50)  # texts in many pieces
    target = ["harbour loaf salt " * 40, None, "", "clock 7 x9 été", "gulls7 gulls7"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame(corpus), aim, n=n, buckets=97, percent=30, min_words=5).collect()
    out, drawn = resampled(corpus, target, n, 97, 30, 5)
    assert bag((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == bag(tuple(o[:5]) for o in out)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(o[0], o[4]) for o in drawn]
    kept = importance.draw(frame(corpus), aim, n=n, buckets=97, percent=30, min_words=5)
    assert kept.columns == frame(corpus).columns
    assert bag((r.doc_id, r.score_) for r in kept.withColumn("score_", F.col("text")).collect()) == bag((o[0], o[5]) for o in drawn)


def test_importance_head_is_bounded_and_only_saves_work(spark, frame):
    rows = [(i, f"the of word{i} word{i} w{i % 50}") for i in range(300)]
    docs = frame(rows)
    states, pairs = importance.head_of(docs, n=2, share=20)
    total = 300 * 9
    counts = collections.Counter(w for _, t in rows for w in t.encode().split())
    assert {w for w, c in counts.items() if c * 20 > total} <= set(states) and len(states) + len(pairs) <= 2 * 20 * 4 / 3
    assert all(zlib.crc32(w) == s for w, s in states.items()) and all(zlib.crc32(w) % importance.BUCKETS == b for w, b in pairs.items())
    one = importance.bucket_totals(docs, (states, pairs), 2).collect()
    assert bag(one) == bag(importance.bucket_totals(docs, ({}, {}), 2).collect())
    # Lowering keeps every word above the bound.
    counter = collections.Counter({b"a": 50, b"b": 30, **{b"%d" % i: 1 for i in range(40)}})
    assert importance.lowered(counter, 5) == {b"a": 49, b"b": 29}


def test_importance_empty(spark, frame):
    none = spark.createDataFrame([], "text string")
    assert importance.report(frame([]), none).collect() == []
    got = importance.report(frame([(1, "a " * 30), (2, None)]), none).collect()
    assert {r.doc_id: (r.n_features, r["rank"]) for r in got} == {1: (30, None), 2: (0, None)}


# ---- prefix trie -----------------------------------------------------------

def trie_by_hand(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
    return bag((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest())
               for k, m in members.items())


def conversations():
    rnd = random.Random(3)
    say = lambda: " ".join(rnd.choice("yes no maybe  x why\tnot".split(" ")) for _ in range(rnd.randrange(3)))
    rows = []
    for c in range(-45, 120):
        if c % 7:
            rows += [(c, t, rnd.choice(["user", "bot", None]), rnd.choice([say(), None, "hello"])) for t in range(rnd.randrange(1, 7))]
    for c in range(200, 290):  # copies
        rows += [(c, t, "user", f"copy {t // 2}") for t in range(6)]
    rows += [(300, t, "user", f"turn {t % 9}") for t in range(400)] + [(301, t, "user", f"turn {t % 9}") for t in range(380)]
    rows += [(320, None, "bot", "first"), (320, 1, "bot", "tie b"), (320, 1, "bot", "tie a"), (320, 1, "bot", "tie a"), (None, 1, "bot", "nobody"),
             (322, 0, "user", "z"), (400, 5, "a", "bc"), (401, 5, "ab", "c"), (402, 1, "user", "long " * 20_000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [7, 4096])
def test_prefix_trie(spark, monkeypatch, segment):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 10)
    monkeypatch.setattr(prefix_trie.prefixes, "__defaults__", (segment,))
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    for extra in ("node", "parent", "depth", "pos", "place", "kids", "digest"):
        df = df.withColumn(extra, F.lit("x"))
    assert bag(prefix_trie.trie(df).collect()) == trie_by_hand(rows)


def test_prefix_trie_empty_and_turnless(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).collect() == []
    short = [(c, 0, "user", "only") for c in range(1, 60) if c % 20]  # no bases: first turns are replaced by nothing
    assert bag(prefix_trie.trie(spark.createDataFrame(short, schema)).collect()) == trie_by_hand(short)


def test_tree_contraction_takes_few_rounds(spark):
    """A chain of 2,000 nodes with a leaf at every tenth one."""
    rows = [(i, i - 1 if i else None, 1) for i in range(2000)] + [(10_000 + i, i, 1) for i in range(0, 1990, 10)]
    kids = collections.Counter(p for _, p, _ in rows)
    tree = spark.createDataFrame([(i, p, kids[i], v) for i, p, v in rows], "node bigint, parent bigint, kids bigint, v bigint")
    got = {r.node: r.v for r in prefix_trie.subtree_totals(tree, ["v"], rounds=40).collect()}
    want = {i: v for i, _, v in rows}
    for i, p, _ in sorted(rows, key=lambda r: -(r[0] if r[0] < 10_000 else 10_000 + r[0])):
        if p is not None:
            want[p] += want[i]
    assert got == want


# ---- mixing ----------------------------------------------------------------

def mixed(df, **options):
    return mixing.mix(df, **options).toPandas()


def test_mixing(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randrange(0, 60)), rnd.choice(["a", "b", "b", "b", "é", None, "tiny"]) if i % 3 else "hot") for i in range(6000)]
    rows = [r for r in rows if r[2] != "tiny" or r[0] % 40 == 1]
    rows += [(7, "x y z", "b")] * 500 + [(None, None, "b"), (None, "  ", "void"), (None, "a b", None)]
    make = lambda n: spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("g", F.lit(1)).withColumn("of", F.lit(2)).repartition(n)
    got = mixed(make(3), block=64)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over
    assert target["tiny"] == 3 * sizes["tiny"] and target["void"] == 0
    got = got.astype({"source": object}).where(got.notna(), None)
    for s, part in got.groupby(got.source.map(lambda x: x or "\0null")):
        s = None if s == "\0null" else s
        assert part.source_size.iloc[0] == sizes[s] and abs(part.target.iloc[0] - target[s]) < 1e-6
        assert abs(part.taken.sum() - target[s]) <= max(part["size"])
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    rate = {s: target[s] / sizes[s] if sizes[s] else 0 for s in names}
    for s, size, copies in zip(got.source, got["size"], got.copies):
        assert copies in ((0,) if not size else (math.floor(rate[s]), math.ceil(rate[s])))
    # The same draw whatever the partitions and their order.
    again = mixed(make(11).orderBy(F.rand(3)), block=64)
    key = lambda p: bag(zip(p.doc_id.fillna(-1), p.source.fillna("null"), p["size"], p.taken))
    assert key(got) == key(again)
    assert key(got) != key(mixed(make(3), block=64, seed=14))


def test_meeting_keeps_words_and_expectation():
    rnd = random.Random(2)
    for _ in range(300):
        one, two = (1, float(rnd.randrange(1, 50)), rnd.uniform(0.01, 0.99)), (2, float(rnd.randrange(1, 50)), rnd.uniform(0.01, 0.99))
        words = one[1] * one[2] + two[1] * two[2]
        (x, s), (y, t) = (one[2], one[1]), (two[2], two[1])
        up, down = min((1 - x) * s, y * t), min(x * s, (1 - y) * t)
        mean = 0
        for u, p in ((0.0, down / (up + down)), (1 - 1e-12, up / (up + down))):
            settled, left = mixing.meet(one, two, u)
            value = dict(settled) | ({left[0]: left[2]} if left else {})
            assert settled and set(value) == {1, 2} and abs(value[1] * s + value[2] * t - words) < 1e-9
            mean += p * value[1]
        assert abs(mean - x) < 1e-9


def test_mixing_is_unbiased(spark):
    rows = [(i, "w " * (1 + i % 5), "a" if i % 3 else "b") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1)
    items = [(0, i, i, 1 + i % 5, 0.3) for i in range(30)]
    df = spark.createDataFrame(items, "start bigint, nth bigint, g bigint, size bigint, x double")
    taken = collections.Counter()
    for seed in range(40):
        rounded = mixing.round_copies(df, 30, block=8, seed=seed).collect()
        assert len(rounded) == 30 and abs(sum((1 + r.g % 5) * r.up for r in rounded) - 0.3 * 90) <= 5
        taken.update({r.g: r.up for r in rounded})
    assert all(1 <= taken[i] <= 26 for i in range(30))


def test_mixing_empty(spark):
    schema = "doc_id bigint, text string, source string"
    assert mixing.report(spark.createDataFrame([], schema)).collect() == []
    got = mixing.report(spark.createDataFrame([(1, None, None), (2, " ", "a")], schema)).collect()
    assert bag(got) == bag([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])
