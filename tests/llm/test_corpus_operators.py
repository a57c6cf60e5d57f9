"""Operators that compare documents: suffix dedup, Jaccard join,
decontamination, fingerprints; and pseudonyms."""

import collections
import datetime as dt
import functools
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from strata.llm import decontamination, imatch, jaccard_join, pseudonyms, suffix_dedup
from strata.llm.common import SEPARATORS, python_words


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


# ---- suffix-array dedup ----------------------------------------------------

def repeats_by_hand(rows):
    """Result of every distinct (id, text), straight from the definition."""
    order = sorted({(i, t) for i, t in rows}, key=lambda x: (x[0] is None, x[0] or 0))
    seen, out = set(), {}
    for i, t in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\x01" * 100
            seen.add(b[p:p + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i, t] = (i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return collections.Counter(out[r] for r in rows)


@pytest.mark.parametrize("chunk", [40, 1_500_000])
def test_suffix_dedup(spark, corpus, frame, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)  # many chunks, or one
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line, base = text(60), text(400)
    rows = [(i, t) for i, t in corpus if (i, t) != (8, "another text under an id that is taken")]
    # A common line in changing surroundings, and shifted, edited passages.
    rows += [(500 + i, text(rnd.randrange(200)) + line + text(rnd.randrange(200))) for i in range(80)]
    rows += [(600 + i, base[i * 3:] + text(5) + base[:200 + i]) for i in range(20)]
    rows += [(700, "a" * 99), (701, "a" * 100), (702, "a" * 250), (-5, "ab" * 300)]
    got = bag(suffix_dedup.report(frame(rows)).collect())
    assert got == repeats_by_hand(rows)


def test_suffix_dedup_small_buckets_and_empty(spark, corpus, frame):
    rows = [(i, t) for i, t in corpus if i is not None and i != 8]
    parts = suffix_dedup.dedup(frame(rows), bucket=2000)
    assert {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) for r in parts.collect()} == {
        k[0]: (k[1], k[2], k[3]) for k in repeats_by_hand(rows)}
    assert suffix_dedup.report(frame([])).collect() == []


def test_longest_previous_factor():
    words = np.array([[1], [2], [1], [3], [2], [1]], np.uint64)
    order, hit = suffix_dedup.longest_previous_factor(words, np.array([5, 2, 1, 9, 7, 3]))
    assert sorted(order[hit].tolist()) == [0, 4, 5]


def test_heavy_grams_come_last(spark, frame):
    """A line in a third of all documents is no anchor of runs that reach
    beyond it."""
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line = text(60)
    rows = [(i, text(150) + line + text(150) if i % 3 else text(300)) for i in range(400)]
    df = frame(rows, extra=False).coalesce(1).selectExpr("doc_id AS k", "xxhash64(text) AS h", "0 AS dbucket", "text")
    heavy = suffix_dedup.heavy_grams(df)
    raw = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    off = np.cumsum([0] + [len(t) for _, t in rows])
    most = [max(np.unique(suffix_dedup.entries(raw, off, suffix_dedup.Heavy(x))["a"], return_counts=True)[1])
            for x in (np.zeros(0, np.uint64), heavy)]
    assert len(heavy) and most[0] > 200 and most[1] < 20


# ---- n-gram Jaccard join ----------------------------------------------------

def jaccard_by_hand(rows):
    sets = []
    for _, t in rows:
        w = python_words(t)
        sets.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)] += [d] if d is not None else []
    return [(d, min(least[find(i)], default=None), links[i]) for i, (d, _) in enumerate(rows)], len({find(i) for i in range(len(rows))})


@pytest.mark.parametrize("block", [4, 256])
def test_jaccard_join(spark, corpus, frame, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)  # clusters cut into blocks, or whole
    want, groups = jaccard_by_hand(corpus)
    got = jaccard_join.report(frame(corpus)).collect()
    assert bag((r.doc_id, r.class_id, r.n_links) for r in got) == collections.Counter(want)
    if block > 4:
        kept = jaccard_join.keep_one(frame(corpus))
        assert kept.columns == frame([]).columns and kept.count() == groups
        assert jaccard_join.report(frame([])).collect() == [] and jaccard_join.keep_one(frame([])).collect() == []


def test_bands_meet_the_recall():
    for recall in (0.9, 0.999, 0.99999):
        b = jaccard_join.bands(0.8, 5, recall)
        assert 1 - (1 - 0.8**5) ** b >= recall > 1 - (1 - 0.8**5) ** (b - 1)


def test_connect_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a bigint, b bigint")
    got = {r.node: r.root for r in jaccard_join.connect(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# ---- decontamination ---------------------------------------------------------

def test_decontamination_equals_sql(spark, corpus, frame):
    texts = dict(corpus[:64])
    words = python_words(texts[60])
    items = [(1, " ".join(words[100:130])), (2, "One, TWO three four!"), (3, None), (4, "--"), (None, " ".join(words[200:220])),
             (5, "the"), (6, " ".join(words[110:123])), (6, "nowhere to be found at all"), (7, "a a a a a a a a a a a a a a a")]
    docs = corpus + [(800, " ".join(words[95:140])), (801, "x " * 400 + " ".join(words[100:113])), (802, "a " * 40), (803, "the the of the")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS wid", "'p' AS phrase")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([i for i, _ in docs], "Int64"), "text": [t for _, t in docs]}))
    con.register("benchmark", pd.DataFrame({"item_id": pd.array([i for i, _ in items], "Int64"), "text": [t for _, t in items]}))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = collections.Counter(con.execute(f"SELECT {', '.join(names)} FROM ({decontamination.SQL})").fetchall())
    got = bag(decontamination.report(frame(docs), benchmark).select(*names).collect())
    assert got == want
    clean = decontamination.clean(frame(docs), benchmark)
    assert clean.columns == frame([]).columns
    assert clean.count() == sum(n for r, n in want.items() if not r[-1])
    assert decontamination.report(frame([]), benchmark).collect() == []
    assert decontamination.report(frame(docs[:3]), benchmark.limit(0)).filter("n_hit > 0 OR contaminated").collect() == []


def test_decontamination_proximity(spark, frame):
    item = "amber birch cedar delta ember fjord grove haven islet joker kayak lotus maple"
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = [(1, item), (2, item.replace(" ", " x ", 1)), (3, item.replace("birch", "birch u v w x y z")), (4, "amber birch"), (5, "maple amber"),
            (6, item.replace("delta", "u v w x delta"))]
    got = {r.row.doc_id: (len(r.spans), len(r.near)) for r in decontamination.matches(frame(docs, extra=False), benchmark).collect()}
    # The two rarest words are cedar and delta.
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 1), 4: (0, 0), 5: (0, 0), 6: (0, 0)}


# ---- fingerprints --------------------------------------------------------------

def test_imatch_against_python(spark, corpus, frame):
    rows = [r for r in corpus if r[0] is not None] + [(10_000 * i, f"salt bread {i} loaf") for i in range(1, 5)]
    got = imatch.report(frame(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0], (r[1] or "").encode()), reverse=True)
    want, texts = collections.Counter(), {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want[d, len(t), digest] += 1
        texts[d, len(t), digest] = (t, edited, nxt)
    assert bag((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    # Equal texts have equal fingerprints, wherever they come from.
    prints = collections.defaultdict(set)
    for r in got:
        t, edited, _ = texts[r.doc_id, r.n_chars, r.edited_sha256]
        prints[t].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    n = len(imatch.RATES) * imatch.PER_RATE
    like = lambda a, b: (lambda p: 1.0 if not p else sum(x == y for x, y in p) / len(p))(
        [(a[i * 8:i * 8 + 8], b[i * 8:i * 8 + 8]) for i in range(n) if a[i * 8:i * 8 + 8] != imatch.EMPTY or b[i * 8:i * 8 + 8] != imatch.EMPTY])
    for r in got:
        t, edited, nxt = texts[r.doc_id, r.n_chars, r.edited_sha256]
        assert r.near_edited == pytest.approx(like(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(like(r.fingerprint, next(iter(prints[nxt]))))


def fingerprint_by_hand(text, terms):
    """Subset hashes by the XXH64 algorithm, of a text and the lexicon's terms."""
    chain = lambda values: functools.reduce(lambda h, v: xxhash.xxh64(v.to_bytes(8, "little", signed=True), seed=h).intdigest(), values, 42)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    own = {signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.split(SEPARATORS, text.lower()) if w}
    found = sorted(own & terms) or sorted(own)
    part = lambda kept: f"{chain(kept) & 0xFFFFFFFF:08x}" if kept else imatch.EMPTY
    inside = lambda t, rate, seed: xxhash.xxh64(seed.to_bytes(4, "little"), seed=chain([t])).intdigest() & ((1 << rate) - 1) == 0
    parts = [part([t for t in found if inside(t, rate, 100 * rate + i)]) for rate in imatch.RATES for i in range(imatch.PER_RATE)]
    if set(parts) == {imatch.EMPTY}:
        parts[0] = part(found)
    return "".join(parts)


def test_imatch_digests_against_python(spark, corpus, frame):
    """Lexicon and every digest, counted and hashed in Python."""
    rows = [r for r in corpus if r[0] is not None]
    distinct = {t or "" for _, t in rows}
    df = collections.Counter(w for t in distinct for w in set(re.split(SEPARATORS, t.lower())) - {""})
    band = {w for w, n in df.items() if len(distinct) * imatch.MIN_SHARE <= n <= max(1.0, len(distinct) * imatch.MAX_SHARE)}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    terms = {signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in band}
    assert {r.term for r in imatch.lexicon(frame(rows)).collect()} == terms
    got = bag((r.doc_id, r.n_chars, r.fingerprint) for r in imatch.report(frame(rows)).collect())
    assert got == bag((i, len(t or ""), fingerprint_by_hand(t or "", terms)) for i, t in rows)


@pytest.mark.parametrize("kind", ["null", "same", "sparse"])
def test_imatch_hot_and_sparse_ids(spark, frame, kind):
    """A third of the ids null or one, or ids all over the 64-bit range:
    every row has its next text, in blocks of bounded size."""
    rnd = random.Random(3)
    ids = [rnd.randrange(-1 << 63, 1 << 63) if kind == "sparse" else i for i in range(900)]
    rows = [(i if kind == "sparse" or n % 3 else None if kind == "null" else 500, f"text {n % 700}") for n, i in enumerate(ids)]
    got = imatch.with_next(frame(rows)).collect()
    assert bag((r.doc_id, r.text) for r in got) == bag(rows)
    order = sorted(got, key=lambda r: r.place)
    assert [r.place for r in order] == list(range(900))
    keys = [-(1 << 64) if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys, reverse=True)
    assert all(r.next == order[(i + 1) % 900].text for i, r in enumerate(order))
    assert max(collections.Counter(r.block for r in got).values()) <= imatch.BLOCK
    assert sum(r.last for r in got) == -(-900 // imatch.BLOCK)


def test_imatch_edges(spark, frame):
    one = imatch.report(frame([(3, "salt")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"sasa").hexdigest()
    assert imatch.report(frame([])).collect() == []
    rows = imatch.report(frame([(None, None), (None, "x y"), (5, ""), (5, "")])).collect()
    assert bag((r.doc_id, r.n_chars) for r in rows) == {(None, 0): 1, (None, 3): 1, (5, 0): 2}


def test_imatch_copies_keep_their_words(spark, frame):
    """Copies in a third of the rows leave the lexicon as it is."""
    rnd = random.Random(12)
    text = lambda: " ".join(f"w{rnd.randrange(4000)}" for _ in range(120))
    rows = [(i, text()) for i in range(60)]
    copies = [(1000 + i, rows[7][1]) for i in range(20)] + [(2000 + i, rows[8][1]) for i in range(20)]
    lexicon = lambda r: {t.term for t in imatch.lexicon(frame(r)).collect()}
    assert lexicon(rows + copies) == lexicon(rows)
    got = {r.doc_id: r for r in imatch.report(frame(rows + copies)).collect()}
    alone = {r.doc_id: r for r in imatch.report(frame(rows)).collect()}
    assert all(got[i].fingerprint == alone[i].fingerprint for i in range(60))
    assert got[1005].fingerprint == got[7].fingerprint != got[8].fingerprint
    assert got[2000].near_next < 0.5 and got[1005].near_next == 1.0 and got[1005].near_edited > 0


def test_imatch_without_lexicon_words(spark, frame):
    """Texts of words that are all too common or too rare differ."""
    common = ["salt", "bread", "loaf", "a b c d e f"]
    rows = [(i, t) for i, t in enumerate(common)] + [(10 + i, f"salt bread loaf a b c d e f n{i}") for i in range(14)]
    got = {r.doc_id: r for r in imatch.report(frame(rows + [(30, ""), (31, "-")])).collect()}
    prints = [got[i].fingerprint for i in range(len(common))]
    zeros = imatch.EMPTY * len(imatch.RATES) * imatch.PER_RATE
    assert len(set(prints)) == len(common) and zeros not in prints
    assert got[2].near_next < 1 and got[30].fingerprint == got[31].fingerprint == zeros and got[31].near_next == 1.0
    # Every word in one of more than 500 texts.
    got = imatch.report(frame([(i, f"x{i} y{i} z{i}") for i in range(520)])).collect()
    assert len({r.fingerprint for r in got}) == 520 and sum(r.near_next == 1.0 for r in got) == 0


# ---- pseudonyms -------------------------------------------------------------------

def noise(kind, i, half, key=pseudonyms.KEY):
    return hashlib.sha512(f"{key}|{kind}|{i}|{half}".encode()).hexdigest()


def text_by_hand(kind, text, alphabets, back=False):
    n = len(text) // 2
    left, right = text[:n], text[n:]

    def add(half, other, i, sign):
        out, h = "", noise(kind, i, other)
        for j, c in enumerate(half):
            for a in alphabets:
                if c in a:
                    c = a[(a.index(c) + sign * int(h[4 * j:4 * j + 4], 16)) % len(a)]
                    break
            out += c
        return out

    for i in (reversed(range(pseudonyms.ROUNDS)) if back else range(pseudonyms.ROUNDS)):
        left, right = (add(right, left, i, -1), left) if back else (right, add(left, right, i, 1))
    return left + right


def luhn_ok(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_pseudonyms_by_hand(spark, frame):
    rnd = random.Random(6)
    cards = []
    while len(cards) < 20:
        c = str(rnd.randrange(10**15, 10**16))
        if luhn_ok(c):
            cards.append(c)
    rows = [(i, f"pay {c} now") for i, c in enumerate(cards)] + [(100, "4111-1111-1111-1112"), (101, "a.b9@mail.example.com")]
    got = {r.doc_id: r for r in pseudonyms.report(frame(rows)).collect()}
    for i, c in enumerate(cards):
        new = re.search(r"\d{16}", got[i].text)[0]
        body = c[0] + text_by_hand("card", c[1:-1], (pseudonyms.DIGITS,))
        assert new[:-1] == body and luhn_ok(new) and got[i].kinds == "card"
        assert text_by_hand("card", new[1:-1], (pseudonyms.DIGITS,), back=True) == c[1:-1]
    assert got[100].n_found == 0 and got[100].text == "4111-1111-1111-1112"
    assert got[101].text == text_by_hand("email", "a.b9", (pseudonyms.DIGITS, pseudonyms.SMALL, pseudonyms.CAPITAL)) + "@mail.example.com"


def test_pseudonyms_keep_form_and_links(spark, frame):
    rows = [(1, "4111 1111 1111 1111 and 4111-1111-1111-1111"), (2, "4111111111111111"), (3, None), (4, ""), (5, "no 12 numbers 2020-02-30 999.1.1.1"),
            (6, "2020-02-29; 29.02.2020; 29/02/2020; 02/29/2020; 1700-01-01"), (7, "+1 (743) 555-3824, 743-555-3824, 143-555-3824, +49 151 2345678"),
            (8, "123-45-6789 000-12-3456 666-12-3456"), (9, "DE89 3704 0044 0532 0130 00, GB82WEST12345698765432, DE88370400440532013000"),
            (10, "ip 8.8.8.8 and 8.8.8.8."), (11, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'), (12, "x" * 20000 + " 8.8.8.8"), (2, "4111111111111111")]
    df = pseudonyms.pseudonymize(frame(rows))
    assert set(frame([]).columns) == set(df.columns)
    got = collections.defaultdict(list)
    for r in df.collect():
        got[r.doc_id].append((r.text, r.found))
    numbers = re.findall(r"[\d -]{16,}\d", got[1][0][0].replace(" and ", "x"))
    assert len({re.sub(r"\D", "", x) for x in numbers} | {got[2][0][0]}) == 1 and got[2][0] == got[2][1]
    assert [len(x) for x in numbers] == [19, 19] and luhn_ok(got[2][0][0])
    assert got[3] == [(None, [])] and got[4] == [("", [])] and got[5] == [(rows[4][1], [])]
    dates = got[6][0][0].split("; ")
    day = dt.date.fromisoformat(dates[0])
    assert dates[1] == day.strftime("%d.%m.") + f"{day.year:04d}" and dates[4] == "1700-01-01"
    assert dates[2] == day.strftime("%d/%m/") + f"{day.year:04d}" and dates[3] == day.strftime("%m/%d/") + f"{day.year:04d}"
    phones = got[7][0][0].split(", ")
    assert re.sub(r"\D", "", phones[0])[1:] == re.sub(r"\D", "", phones[1]) != "7435553824" and phones[2] == "143-555-3824"
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", phones[0]) and re.fullmatch(r"\+49 \d{3} \d{7}", phones[3])
    assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4} 000-12-3456 666-12-3456", got[8][0][0]) and got[8][0][1] == ["ssn"]
    ibans = got[9][0][0].split(", ")
    value = lambda x: int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97
    assert value(ibans[0].replace(" ", "")) == value(ibans[1]) == 1 and ibans[2] == "DE88370400440532013000" and ibans[1][4:8].isalpha()
    a, b = re.findall(r"\d+(?:\.\d+){3}", got[10][0][0])
    assert a == b != "8.8.8.8" and all(int(x) < 256 for x in a.split(".")) and got[12][0][0].endswith(" " + a)
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[11][0][0]) and got[11][0][0] != rows[10][1]
    assert pseudonyms.report(frame([])).collect() == []
    other = pseudonyms.pseudonymize(frame([(2, "4111111111111111")]), key="another").first().text
    assert other != got[2][0][0] and luhn_ok(other)


def test_pseudonyms_beside_other_numbers(spark, frame):
    card, other, iban, british = "4111111111111111", "5500005555555559", "AT611904300234573201", "GB82WEST12345698765432"
    apart = " ".join(card[i:i + 4] for i in range(0, 16, 4))
    texts = [f"{card} 123", f"{apart} 12/25", f"{card} {other}", f"{apart} {other} {card}", f"{iban} BIC BKAUATWW", f"{iban} {british}",
             f"{iban} {card}", f"no 12 {apart}", f"{card} 743-555-3824", f"{iban} 743-555-3824", f"2020-02-29 {card} 8.8.8.8", f"{card}1234567 {card[:-1]}2"]
    got = {r.doc_id: r for r in pseudonyms.pseudonymize(frame(list(enumerate(texts)))).collect()}
    alone = {v: pseudonyms.pseudonymize(frame([(0, v)])).first().text for v in (card, other, iban, british, "743-555-3824", "2020-02-29", "8.8.8.8")}
    alone[apart] = " ".join(alone[card][i:i + 4] for i in range(0, 16, 4))
    kinds = [["card"], ["card"], ["card"] * 2, ["card"] * 3, ["iban"], ["iban"] * 2, ["iban", "card"], ["card"], ["card", "phone"],
             ["iban", "phone"], ["date", "card", "ip"], []]
    for i, t in enumerate(texts):
        want = re.sub("|".join(map(re.escape, alone)), lambda m: alone[m[0]], t) if kinds[i] else t
        assert (got[i].text, got[i].found) == (want, kinds[i])


def test_pair_permutation_is_one_to_one(spark):
    from pyspark.sql import functions as F

    df = spark.range(7 * 11).select(pseudonyms.permute_pair(F.lit("k"), "test", F.floor(F.col("id") / 11), F.col("id") % 11, 7, 11).alias("p"))
    got = {(r.p.l, r.p.r) for r in df.collect()}
    assert got == set(itertools.product(range(7), range(11)))


@pytest.mark.parametrize("name", ["op5_pseudonyms", "op9_decontamination", "op10_imatch"])
def test_native_operators_run_no_python(spark, sf, name):
    from strata.llm.queries import REGISTRY

    plan = REGISTRY[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
