"""Ranked search, periodic runs and exact dedup against brute force, with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import exact_dedup, lexical, periodic_runs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}
SCHEMA = "doc_id long, text string, score int, term string, _run int"


def _documents():
    rnd = random.Random(11)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(3000)] + ["É", "é", "ß¹", "Word", "wORD"]
    text = lambda n: rnd.choice([" ", "-", ", "]).join(rnd.choice(words) for _ in range(n))
    rows = [(k, text(rnd.randrange(1, 120))) for k in range(300)]
    rows += [(1000 + k, rows[k % 7][1]) for k in range(60)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "ABC é"), (404, "abc é"), (404, "abc é"), (405, "abc É"), (None, "abc é"), (None, "only here"), (406, "very " * 20_000), (407, "w1 " * 50_000 + text(50)), (408, "x" * 5000)]
    rnd.shuffle(rows)
    return [(i, t, 1, "t", 3) for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# ranked search


def _ranked(rows, items, k=10):
    found = [(i, [t.translate(LOWER) for t in TERM.findall(x or "")]) for i, x, *_ in rows]
    n, total = sum(1 for _, t in found if t), sum(len(t) for _, t in found)
    counts = [(i, len(t), Counter(t)) for i, t in found]
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, x in items:
        scores = []
        for i, length, c in counts:
            s = 0
            for t, times in Counter(t.translate(LOWER) for t in TERM.findall(x or "")).items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * length * n // total)))
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out += [(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "w1 w2 w3 w1 Word"), (2, None), (3, ""), (4, "nowhere at-all"), (5, "ABC é É"), (5, "ABC é É"), (6, "very ONLY here w1"), (None, "ß¹ w7 w9"), (7, "w1"), (8, " ".join(f"w{k}" for k in range(300)))]


@pytest.mark.parametrize("size", [8 << 20, 20_000])
def test_ranked_search(spark, docs, rows, monkeypatch, size):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", size)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    found = lexical.search(lexical.build_index(docs), items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == _ranked(rows, ITEMS)


def test_blocks_are_skipped_before_they_are_decompressed(rows):
    """Long documents of one frequent word: what holds the rare word too is found, and most blocks stay closed."""
    import pyarrow as pa

    texts = [f"common {'pad ' * (k % 97)}" for k in range(5000)]
    texts[1234] = texts[4321] = "common rare"
    columns = lexical._segment(pa.array(range(5000), pa.int64()), pa.array(texts))
    row = dict(zip(["n_docs", "n_terms", "documents", "terms", "blocks", "bytes"], (c[0] for c in columns), strict=True))
    terms = pa.array(["common", "rare"], pa.string()).cast(pa.large_binary())
    segment = lexical._Segment(row, terms, np.array([10, 8000]), row["n_docs"], row["n_terms"])
    best = segment.search(np.array([0, 1]), np.array([1, 1]), [], 2, 0)
    assert sorted(i for _, i in best) == [1234, 4321]
    assert segment.opened.sum() < 0.1 * len(segment.opened)


def test_numbers_round_trip():
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1, 5])
    data, starts = lexical.pack_numbers(x)
    assert lexical.unpack_numbers(data).tolist() == x.tolist()
    assert len(starts) == len(x) + 1


def test_ranked_search_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(none, items).collect() == []
    assert lexical.ranked_search(spark.createDataFrame([(1, None, 1, "", 1)], SCHEMA), items).collect() == []
    assert lexical.ranked_search(spark.createDataFrame([(1, "a", 1, "", 1)], SCHEMA), items.limit(0)).collect() == []


# periodic runs


def _runs(w):
    """By the definition: every maximal stretch of each period, then the smallest periods only."""
    out = []
    for p in range(1, len(w) // 3 + 1):
        k = 0
        while k + p < len(w):
            if w[k] != w[k + p]:
                k += 1
                continue
            e = k
            while e + p < len(w) and w[e] == w[e + p]:
                e += 1
            length = e - k + p
            x = w[k : k + length]
            if length >= max(24, 3 * p) and not any(all(x[i] == x[i + q] for i in range(length - q)) for q in range(1, p)):
                out.append((k, length, p))
            k = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def _texts():
    rnd = random.Random(3)
    block = lambda p, a: [rnd.choice(a) for _ in range(p)]
    for _ in range(250):
        w, a = [], [f"x{k}" for k in range(rnd.choice([1, 2, 3, 30]))]
        while len(w) < rnd.choice([0, 30, 120, 260]):
            p = rnd.choice([1, 2, 3, 5, 8, 12, 20])
            w += (block(p, a) * rnd.randrange(1, 12))[: rnd.randrange(1, 90)]
        yield w


def test_runs_equal_the_definition():
    some = 0
    for w in _texts():
        names = {x: k for k, x in enumerate(dict.fromkeys(w))}
        found = periodic_runs.find_runs(np.array([names[x] for x in w], np.int64))
        assert found == _runs(w)
        some += len(found)
    assert some > 100


def test_grids_in_small_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "STEPS", 50)
    for w in list(_texts())[:40]:
        names = {x: k for k, x in enumerate(dict.fromkeys(w))}
        assert periodic_runs.find_runs(np.array([names[x] for x in w], np.int64)) == _runs(w)


def test_one_word_repeated_takes_one_extension(monkeypatch):
    calls = []
    agree = periodic_runs._agree
    monkeypatch.setattr(periodic_runs, "_agree", lambda *a: calls.append(1) or agree(*a))
    assert periodic_runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert len(calls) == 2


def test_periodic_runs_query(spark):
    rows = [(k, " ".join(w) + " \t", 1, "t", 3) for k, w in enumerate(_texts())]
    rows += [(900, None, 1, "", 0), (901, "", 1, "", 0), (902, "\n \t", 1, "", 0), (903, "a " * 60_000, 1, "", 0), (904, "é a\x0bb " * 30, 1, "", 0), (904, "é a\x0bb " * 30, 1, "", 0), (None, "b a " * 30, 1, "", 0)]
    wanted = []
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        runs = [(0, 60_000, 1)] if i == 903 else _runs(w)
        gone = {j for s, length, q in runs for j in range(s + q, s + length)}
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        wanted.append((i, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha(lines), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows if i is not None)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.plant(docs), ["doc_id", "score"]))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    assert periodic_runs.periodic_runs(docs.limit(0), ["doc_id", "runs"]).collect() == []


# exact dedup


@pytest.mark.parametrize("largest, fan", [(True, 16), (False, 2)])
def test_exact_dedup(docs, rows, largest, fan):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    wanted = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known, default=None)
        stays = ids.index(keep)  # one of the rows with that id
        wanted += [(i, "t", keep, len(ids), k == stays, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    found = exact_dedup.exact_dedup(docs, ["doc_id", "term", "kept", "_run"], largest=largest, fan=fan)
    assert found.columns == ["doc_id", "term", "keep_id", "group_size", "kept", "text_sha256"]
    found = list(map(tuple, found.collect()))
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert sum(r[4] for r in found) == len(groups)


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.exact_dedup(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA), ["doc_id"]).collect() == []
