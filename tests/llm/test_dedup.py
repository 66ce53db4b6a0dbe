"""Substring, suffix and Jaccard operators against brute force, with awkward rows."""

import collections
import random
import re

import pytest

from ledgerline.llm import jaccard_join, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang int"


def _rows():
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(400)] + ["é", "ß¹", "Word"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = text(300), text(60)
    rows = [(k, text(rnd.randrange(1, 200))) for k in range(40)]
    rows += [(100 + k, text(40) + "\n" + passage + "\t" + text(30)) for k in range(4)]
    for k in range(30):
        w = base.split()
        for _ in range(rnd.randrange(1, 9)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(9)}"
        rows.append((200 + k, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, base), (303, base), (304, "a b"), (305, "A  b"), (306, "z" * 400), (307, "z" * 99), (308, "very " * 20_000)]
    rnd.shuffle(rows)
    return [(i, t, 1) for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_substring_dedup(docs, rows):
    words = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    count = collections.Counter(tuple(w[k : k + 35]) for _, w in words for k in range(len(w) - 34))
    wanted = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        wanted.append((i, " ".join(x for x, g in zip(w, gone, strict=True) if not g), len(w), sum(gone)))
    assert sorted(map(tuple, substring_dedup.substring_dedup(docs, ["doc_id"]).collect())) == sorted(wanted)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_dedup(docs, rows, hot):
    seen, wanted = set(), []
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone, last = bytearray(len(b)), 0
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[max(k, last) : k + 100] = b"\1" * (k + 100 - max(k, last))
                last = k + 100
            seen.add(b[k : k + 100])
        wanted.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g), len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x)))
    found = sorted((r[0], bytes(r[1]), *r[2:]) for r in suffix_dedup.suffix_dedup(docs, hot_contexts=hot).collect())
    assert found == sorted(wanted)


@pytest.mark.parametrize("group", [2_000, 6])
def test_jaccard_join(docs, rows, group):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for i, t, _ in rows:
        w = WORD.findall((t or "").translate(fold))
        sets.append((i, {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    wanted = sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))
    found = jaccard_join.jaccard_join(docs, group=group).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == wanted


def test_rows_without_an_id(spark):
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    docs = spark.createDataFrame([(None, a, 1), (7, a, 1), (None, b, 1), (None, None, 1), (8, b + " x", 1)], SCHEMA)
    joined = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs).select("doc_id", "n_shingles", "component_id").collect()}
    assert joined == {(None, 37, 7), (7, 37, 7), (None, 37, None), (None, 0, None), (8, 38, 8)}
    removed = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_dedup(docs).collect())
    assert removed == sorted([("7", len(a), 0), ("8", len(b) + 2, 0), ("None", len(a), len(a)), ("None", len(b), len(b)), ("None", 0, 0)])
    assert sorted((r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs, ["doc_id"]).collect()) == [(0, 0), (40, 40), (40, 40), (40, 40), (41, 40)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert not substring_dedup.substring_dedup(none, ["doc_id", "lang"]).collect()
    assert not suffix_dedup.suffix_dedup(none).collect()
    assert not jaccard_join.jaccard_join(none).collect()


def _thue_morse(n, a, b):
    return "".join((a, b)[bin(k).count("1") & 1] for k in range(n))


def test_words_that_polynomial_hashes_confuse(spark):
    """Thue-Morse strings and their complements meet under any polynomial modulo a power of two."""
    p, q = _thue_morse(2_048, "a", "b"), _thue_morse(2_048, "b", "a")
    rest = " ".join(f"w{k}" for k in range(34))
    docs = spark.createDataFrame([(1, f"{p} {rest}", 1), (2, f"{q} {rest}", 1)], SCHEMA)
    assert {r.n_removed for r in substring_dedup.substring_dedup(docs, ["doc_id"]).collect()} == {0}
    docs = spark.createDataFrame([(1, p, 1), (2, q, 1)], SCHEMA)
    assert {r.component_id for r in jaccard_join.jaccard_join(docs).collect()} == {1, 2}
    docs = spark.createDataFrame([(1, p[:128], 1), (2, q[:128], 1)], SCHEMA)
    shared = sum(q[k : k + 100] in p[:128] for k in range(29))
    assert sum(r.n_removed > 0 for r in suffix_dedup.suffix_dedup(docs).collect()) == (shared > 0)


def test_columns_named_like_results(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id long, text string, kept int, n_bytes int, N_REMOVED int")
    every = docs.columns
    assert substring_dedup.substring_dedup(docs, every).columns == ["doc_id", "n_bytes", "kept", "n_words", "n_removed"]
    assert suffix_dedup.suffix_dedup(docs, every).columns == ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    assert substring_dedup.substring_dedup(docs, every).first().kept == "a b"
    assert suffix_dedup.suffix_dedup(docs, every).first().n_bytes == 3


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    docs = spark.createDataFrame([(3, a, 1), (3, b, 2), (4, b, 3), (None, a, 4), (5, "", 5), (5, "", 6)], SCHEMA)
    kept = jaccard_join.first_of_each(docs, ["doc_id", "text", "lang"]).collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in kept) == [(3, b, 2), (3, a, 1), (5, "", 5), (5, "", 6)]


def test_all_cells_of_a_group_without_one_component(spark):
    """A group of texts that share rare shingles, in many components of two: every link is in a cell."""
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(12):
        text = words[:6] + [f"u{k}-{j}" for j in range(30 + 4 * k)]
        rows += [(2 * k, " ".join(text), 1), (2 * k + 1, " ".join([*text, f"end{k}"]), 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(docs, group=2).collect()}
    assert found == {k: k - k % 2 for k in range(24)}
