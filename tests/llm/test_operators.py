"""The other operators: against the library or brute force, held-out accuracy, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, chroma, html_text, langid, packing, topk, toxicity

P = pytest.importorskip("public_tokenizers")
TEXTS = [None, "", "  \n", "don't <|endoftext|>x Ⅻ ΑΣ é é a\x1cb\x1d c　d 😀 don't'll 123", "the  THE the", "word " * 3_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "src0", 1) for k, t in enumerate(TEXTS)] + [(9, "the", "en", "src0", 1)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, piece int")


def test_bpe(docs):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    found = {(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.bpe_round_trip(docs, ["doc_id"], path).collect()}
    wanted = set()
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        wanted.add((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    assert found == wanted


def test_packing(spark):
    """Ids, pieces, starts and checksums against the library; places against their definition."""
    import zlib

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [*TEXTS, "the", "the", "\n \xa0 \xa0", "long " * 3_000 + "é" * 500, "long " * 3_000 + "é" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = set()
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(len(ids), 2048)
        at = [0, *range(first, len(ids), 2048)]
        wanted |= {(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(at, [*at[1:], len(ids)], strict=True))}
    rows = packing.best_fit_packing(docs).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == wanted and len(rows) == len(wanted)
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1 + packing.least_sequences({n: sum(x[3] == n for x in wanted) for n in {x[3] for x in wanted}}, 2048)


def test_packed_words_are_the_librarys():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t, encode = Tokenizer.from_file(path), packing._Encoder(path, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rnd = random.Random(8)
    parts = [" ", " ", "\n", "\t", "\r", "\xa0", "\x1c", "\x85", "\u2003", "\u3000", "\x0b", "\u200b", "a", "don't", "'s", "!", "12", "é", "e\u0301", "😀", "<|endoftext|>", "word", "\ufeff"]
    for _ in range(6_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14)))
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    long = " ".join(rnd.choice(parts) for _ in range(400_000))
    assert np.frombuffer(encode(long), "<u4").tolist() == t.encode(long, add_special_tokens=False).ids


@pytest.mark.parametrize(("some", "most", "over"), [(300, 60, 1.03), (1_800, 12, 1.002), (1_200, 400, 1.02)])
def test_packing_needs_few_sequences(some, most, over):
    rnd = random.Random(2)
    histogram = {min(n, 2_048): rnd.randrange(1, most) for n in (int(rnd.expovariate(1 / 400)) + 1 for _ in range(some))}
    plan = packing.solve_configurations(histogram, 2048)
    used: dict = {}
    for config, times in plan:
        assert sum(n * k for n, k in config.items()) <= 2048
        for n, k in config.items():
            used[n] = used.get(n, 0) + k * times
    assert used == histogram
    assert sum(times for _, times in plan) <= over * packing.least_sequences(histogram, 2048) + 1
    assert packing.solve_configurations({}, 2048) == []
    demand = np.zeros(2049, np.int64)
    demand[list(histogram)] = list(histogram.values())
    assert sum(times for _, times in plan) <= sum(times for _, times in packing.best_fit_decreasing(demand, 2048))


def _plain_best_fit(pieces, capacity):
    rooms: list[int] = []
    for n in sorted(pieces, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - n)
    return sorted(rooms)


def test_packing_against_best_fit_and_the_bound():
    rnd = random.Random(4)
    for k in range(60):
        capacity = rnd.choice([7, 20, 64])
        pieces = [rnd.randrange(1, capacity + 1) if k % 2 else rnd.randrange(capacity // 4, capacity // 2 + 1) or 1 for _ in range(rnd.randrange(1, 120))]
        demand = np.bincount(pieces, minlength=capacity + 1)
        rest = packing.best_fit_decreasing(demand, capacity)
        rooms = sorted(r for config, times in rest for r in [capacity - sum(n * m for n, m in config.items())] * times)
        assert rooms == _plain_best_fit(pieces, capacity)
        report: list = []
        plan = packing.solve_configurations({n: int(demand[n]) for n in set(pieces)}, capacity, report)
        used = np.zeros(capacity + 1, int)
        for config, times in plan:
            assert sum(n * m for n, m in config.items()) <= capacity and times > 0
            for n, m in config.items():
                used[n] += m * times
        assert (used == demand).all()
        assert report[0]["bound"] - 1e-6 <= sum(times for _, times in plan) <= len(rooms)


def test_the_program_beats_best_fit_on_thirds():
    """Best-fit decreasing joins two long thirds and leaves a hole; the program finds the triples."""
    histogram = {n: 20 + n % 7 for n in range(600, 760)}
    demand = np.zeros(2049, np.int64)
    demand[list(histogram)] = list(histogram.values())
    ours = sum(times for _, times in packing.solve_configurations(histogram, 2048))
    assert ours < 0.95 * sum(times for _, times in packing.best_fit_decreasing(demand, 2048))
    assert ours <= 1.02 * packing.least_sequences(histogram, 2048)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 50)
    rng = np.random.default_rng(1)
    vectors = [(k, [float(x) for x in rng.normal(size=8)], k) for k in range(300)] + [(k, [0.5] * 8, 0) for k in range(300, 360)]
    odd = [(400, None, 0), (420, [None] * 8, 0), (440, [float("nan")] * 8, 0), (460, [float("inf")] * 8, 0)]
    found = topk.top_k(spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>, score int")).collect()
    m = np.floor(64 * np.array([v for _, v, _ in vectors], np.float32).astype(float)).astype(int)
    wanted = set()
    for q in range(0, 360, 20):
        s = m @ m[q]
        best = [j for j in np.lexsort((np.arange(360), -s)) if j != q][:20]
        wanted |= {(q, r + 1, int(j), int(s[j])) for r, j in enumerate(best)}
    assert {tuple(r) for r in found} == wanted


def test_top_k_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    with pytest.raises(ValueError, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [1e30])], schema))
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0]), (1, [1.0]), (2, []), (None, [9.0]), (3, [1e7, 1.0])]
    found = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, schema)).collect()))
    # both rows with the id 0 ask, and meet all others; their answers share the query's ranks
    assert [r[3] for r in found] == sorted([64 * 64 * 10**7 + 128 * 64] * 2 + [64 * 64] * 4 + [0] * 2, reverse=True)[: len(found)] and len(found) == 8


PAGES = [
    ("<html><head><title>T</title></head><body><nav><a>Menu</a></nav><article><h1>A &amp; B</h1><p>One<br>two\n three<p>Four</article><footer>F</footer>", "A & B\n\nOne two three\n\nFour"),
    ("<body><div class='cookie-notice'>We use</div><main><p>Text &eacute;</p><aside>Side</aside><div id=comments><p>no</p></div><p>End</main>", "Text é\n\nEnd"),
    ("<article><script>var t='</p>';</script><style>p{}</style><p>x</p><form><p>y</p></form><p class=ad>z<p>w</article>", "x\n\nw"),
    (None, ""),
    ("", ""),
    ("<div>" + "long text " * 20 + "</div><div>short</div><div></div>", ("long text " * 20).strip() + "\n\nshort"),
]


def test_html(spark):
    rows = [(k, h, "u", 7) for k, (h, _) in enumerate(PAGES)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id int, html string, url string, text int")).collect()
    assert {r.page_id: (r.text, r.n_chars) for r in found} == {k: (t, len(t)) for k, (_, t) in enumerate(PAGES)}


def _toxic_corpus():
    rnd = random.Random(4)
    plain = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for k in range(900):
        words = [rnd.choice(plain) for _ in range(40)]
        bad = k % 5 == 0
        if bad:
            for _ in range(3):
                words[rnd.randrange(40)] = rnd.choice(["nastyword", "vileperson", "uglything"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows_and_misspelled_terms(spark):
    rows, labels = _toxic_corpus()
    rows += [(2_000, None), (2_001, ""), (2_002, "such a nastywprd and a vileperso here")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, toxic string")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [r for r in found.values() if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.98
    assert found[2_000].predicted == found[2_001].predicted == 0
    assert found[2_002].score > found[2_001].score


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).first().score == 0


def _distance(a, b):
    """Edit distance with swaps of neighbours, by its definition."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton():
    terms = ["idiot", "clown", "scum", "vile"]
    trie = toxicity.Trie(terms)
    assert [trie.within(w, 1) for w in ("idiot", "idoit", "idiott", "idot", "xdiot", "clwn", "frown", "iodit")] == ["idiot", "idiot", "idiot", "idiot", "idiot", "clown", None, None]
    matcher = toxicity.Matcher(toxicity.Model({t: 5.0 for t in terms}, {}, []))
    rnd = random.Random(6)
    words = {"".join(rnd.choice("idotclwnsumve1") for _ in range(rnd.randrange(4, 7))) for _ in range(30_000)}
    words |= {t[:k] + c + t[k + 1 :] for t in terms for k in range(len(t)) for c in "xi1"} | {t[:k] + t[k + 1 : k + 2] + t[k : k + 1] + t[k + 2 :] for t in terms for k in range(len(t))}
    for w in words:
        near = min(_distance(w, t) for t in terms) <= 1
        assert (len(w) > 3 and matcher.look_up(w) is not None) == (len(w) > 3 and near), w


def test_contexts():
    matcher = toxicity.Matcher(toxicity.Model({"idiot": 5.0, "scum": 6.0}, {}, []))
    plain, quoted = (lambda t: round(toxicity.features(t, matcher)[4], 3)), (lambda t: round(toxicity.features(t, matcher)[5], 3))
    one = round(np.log1p(1), 3)
    for text in ("don't be an idiot, don't", "you idiot's friend", '"fine" you idiot "fine"', "an id1ot", "an idoit", "an i$diot"):
        assert (plain(text), quoted(text)) == (one, 0), text
    for text in ('he was "an idiot" there', "the word 'idiot' is bad", "„so ein idiot“ stand da", "she said idiot to him", "«un idiot» va"):
        assert (plain(text), quoted(text)) == (0, one), text
    assert toxicity.features("some scun", matcher)[2] == 0  # a misspelled short term alone
    assert toxicity.features("idiot and scun", matcher)[2] == 1


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame(_toxic_corpus()[1], "doc_id long, quality int, toxic int")
    assert not toxicity.toxicity(spark.createDataFrame([], "doc_id long, text string"), labels).collect()
    rows, _ = _toxic_corpus()
    long = (5_000, "plain words " * 200_000 + "nastyword")
    docs = spark.createDataFrame([*rows, rows[0], (None, "nastyword"), long], "doc_id long, text string")
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(rows) + 3 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == rows[0][0]}) == 1


def test_language(spark):
    words = {"en": "the and of that with this", "fr": "les une des avec pour dans"}
    rnd = random.Random(1)
    train = [(rnd.choice(words[k].split()) + " " + " ".join(rnd.sample(words[k].split(), 5)), k) for k in words for _ in range(50)]
    model = langid.train(spark.createDataFrame(train, "text string, lang string"))
    rows = [(1, "http://a.fr/x", '<html lang="fr-FR"><p>les une avec dans pour des</p>'), (2, "http://b.com/", '<html lang="fr"><p>the and of that with this the and of that</p>'), (3, None, None), (4, "http://a.fr/y", "<html lang=fr>12</html>")]
    found = {r.page_id: r for r in langid.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert (found[1].lang, found[2].lang, found[3].lang, found[4].lang) == ("fr", "en", None, "fr")
    assert found[3].confidence == 0


def test_chroma_aligns_a_shifted_noisy_copy(spark):
    rng = np.random.default_rng(3)
    tune = np.sin(2 * np.pi * np.cumsum(np.repeat(440 * 2 ** (rng.integers(-12, 12, 120) / 12), 512)) / chroma.RATE)
    audio = lambda x: (x * 20_000).astype("<i2").tobytes()
    other = np.sin(2 * np.pi * np.cumsum(np.repeat(440 * 2 ** (rng.integers(-12, 12, 120) / 12), 512)) / chroma.RATE)
    rows = [(1, audio(tune)), (2, audio(tune)), (3, audio(tune[4 * chroma.HOP :] + rng.normal(0, 0.0005, len(tune) - 4 * chroma.HOP))), (4, audio(other)), (5, None), (6, b"")]
    found = {r.id: r for r in chroma.align(chroma.fingerprints(spark.createDataFrame(rows, "id long, audio binary"), "id", "audio")).collect()}
    assert found[1].class_id == found[2].class_id == 1
    assert (found[1].n_links, found[3].n_links, found[3].best_class, found[3].offset) == (2, 2, 1, 4)
    assert found[4].n_links == found[5].n_links == found[6].n_links == 0


def _brute_links(prints):
    """All pairs of different fingerprints, by the definition of a link: {(a, b): (offset, bit error)}, a the shorter."""
    out = {}
    for i, a in prints.items():
        for j, b in prints.items():
            if a is None or b is None or a == b or (len(a), i) >= (len(b), j):
                continue
            hits: dict = {}
            for x, p in enumerate(a):
                for y, q in enumerate(b):
                    if p == q:
                        hits[y - x] = hits.get(y - x, 0) + 1
            if not hits:
                continue
            offset = max(hits, key=lambda o: (hits[o], -abs(o), -o))
            pairs = [(a[x], b[x + offset]) for x in range(len(a)) if 0 <= x + offset < len(b)]
            error = sum((p ^ q).bit_count() for p, q in pairs) / 32 / len(pairs)
            if hits[offset] >= -(-len(a) * 15 // 100) and 2 * len(pairs) >= len(a) and error <= chroma.ERRORS:
                out[i, j] = offset, error
    return out


def test_chroma_query_against_all_pairs(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(200)
    some = vectors.unionByName(vectors.filter("vec_id % 50 = 0").withColumn("vec_id", F.col("vec_id") + 100_001))
    prints = chroma.fingerprints(chroma.tones(some), "id", "audio")
    codes = {r.id: r.codes for r in prints.collect()}
    links = _brute_links(codes)
    assert any(o for o, _ in links.values()) and any(e for _, e in links.values())
    found = {r.id: r for r in chroma.align(prints).collect()}
    assert set(found) == set(codes)
    for i, r in found.items():
        same = [j for j in codes if j != i and codes[j] == codes[i] and codes[i] is not None]
        mine = {(b if a == i else a): ((o if a == i else -o), e) for (a, b), (o, e) in links.items() if i in (a, b)}
        assert r.class_id == min([i, *same])
        assert r.n_links == len(same) + len(mine)
        if mine:
            assert round(min(e for _, e in mine.values()), 9) == round(r.bit_error, 9)
            assert r.offset in {o for j, (o, e) in mine.items() if round(e, 9) == round(r.bit_error, 9)}
    planted = [i for i in codes if i < 0]
    caught = sum(found[i].n_links > 0 and -i - 1 in {j for p in links for j in p if i in p} for i in planted)
    assert caught >= 0.8 * len(planted)


def test_chroma_odd_rows(spark):
    silence, long = b"\0\0" * 20_000, (np.sin(np.arange(2_000_000) / 9) * 9_000).astype("<i2").tobytes()
    rows = [(1, silence), (1, silence), (2, silence), (3, long), (4, b"x"), (None, silence)]
    found = chroma.align(chroma.fingerprints(spark.createDataFrame(rows, "id long, audio binary"), "id", "audio")).collect()
    assert len(found) == 6 and {r.n_links for r in found if r.class_id == 1} == {3}
    none = spark.createDataFrame([], "id long, audio binary")
    assert not chroma.align(chroma.fingerprints(none, "id", "audio")).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert not bpe.bpe_round_trip(none, ["doc_id"], P.path("word_bpe_49k.json")).collect()
    assert not packing.best_fit_packing(none).collect()
    assert not topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect()
    assert not html_text.extract(spark.createDataFrame([], "page_id long, html string")).collect()
    assert langid.train(none)[0] == []
