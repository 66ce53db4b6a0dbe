"""The pipeline's stages, each judged on its own input: planted rows, and brute force where a stage is exact."""

import collections
import random
import re

import pytest

P = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string"
LETTERLESS = {700, 701, 702}


def _corpus():
    rnd = random.Random(8)
    vocabulary = {lang: ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(300)] for lang, letters in (("en", "abcdefghij"), ("fr", "klmnopqrst"))}
    words = lambda lang, n: [rnd.choice(vocabulary[lang]) for _ in range(n)]
    rows, labels = {}, []
    for k in range(600):
        w = words("en" if k % 2 else "fr", 40)
        if k % 5 == 0:
            for i, term in zip(rnd.sample(range(40), 3), ["nastyword", "vileperson", "uglything"], strict=True):
                w[i] = term
        rows[k] = " ".join(w)
        labels.append((k, 1, int(k % 5 == 0)))
    rows |= {700: None, 701: "", 702: "12 34 !!"}
    base, passage = words("en", 120), words("en", 50)
    for k in range(4):
        rows[710 + k] = " ".join(base[: 20 * k + 10] + ["abc"] + base[20 * k + 11 :])
    for k in range(3):
        rows[720 + k] = rows[1]
    for k in range(2):
        rows[730 + k] = " ".join(words("en", 30) + passage + words("en", 30))
    docs = [(k, t, "fr" if k < 600 and k % 2 == 0 else "en", None if k % 7 == 0 else "src.example", len(t or ""), "x", None) for k, t in rows.items()]
    docs.append((None, " ".join(words("en", 40)), None, None, None, None, None))
    return docs + docs[730:732], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage got and returned, by the stage's name."""
    docs, labels = _corpus()
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, rows, folder).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out[name] = rows.collect(), after.collect(), after.columns
        rows = after
    return out


def test_columns(stages):
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go(stages):
    before, after, _ = stages["toxicity"]
    kept = {r.doc_id for r in after}
    assert len([k for k in range(0, 600, 5) if k in kept]) <= 3
    assert len([r for r in before if (r.doc_id is None or r.doc_id >= 600 or r.doc_id % 5) and r.doc_id not in kept]) <= 3
    assert LETTERLESS < kept and None in kept


def test_texts_in_no_language_go(stages):
    before, after, _ = stages["language ID"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == LETTERLESS
    assert all(r.lang == ("fr" if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 2 == 0 else "en") for r in after)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages["n-gram Jaccard join"]
    sets = {}
    for r in before:
        w = WORD.findall(r.text.lower())
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(k for k in sets if k is not None)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == [k for k in ids if find(k) == k]
    assert [r.text for r in after if r.doc_id is None] == [r.text for r in before if r.doc_id is None]
    assert 710 in ids and not {711, 712, 713, 720, 721, 722} & {r.doc_id for r in after}


def test_repeated_passages_go(stages):
    before, after, _ = stages["substring dedup"]
    words = [(r.doc_id, WORD.findall(r.text)) for r in before]
    count = collections.Counter(tuple(w[k : k + 35]) for _, w in words for k in range(len(w) - 34))
    wanted = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        if kept or not any(gone):
            wanted.append((str(i), kept, len(kept)))
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in after) == sorted(wanted)
    assert {len(r.text.split()) for r in after if r.doc_id in (730, 731)} == {60}


def test_every_token_is_packed_once(stages):
    from tokenizers import Tokenizer

    before, after, _ = stages["best-fit packing"]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert sum(r.length for r in after) == sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in before)
    ends = collections.defaultdict(int)
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
    assert len(ends) <= 1.05 * sum(ends.values()) / 2048 + 1


def _run(spark, folder, docs, labels):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return pipeline.run(spark, str(folder))


def test_an_empty_table(spark, tmp_path):
    assert not _run(spark, tmp_path, [], []).collect()


def test_ids_that_rows_share_and_a_very_long_text(spark, tmp_path):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, long = [text(60), text(60), text(60)], text(200_000)
    docs = [(5, t, "en", None, 1, None, None) for t in shared] + [(5, shared[0], "en", None, 1, None, None), (6, long, "en", None, 1, None, None)]
    packed = _run(spark, tmp_path, docs + [(k, text(50), "en", None, 1, None, None) for k in range(100, 130)], []).collect()
    assert sum(r.doc_id == 5 and r.piece == 0 for r in packed) == 3
    assert sum(r.length for r in packed if r.doc_id == 6) > 200_000
