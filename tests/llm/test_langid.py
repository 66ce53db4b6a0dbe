"""Language ID beyond a handful of languages, and texts in none of them."""

import math
import random
import re

import numpy as np
import pytest

from ledgerline.llm import langid

N = 70


def _words(seed, n=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(n)]


@pytest.fixture(scope="module")
def found(spark):
    rnd = random.Random(1)
    text = lambda words, n=30: " ".join(rnd.choice(words) for _ in range(n))
    names = [f"{'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}" for k in range(N)]
    train = [(text(_words(k)), names[k]) for k in range(N) for _ in range(12)]
    rows = [(k, text(_words(k)), None, "h.example") for k in range(N)]
    rows += [(100, text(_words(999)), names[3], "h.example"), (101, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200)), None, None)]
    model = langid.train(spark.createDataFrame(train, "text string, lang string"))
    docs = spark.createDataFrame(rows, "id long, text string, declared string, host string")
    result = langid.identify(docs, ["id"], model, docs["text"], docs["declared"], docs["host"])
    return names, model, {r.id: r for r in result.collect()}


def test_every_labelled_language_is_trained(found):
    names, model, rows = found
    assert model[0] == names
    assert [(rows[k].lang, rows[k].text_lang) for k in range(N)] == [(x, x) for x in names]
    assert all(rows[k].confidence > 0.9 for k in range(N))


def test_a_text_in_no_language_has_none(found):
    _, _, rows = found
    assert [(rows[k].lang, rows[k].text_lang, rows[k].confidence) for k in (100, 101)] == [(None, None, 0.0)] * 2


def test_another_script_is_no_language_and_a_mixed_text_is_one(spark):
    rnd = random.Random(2)
    text = lambda k, n=100: " ".join(rnd.choice(_words(k)) for _ in range(n))
    model = langid.train(spark.createDataFrame([(text(k), "ab"[k]) for k in (0, 1) for _ in range(100)], "text string, lang string"))
    docs = spark.createDataFrame([(1, "слово за словом и ещё одно " * 5, "a"), (2, text(0, 25) + " " + text(1, 20), None)], "id long, text string, declared string")
    rows = {r.id: r for r in langid.identify(docs, ["id"], model, docs["text"], docs["declared"], docs["declared"]).collect()}
    assert (rows[1].lang, rows[1].text_lang) == (None, None)
    assert rows[2].text_lang == "a"


WORDS = {"en": "the and of that with this from", "fr": "les une des avec pour dans sur", "de": "der die und nicht mit von das"}


@pytest.fixture(scope="module")
def trained(spark):
    rnd = random.Random(11)
    rows = [(" ".join(rnd.choices(w.split(), k=12)), k) for k, w in WORDS.items() for _ in range(60)]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def _pages():
    rnd = random.Random(12)
    rows = []
    for k in range(60):
        lang = rnd.choice(list(WORDS))
        host = rnd.choice(["a.example.fr", "b.example.fr", "www.news.de", "shop.news.de", "x.org", ""])
        text = " ".join(rnd.choices(WORDS[lang].split(), k=rnd.choice([1, 3, 12])))
        rows.append((k, f"http://{host}/{k}" if host else None, f'<html lang="{rnd.choice([lang, lang, "fr", "xx"])}"><p>{text}</p>' if rnd.random() < 0.8 else f"<p>{text}</p>"))
    rows += [(100, "http://c.example.fr/", None), (101, "http://new.fr/", "<p>123</p>"), (102, "http://a.example.fr/9", ""), (103, None, '<html lang="de">'), (104, None, None), (105, "http://x.org/" + "y" * 3_000, "<p>" + "the and of " * 100_000), (0, rows[0][1], rows[0][2])]
    return rows


def test_fusion_against_its_definition(spark, trained):
    """Counts, smoothing, leaving out a row's own text and the product, row by row."""
    names, table = trained
    n, rows = len(names), []
    for page_id, url, html in _pages():
        text = re.sub(r"<[^>]*>", " ", html or "").encode()
        bins = [int(b) for b in langid._trigrams(np.frombuffer(text, np.uint8)) if b >= 0] if len(text) > 2 else []
        lik = [sum(float(table.bins[b, k]) for b in bins) * min(len(bins), langid.EFFECTIVE) / len(bins) for k in range(n)] if bins else None
        host = (re.match(r"http://([^/]+)", url or "") or [None, None])[1]
        declared = (re.search(r'lang="(\w+)"', html or "") or [None, None])[1]
        rows.append({"id": page_id, "lik": lik, "best": lik.index(max(lik)) if lik else None, "host": host, "domain": ".".join(host.split(".")[-2:]) if host else None, "suffix": host.split(".")[-1] if host else None, "declared": declared})
    counts: dict = {}
    for r in rows:
        for level in ("host", "domain", "suffix", "declared"):
            c = counts.setdefault((level, r[level]), [0.0] * n)
            if r["best"] is not None:
                c[r["best"]] += 1
    every = [float(sum(r["best"] == k for r in rows)) for k in range(n)]
    wanted = {}
    for r in rows:
        own = lambda level: [max(0.0, x - (r["best"] == k)) for k, x in enumerate(counts[level, r[level]])] if r[level] else [0.0] * n  # noqa: B023, E731
        p = [(x + 1) / (sum(every) + n) for x in every]
        for level in ("domain", "host"):
            x = own(level)
            p = [(a + langid.STRENGTH * b) / (sum(x) + langid.STRENGTH) for a, b in zip(x, p, strict=True)]
        logs = [a + math.log(b) for a, b in zip(r["lik"] or [0.0] * n, p, strict=True)]
        for level in ("declared", "suffix"):
            if r[level]:
                logs = [a + math.log((x + 0.5) / (e + 1)) for a, x, e in zip(logs, own(level), every, strict=True)]
        top = max(logs)
        some = r["lik"] or r["host"] or r["declared"]
        wanted.setdefault(r["id"], []).append((names[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs)) if some else (None, 0.0))
    found: dict = {}
    for r in langid.identify_pages(spark.createDataFrame(_pages(), "page_id long, url string, html string"), trained).collect():
        found.setdefault(r.page_id, []).append((r.lang, r.confidence))
    assert found.keys() == wanted.keys()
    for k in wanted:
        assert [x for x, _ in found[k]] == [x for x, _ in wanted[k]]
        assert [y for _, y in found[k]] == pytest.approx([y for _, y in wanted[k]], rel=1e-4, abs=1e-6)


def test_host_and_suffix_decide_alone(spark, trained):
    text = {k: f"<p>{w} {w}</p>" for k, w in WORDS.items()}
    rows = [(k, f"http://a.site.fr/{k}", text["fr"]) for k in range(20)] + [(k, f"http://b.org/{k}", text["de"]) for k in range(20, 40)] + [(k, f"http://n{k}.uk/", text["en"]) for k in range(40, 60)]
    rows += [(90, "http://a.site.fr/x", "<p>1</p>"), (91, "http://c.site.fr/x", None), (92, "http://b.org/x", ""), (93, "http://other.uk/x", None)]
    found = {r.page_id: r.lang for r in langid.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), trained).collect()}
    assert (found[90], found[91], found[92], found[93]) == ("fr", "fr", "de", "en")


def test_no_pages(spark, trained):
    assert not langid.identify_pages(spark.createDataFrame([], "page_id long, url string, html string"), trained).collect()
