"""Words that are written to have one key under the salts of the source: they must not meet in a run."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import jaccard_join, rolling, substring_dedup

ONES = np.uint64(2**64 - 1)


def _unshift(x, k):
    out = x
    for _ in range(64 // k + 1):
        out = x ^ out >> np.uint64(k)
    return out


def _unmix(x):
    x = _unshift(x, 33)
    x = x * np.uint64(pow(0x81DADEF4BC2DD44D, -1, 2**64))
    x = _unshift(x, 27)
    x = x * np.uint64(pow(0x7FB5D329728EA185, -1, 2**64))
    return _unshift(x, 31)


def _colliding(word: bytes) -> bytes:
    """Another word of 16 bytes with the first key of `word`, by solving for the last 8 bytes."""
    s0 = rolling._SALTS[0][0]
    length = rolling.mix(np.array([16], np.uint64) + rolling._SALTS[0][1])
    a, last = (np.frombuffer(word[k : k + 8], "<u8") for k in (0, 8))
    key = rolling.pair(length, a)
    rnd = np.random.default_rng(3)
    letters = rnd.integers(97, 123, (400_000, 8), dtype=np.uint8)
    first = letters.view("<u8").ravel()
    wanted = rolling.mix(last + s0) ^ key ^ rolling.pair(np.repeat(length, len(first)), first)
    end = (_unmix(wanted) - s0).astype("<u8").view(np.uint8).reshape(-1, 8)
    good = np.flatnonzero(((end > 32) & (end < 127) & ~((end >= 65) & (end <= 90))).all(1))
    return letters[good[0]].tobytes() + end[good[0]].tobytes()


def _key(word: str, **salts):
    return int(rolling.Words(*rolling.text_buffer(pa.array([word])), **salts).lane(0)[0])


@pytest.fixture(scope="module")
def pairs():
    return [("abcdefghijklmnop", "z1gi3v7jg7aj_eoy"), ("abcdefghijklmnop", _colliding(b"abcdefghijklmnop").decode())]


def test_the_pairs_meet_under_the_salts_of_the_source_only(pairs):
    for a, b in pairs:
        assert a != b and _key(a) == _key(b)
        salts = rolling.fresh_salts()
        assert _key(a, salts=salts) != _key(b, salts=salts)


def test_different_words_do_not_link(spark, pairs):
    rows = [(k, w) for k, w in enumerate(dict.fromkeys(w for p in pairs for w in p))] + [(10, "abcdefghijklmnop")]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 10: 0}


def test_different_windows_are_not_repeated(spark, pairs):
    text = "w " * 20 + "{} " + "w " * 20
    rows = [(k, text.format(w)) for k, w in enumerate(pairs[1])]
    assert [r["n_removed"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()] == [0, 0]


def test_long_words_are_salted_too():
    a, b = rolling.fresh_salts(), rolling.fresh_salts()
    assert _key("x" * 300, salts=a) == _key("x" * 300, salts=a) != _key("x" * 300, salts=b)
