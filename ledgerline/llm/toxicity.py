"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, with scores in context.

Terms that occur far more often in documents labelled toxic than in others are learned from
labelled rows: words, and beginnings of words, for languages that build words from stems. A
document's words are looked up; a word that is no term runs through its Levenshtein automaton
(distance one, two swapped letters are one error), intersected with the lexicon's trie, which catches
misspelled terms; digits and signs inside a word are letters of it. A misspelled term of four letters
counts only beside another hit, one of three never. Each hit counts in its context, a window of words:
hits that stand in quotation (between an opening and a closing mark, or after a word of saying) are counted
apart from plain ones, and hits that stand close together add up. An apostrophe inside a word is no mark. A logistic regression turns the counts into a score.

Labels are learned from a bounded sample: TOXIC_ROWS and CLEAN_ROWS at most, the least by a hash
of the id. Two thirds of it give the terms (all with enough evidence; each is in three toxic rows of the
sample at least, which bounds them), the rest the regression's weights. Everything else
sees all rows and whole texts.

Defined cases: null and empty text scores like a text without any term; without labels of both
kinds every document scores the share of toxic labels (0 without labels); several labels of one
document count as toxic if any does; repeated rows score alike; an empty table gives no rows;
extra columns of the labels are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import materialize

TOXIC_ROWS, CLEAN_ROWS = 6_000, 24_000
#: Least evidence (log likelihood ratio) for a term.
EVIDENCE = 30.0
#: Letters from which on a term may be misspelled, and from which on a misspelled one counts by itself.
FUZZY, ALONE = 4, 5
#: Lengths of word beginnings that may be terms; words in a context window on either side.
STEMS, CONTEXT = (4, 5, 6), 10
#: Score from which a document counts as toxic.
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W_]+(?:[@$*!][^\W_]+)*")
_MARK = "[\"'“”„‟«»‘’‹›]"
#: A mark that opens before a word, or closes behind one.
_MARKS = re.compile(rf"(?P<open>(?<!\w){_MARK}(?=\w))|(?<=\S){_MARK}(?!\w)")
# Words of saying that announce a quotation, in four languages.
_SAYING = frozenset("said says wrote writes quoted quote called calls called sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó".split())


class Trie:
    """The lexicon's whole words, letter by letter; a node is a dict, the key '' ends a word."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, word: str, distance: int) -> str | None:
        """A word of the trie within that edit distance. States of the word's Levenshtein automaton
        (letters read, errors so far) walk the trie together with its nodes (a letter wrong, missing, too
    many, or two swapped); a state that has
        used up its errors can only read on letter by letter."""
        open_ = [(self.root, 0, 0)]
        size = len(word)
        while open_:
            node, i, errors = open_.pop()
            if errors == distance:
                while i < size and node is not None:
                    node = node.get(word[i])
                    i += 1
                if node is not None and "" in node:
                    return node[""]
                continue
            if "" in node and size - i <= distance - errors:
                return node[""]
            if i < size:
                open_.append((node, i + 1, errors + 1))
                if i + 1 < size and (swapped := node.get(word[i + 1], {}).get(word[i])):
                    open_.append((swapped, i + 2, errors + 1))
            for c, child in node.items():
                if c:
                    if i < size:
                        open_.append((child, i + 1, errors + (c != word[i])))
                    open_.append((child, i, errors + 1))
        return None


@dataclass
class Model:
    """weights: of the regression, last the constant; terms, stems: evidence in log odds."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    share: float = 0.0


def _letters(word: str) -> int:
    """A bit for each letter (by its code modulo 64) that the word has."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


class Matcher:
    """Looks words up; words that are known to be no terms are kept, up to a bound."""

    KEPT = 200_000

    def __init__(self, model: Model):
        self.model = model
        fuzzy = [t for t in model.terms if len(t) >= FUZZY]
        self.trie = Trie(fuzzy)
        # a word at distance one keeps the first or the second half of its term, or those of the
        # term with its two middle letters swapped
        self.begins, self.ends = {}, {}
        for t in fuzzy:
            half, entry = len(t) // 2, (t, len(t), _letters(t))
            swapped = t[: half - 1] + t[half] + t[half - 1] + t[half + 1 :]
            for x in {t[:half], swapped[:half]}:
                self.begins.setdefault(x, []).append(entry)
            for x in {t[half:], swapped[half:]}:
                self.ends.setdefault(x, []).append(entry)
        self.begin_sizes, self.end_sizes = (tuple(sorted({len(x) for x in d})) for d in (self.begins, self.ends))
        self.stem_lengths = sorted({len(s) for s in model.stems}, reverse=True)
        self.none: set[str] = set()

    def _near(self, word: str) -> bool:
        """Whether the automaton of the word can accept a term at all: the far end of the word is
        the term's too, or all else is, and at most one letter is more and one less."""
        size, letters = len(word), None
        for n in self.begin_sizes:
            for t, m, mask in self.begins.get(word[:n], ()):
                if -2 < m - size < 2 and (word[-1] == t[-1] or word[:-1] == t[:-1] or word[:-1] == t or word == t[:-1] or word[-2:] == t[: -3 : -1]):
                    letters = letters or _letters(word)
                    if (letters & ~mask).bit_count() < 2 and (mask & ~letters).bit_count() < 2:
                        return True
        for n in self.end_sizes:
            for t, m, mask in self.ends.get(word[-n:], ()):
                if -2 < m - size < 2 and (word[0] == t[0] or word[1:] == t[1:] or word[1:] == t or word == t[1:] or word[:2] == t[1::-1]):
                    letters = letters or _letters(word)
                    if (letters & ~mask).bit_count() < 2 and (mask & ~letters).bit_count() < 2:
                        return True
        return False

    def look_up(self, word: str) -> tuple[int, float] | None:
        """(kind, log odds): kind 0 for a term, 1 for a stem, 2 for a misspelled term, 3 for one that needs
        another hit beside it."""
        m = self.model
        if word in m.terms:
            return 0, m.terms[word]
        for n in self.stem_lengths:
            if len(word) > n and word[:n] in m.stems:
                return 1, m.stems[word[:n]]
        if len(word) > 3 and self._near(word):
            term = self.trie.within(word, 1)
            if term:
                return 2 if len(term) >= ALONE else 3, m.terms[term]
        if len(self.none) < self.KEPT:
            self.none.add(word)
        return None


N_FEATURES = 9
_matchers: dict = {}


def features(text: str, matcher: Matcher) -> list[float]:
    """Counts of hits by kind and context, for the regression."""
    lower = text.lower()
    words = _WORD.findall(lower)
    found = {w: hit for w in set(words).difference(matcher.none) if (hit := matcher.look_up(w))}
    if all(k == 3 for k, _ in found.values()):
        return [0.0] * (N_FEATURES - 1) + [math.log1p(len(words))]
    at = [i for i, w in enumerate(words) if w in found]
    spans = [m.span() for m in _WORD.finditer(lower)]
    plain = quoted = strong = 0.0
    for i in at:
        a, b = max(0, i - CONTEXT), min(len(words) - 1, i + CONTEXT)
        before = list(_MARKS.finditer(lower, max(0, spans[a][0] - 1), spans[i][0] + 1))
        after = _MARKS.search(lower, spans[i][1] - 1, spans[b][1] + 1)
        says = before and before[-1]["open"] and after and not after["open"] or not _SAYING.isdisjoint(words[a:i])
        if says:
            quoted += 1
        else:
            plain += 1
            strong = max(strong, found[words[i]][1])
    near = max(np.searchsorted(at, np.array(at) + 2 * CONTEXT, "right") - np.arange(len(at)))
    kinds = [sum(1 for k, _ in found.values() if k == kind or kind == 2 and k == 3) for kind in range(3)]
    return [float(x) for x in (kinds[0], kinds[1], kinds[2])] + [strong, math.log1p(plain), math.log1p(quoted), math.log1p(float(near)), sum(w for _, w in found.values()) / (1 + math.log1p(len(words))), math.log1p(len(words))]


def _shape(x: np.ndarray) -> np.ndarray:
    return np.hstack([np.log1p(x[:, :3]), x[:, 3:], np.ones((len(x), 1))])


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Rows that the labels' use leaves for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Learns from the labels of documents that are not held out."""
    spark = docs.sparkSession
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    parts = [usable.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(n) for k, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = materialize(parts[0].unionByName(parts[1]))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1)))
    # at most toxic_rows + clean_rows rows
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))))
    counts = {(r["toxic"], r["part"] > 0): r["n"] for r in sample.groupBy("toxic", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("toxic", (F.col("part") > 0).cast("int").alias("part")).agg(F.sum("n").alias("n")).collect()}
    total = {k: counts.get((k, True), 0) + counts.get((k, False), 0) for k in (0, 1)}
    model = Model(share=total[1] / max(1, total[0] + total[1]))
    if not all(counts.get((k, half), 0) for k in (0, 1) for half in (False, True)):
        return model
    p_all, n_all = counts[1, True], counts[0, True]
    # copies and near copies of one text are no evidence of their own
    distinct = sample.filter("part > 0").withColumn("words", words).dropDuplicates(["words"])
    entries = F.flatten(F.array(F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(False).alias("stem"))), *(F.array_distinct(F.transform(F.filter("words", lambda w, n=n: F.length(w) > n), lambda w, n=n: F.struct(F.substring(w, 1, n).alias("term"), F.lit(True).alias("stem")))) for n in STEMS)))
    seen = distinct.select("toxic", F.explode(entries).alias("e")).groupBy("e.term", "e.stem").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
    share = p_all / (p_all + n_all)
    p, n = F.col("p"), F.col("n")
    logs = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    evidence = 2 * (logs(p, (p + n) * share) + logs(n, (p + n) * (1 - share)))
    odds = F.log((p + 0.5) / (p_all + 1)) - F.log((n + 0.5) / (n_all + 1))
    found = seen.filter((F.length("term") >= 3) & (p >= 3)).select("term", "stem", odds.alias("odds"), evidence.alias("evidence")).filter((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= 2))
    top = found.collect()  # bounded by the sample's words
    model.stems = {r["term"]: r["odds"] for r in top if r["stem"]}
    model.terms = {r["term"]: r["odds"] for r in top if not r["stem"]}
    x = sample.filter("part = 0").select("doc_id", "text", "toxic")
    rows = _features(x, model, ["toxic"]).collect()  # bounded by the sample
    y = np.array([r["toxic"] for r in rows], float)
    model.weights = _regression(_shape(np.array([r["_features"] for r in rows])), y).tolist()
    return model


def _features(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """columns, and features (a list of numbers) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    fields = [*(docs.schema[c] for c in columns), T.StructField("_features", T.ArrayType(T.DoubleType()))]
    schema = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _matchers.get("model") != shared.value:  # kept from task to task
            _matchers.update(model=shared.value, matcher=Matcher(shared.value))
        matcher = _matchers["matcher"]
        for batch in batches:
            values = [features(t.as_py() or "", matcher) for t in batch.column(text)]
            yield from pa.table([*(batch.column(c) for c in columns), pa.array(values, pa.list_(pa.float64()))], names=[f.name for f in fields]).cast(schema).to_batches()

    return docs.select(*dict.fromkeys([*columns, text])).mapInArrow(run, T.StructType(fields))


def score(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """columns (which may hold the text), score (0 to 1) and predicted (1 from THRESHOLD on).
    These two take the place of carried columns of their names."""
    columns = [c for c in columns if c not in ("score", "predicted")]
    if not model.weights:
        scored = docs.select(*columns, F.lit(float(model.share)).alias("score"))
    else:
        x = F.col("_features")
        shaped = [F.log1p(x[i]) if i < 3 else x[i] for i in range(N_FEATURES)]
        z = F.lit(model.weights[-1])
        for w, v in zip(model.weights, shaped, strict=False):
            z = z + F.lit(w) * v
        scored = _features(docs, model, columns, text).select(*columns, (1 / (1 + F.exp(-z))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return score(docs, fit(docs, labels), ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
