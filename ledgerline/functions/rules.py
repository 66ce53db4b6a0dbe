"""Rule sets of words, all matched in one pass over a text by one automaton.

The words of all rules make one Aho-Corasick automaton, built once in each worker. A text is read once, however
many rules and words there are; a match may ask for a word boundary on either side. Of the rules
that match, the first one counts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.columns import col


@dataclass(frozen=True)
class Word:
    """A word as it is written in the text; before, after: no letter, digit or underscore may stand next to it there."""

    text: str
    before: bool = False
    after: bool = False


def whole(text: str) -> Word:
    return Word(text, True, True)


@dataclass(frozen=True)
class Rule:
    label: str
    score: int
    words: tuple[Word, ...]


# Kinds of entities by words of their names in upper case, in the order in which they are tried.
ENTITY_RULES = (
    Rule("Sociedad de Garantía Recíproca", 100, (whole("SGR"), Word("GARANTIA RECIPROCA"))),
    Rule("Fondo Común de Inversión", 100, (Word("FONDO"), whole("FCI"))),
    Rule("Fideicomiso", 100, (Word("FIDEICOMISO"),)),
    Rule("Banco", 100, (whole("BANCO"),)),
    Rule("Aseguradora", 100, (Word("SEGUROS"), Word("ASEGURAD"))),
    Rule("Mercado", 100, (Word("MERCADO"),)),
    Rule("ALyC / Valores", 95, (Word("VALORES"), Word("SECURITIES"), Word("BROKER"))),
    Rule("Sociedad Gerente", 100, (Word("SOCIEDAD GERENTE"), Word("GERENTE"))),
    Rule("PyME", 90, (Word("PYME"), Word("PYMES"))),
    Rule("Cooperativa", 100, (Word("COOPERATIVA"),)),
    Rule("Empresa S.A.", 70, (whole("S.A"), Word("S.A.", before=True))),
)
NO_RULE = ("Sin clasificar", 0)
# Words of lines that describe an issuer.
LINE_WORDS = ("tipo", "especie", "mercado", "régimen", "regimen", "categoria", "categoría", "emisor", "sector", "actividad", "industria", "bolsa", "panel", "cotiza", "acciones", "ticker")


def _automaton(rules: tuple[Rule, ...]):
    import ahocorasick

    held: dict[str, list[tuple[int, Word]]] = {}
    for k, rule in enumerate(rules):
        for w in rule.words:
            held.setdefault(w.text, []).append((k, w))
    made = ahocorasick.Automaton()
    for text, uses in held.items():
        made.add_word(text, (len(text), uses))
    made.make_automaton()
    return made


def _solid(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def first_rule(automaton, text: str) -> int | None:
    """Number of the first rule with a word in the text."""
    best = None
    for end, (n, uses) in automaton.iter(text):
        for k, w in uses:
            if (best is None or k < best) and not (w.before and _solid(text, end - n) and _solid(text, end - n + 1)) and not (w.after and _solid(text, end + 1) and _solid(text, end)):
                best = k
        if best == 0:
            break
    return best


def classified(text: Column | str, rules: tuple[Rule, ...] = ENTITY_RULES, other: tuple[str, int] = NO_RULE) -> Column:
    """struct(label, score) of the first rule with a word in the upper-case text; `other` if none has, also for NULL."""

    @F.pandas_udf("label string, score int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(rules)
        for batch in batches:
            found = [None if x is None else first_rule(automaton, x) for x in batch]
            yield pd.DataFrame({"label": [other[0] if k is None else rules[k].label for k in found], "score": [other[1] if k is None else rules[k].score for k in found]})

    return run(F.upper(col(text)))


def keyword_classified(text: Column | str, allowed: list[str], denied: list[str]) -> Column:
    """1 if the text has a word of the first list, else 0 if of the second, else NULL; case is ignored."""
    found = classified(text, (Rule("allowed", 1, tuple(map(Word, allowed))), Rule("denied", 0, tuple(map(Word, denied)))), ("", -1))
    return F.when(found["score"] >= 0, found["score"])


def lines_with(automaton, text: str, least: int = 3) -> list[str]:
    """Lines with one of the words, in order, white space collapsed; lines of fewer than `least` characters don't count."""
    lines, lower = text.splitlines(), text.lower().splitlines()
    starts, at = [], 0
    for x in lower:
        starts.append(at)
        at += len(x) + 1
    hits = dict.fromkeys(bisect_right(starts, end) - 1 for end, _ in automaton.iter("\n".join(lower)))
    cleaned = (" ".join(lines[k].split()) for k in sorted(hits))
    return [x for x in cleaned if len(x) >= least]


def matching_lines(text: Column | str, words: tuple[str, ...] = LINE_WORDS) -> Column:
    """The lines of a text with any of the words, whatever their case; none for NULL."""
    rules = (Rule("line", 1, tuple(Word(w.lower()) for w in words)),)

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(rules)
        for batch in batches:
            yield pd.Series([[] if x is None else lines_with(automaton, x) for x in batch], dtype=object)

    return run(col(text))
