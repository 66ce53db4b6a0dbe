"""Column expressions that read financial statements as text: amounts by label or code, scale,
period, file names, addresses and links."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.columns import col

#: Characters between a label and its first amount at most.
REACH = 30
# Words that tell the scale, and that a statement is an interim one.
SCALES = {1_000: ("in thousands", "in miles", "thousands of", "miles de"), 1_000_000: ("in millions", "in millones", "millions of", "millones de")}
INTERIM = ("three-month", "three month", "quarter", "condensed interim")
# Months by name, in English and Spanish.
MONTHS = {"january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12}
MESES = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
# Names of statement files, and of pages that lead to them.
STATEMENT_FILE = r"(?i)eeff|estado.?contab|estados?.?financ|estado.?de.?situaci|balance|trimestr|memoria.?y.?estados|informaci[oó]n.?contable"
STATEMENT_PAGE = r"(?i)estado|contab|financ|balance|invers"
# What a page is searched for, by name.
PAGE_FINDS = {
    "uuid": r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    "url": r"(?i)https?://[^\"]+",
    "path": r"/[A-Za-z0-9]+/[A-Za-z0-9_\-]+",
    "ajax": r"(?s)\$\.ajax\((.*?)\)",
    "fetch": r"(?s)fetch\((.*?)\)",
    "xhr": r"XMLHttpRequest",
    "service": r"(?i)[A-Za-z0-9/_\-.]+\.(?:svc|asmx|ashx)",
    "json": r"(?i)[A-Za-z0-9/_\-.]+\.json",
    "script": r"(?i)<script[^>]*src=\"([^\"]+)\"",
    "link": r"(?i)<link[^>]*href=\"([^\"]+)\"",
    "window": r"window\.[A-Za-z0-9_\.]+",
    "variable": r"var\s+([A-Za-z0-9_]+)",
    "host": r"(?s)host\s*=.*?;",
    "presentation": r"presentation[A-Za-z0-9_]*",
    "publicview": r"(?i)publicview",
}
# What else a page is searched for.
ADDRESS_FINDS = {
    "action": r"(?i)action=\"([^\"]+)\"",
    "href": r"(?i)href=\"([^\"]+)\"",
    "src": r"(?i)src=\"([^\"]+)\"",
    "aif2": r"(?i)aif2",
    "controller": r"/([A-Za-z]+)/[A-Za-z0-9_\-]+",
    "function": r"function\s+[A-Za-z0-9_]+",
}


def _map(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _grouped(token: str) -> float | None:
    """The number of a token in groups of three digits; parentheses or a dash make it negative."""
    bare = token.strip("()-.;:")
    negative = token.startswith(("(", "-"))
    whole, _, part = bare.partition(".")
    first, *groups = whole.split(",")
    fits = groups and 1 <= len(first) <= 3 and all(len(g) == 3 for g in groups) and f"{first}{''.join(groups)}{part}".isdigit()
    return None if not fits else float(f"{'-' if negative else ''}{first}{''.join(groups)}.{part or 0}")


def _after(text: str, place: int) -> tuple[float, float] | None:
    """Two amounts side by side, of which the first starts on the same line, at most REACH characters on."""
    tokens = [(m.start(), m.group()) for m in re.finditer(r"\S+", text[place : place + REACH + 200])]
    for (at, one), (_, two) in zip(tokens, tokens[1:]):
        if at > REACH or "\n" in text[place : place + at]:
            return None
        amounts = _grouped(one.lstrip(":$")), _grouped(two)
        if None not in amounts:
            return amounts
    return None


def two_numbers(text: Column | str, labels: list[str], scale: Column | int = 1) -> Column:
    """struct(current, comparative): the two amounts after the first label (a pattern) that has them, times the scale."""

    @F.pandas_udf("current double, comparative double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        patterns = [re.compile(x) for x in labels]
        for batch in batches:
            found = [next((f for p in patterns for m in p.finditer(x or "") if (f := _after(x, m.end()))), (None, None)) for x in batch]
            yield pd.DataFrame(found, columns=["current", "comparative"], dtype="float64")

    f = run(col(text))
    return F.when(f["current"].isNotNull(), F.struct((f["current"] * scale).alias("current"), (f["comparative"] * scale).alias("comparative")))


def _codes(text: str) -> list[tuple[str, float]]:
    """Code, words in capitals, amount with two decimals: what stands so in a row of tokens, the first of each code."""
    found: dict[str, float] = {}
    code, words = None, 0
    for token in text.split():
        cents = token.rpartition(".")
        if len(token) == 7 and token.isdigit() and token[0] in "12345678":
            code, words = token, 0
        elif code and words and len(cents[2]) == 2 and cents[2].isdigit() and cents[0].removeprefix("-").isdigit():
            found.setdefault(code, float(token))
            code = None
        elif code and not any(c.isdigit() or c.islower() for c in token):
            words += 1
        else:
            code = None
    return list(found.items())


def code_amounts(text: Column | str) -> Column:
    """array of struct(code, amount) of a regulator's template, in the order of the text; the first of a code wins."""

    @F.pandas_udf("array<struct<code:string,amount:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"code": c, "amount": a} for c, a in _codes(x or "")] for x in batch], dtype=object)

    return run(col(text))


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(w)) for w in words))


def scale_of(text: Column | str) -> Column:
    """1000 or 1,000,000 as the text's beginning says, else 1; thousands first."""
    head, chain = F.lower(F.substring(col(text), 1, 8000)), F
    for scale, words in SCALES.items():
        chain = chain.when(_any(head, words), scale)
    return chain.otherwise(1)


def period_end(text: Column | str) -> Column:
    """The latest English date of the text's beginning, of the years 2015 to 2027."""
    pattern = rf"(?i)({'|'.join(MONTHS)})\s+(\d{{1,2}}),?\s+(\d{{4}})"
    part = lambda x, k: F.regexp_extract(x, pattern, k)
    found = F.regexp_extract_all(F.substring(col(text), 1, 3000), F.lit(pattern), F.lit(0))
    good = F.filter(found, lambda x: part(x, 3).cast("int").between(2015, 2027) & part(x, 2).cast("int").between(1, 31))
    dates = F.transform(good, lambda x: F.concat_ws("-", part(x, 3), F.lpad(F.element_at(_map(MONTHS), F.lower(part(x, 1))).cast("string"), 2, "0"), F.lpad(part(x, 2), 2, "0")))
    return F.array_max(dates)


def period_kind(text: Column | str) -> Column:
    """Q for an interim statement, A for a year's."""
    return F.when(_any(F.lower(F.substring(col(text), 1, 3000)), INTERIM), "Q").otherwise("A")


#: Words and marks of a file name: numbers, words, and all other characters one by one.
_TOKEN = re.compile(r"\d+|[^\W\d_]+|.", re.S)
_QUARTER_WORDS = {"t", "q", "trim", "trimestre", "trimestral"}
_MARKS = set("°º._- ") | {"o"}


def _quarter(tokens: list[str]) -> int | None:
    """The number beside a word for a quarter, with up to three marks between them: 3T, 3º trimestre, Q2, trim. 1."""
    for k, word in enumerate(tokens):
        if word in _QUARTER_WORDS:
            for way, most in ((-1, 3), (1, 2)):
                at = k + way
                while abs(at - k) <= most and 0 <= at < len(tokens) and tokens[at] in _MARKS:
                    at += way
                if 0 <= at < len(tokens) and tokens[at] in ("1", "2", "3", "4"):
                    return int(tokens[at])
    return None


def _dated(tokens: list[str]) -> int | None:
    """The month of a date of day, month and year, parted by dots, dashes or slashes."""
    for day, a, month, b, year in zip(*(tokens[k:] for k in range(5))):
        if {a, b} <= set(".-/") and day.isdigit() and month.isdigit() and len(day) <= 2 and len(month) <= 2 and year.startswith("20") and year[:4].isdigit():
            return int(month)
    return None


def period_of(name: str, close: int = 12) -> tuple[int | None, int | None, str]:
    """Year, month and kind of a statement's file name, for a fiscal year that closes in the month `close`."""
    name = name.lower()
    tokens = _TOKEN.findall(name)
    years = [int(t[k : k + 4]) for t in tokens if t.isdigit() for k in range(len(t) - 3) if t.startswith("20", k)]
    quarter = _quarter(tokens)
    months = (_dated(tokens), next((k for m, k in MESES.items() if m in name), None), quarter and (close - 3 * (4 - quarter) - 1) % 12 + 1)
    month = next((m for m in months if m is not None), None)
    whole_year = "anual" in name or quarter == 4 or month == close or month is None
    return max(years, default=None), month, "anual" if whole_year else "trimestral"


def file_period(name: Column | str, close: Column | int = 12) -> Column:
    """struct(year, month, kind) of a statement's file name: the latest year; the month by a date, a month's name
    or a quarter of the fiscal year that closes in `close`; anual or trimestral."""

    @F.pandas_udf("year int, month int, kind string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for names, closes in batches:
            found = [period_of(n or "", int(c)) for n, c in zip(names, closes, strict=True)]
            yield pd.DataFrame({"year": pd.array([f[0] for f in found], "Int32"), "month": pd.array([f[1] for f in found], "Int32"), "kind": [f[2] for f in found]})

    return run(col(name), F.lit(close) if isinstance(close, int) else close)


def absolute_url(url: Column | str, base: Column | str) -> Column:
    u, root = col(url), F.coalesce(F.nullif(F.regexp_extract(col(base), r"^(https?://[^/]+)", 1), F.lit("")), col(base))
    return F.when(u.startswith("http"), u).when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(root, u)).otherwise(F.concat(root, F.lit("/"), u))


def base_name(url: Column | str) -> Column:
    return F.substring_index(col(url), "/", -1)


def safe_name(text: Column | str, most: int = 60) -> Column:
    """Letters, digits, dots and dashes; all else underscores; cut."""
    return F.substring(F.regexp_replace(col(text), r"(?U)[^\w.\-]", "_"), 1, most)


def recency(url: Column | str) -> Column:
    """The latest year that a file's name holds, 0 without one."""
    years = F.transform(F.regexp_extract_all(base_name(url), F.lit(r"20\d{2}"), F.lit(0)), lambda x: x.cast("int"))
    return F.coalesce(F.array_max(years), F.lit(0))


def links(markup: Column | str) -> Column:
    return F.regexp_extract_all(col(markup), F.lit("href=[\"']([^\"']+)"), F.lit(1))


def is_statement(url: Column) -> Column:
    return F.lower(url).endswith(".pdf") & url.rlike(STATEMENT_FILE)


def leads_to_statements(url: Column) -> Column:
    return ~F.lower(url).endswith(".pdf") & url.rlike(STATEMENT_PAGE)


def unescaped(text: Column | str) -> Column:
    """All of HTML's character references decoded, once, in Arrow batches; Spark has no such function."""

    def decode(batch: pd.Series) -> pd.Series:
        return batch.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, "string")(col(text))


def page_text(markup: Column | str) -> Column:
    """Markup removed, character references decoded, white space collapsed."""
    bare = F.regexp_replace(col(markup), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(unescaped(bare), r"(?U)\s+", " "))


def page_structure(markup: Column | str) -> dict[str, Column]:
    """Tables, rows, cells of the first row, scripts."""
    count = lambda p: F.regexp_count(col(markup), F.lit(p)).cast("long")
    first = F.regexp_extract(col(markup), r"(?is)<tr\b[^>]*>(.*?)</tr>", 1)
    return {"tables": count(r"(?i)<table\b"), "rows": count(r"(?i)<tr\b"), "first_row": F.regexp_count(first, F.lit(r"(?i)<t[dh]\b")).cast("long"), "scripts": count(r"(?i)<script\b")}


def page_finds(markup: Column | str, finds: dict[str, str] = PAGE_FINDS) -> Column:
    """array of struct(name, found): all that the patterns find; the group of a pattern that has one."""
    return F.array(*[F.struct(F.lit(n).alias("name"), F.regexp_extract_all(col(markup), F.lit(p), F.lit(int("(" in p.replace("(?", "")))).alias("found")) for n, p in finds.items()])


def page_addresses(markup: Column | str) -> Column:
    """page_finds of ADDRESS_FINDS; controllers once each, in order."""
    found = page_finds(markup, ADDRESS_FINDS)
    return F.transform(found, lambda f: F.struct(f["name"].alias("name"), F.when(f["name"] == "controller", F.array_sort(F.array_distinct(f["found"]))).otherwise(f["found"]).alias("found")))
