"""Column expressions of the fundamentals vocabulary: ratios, dates, localised numbers, labels.

NULL in any operand gives NULL unless a function says otherwise; nothing is estimated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sector by the first two digits of the industry code.
SIC_SECTORS = [
    (1, 9, "Agro/Minería primaria"),
    (10, 14, "Minería/Energía extractiva"),
    (15, 17, "Construcción"),
    (20, 39, "Manufactura/Industria"),
    (40, 49, "Transporte/Utilities/Telecom"),
    (50, 51, "Comercio mayorista"),
    (52, 59, "Comercio minorista"),
    (60, 67, "Finanzas/Seguros/Inmobiliario"),
    (70, 89, "Servicios"),
]
# What a page that is not the document says of itself, by reason, in order.
PAGE_FAULTS = [
    ("captcha", ["captcha", "recaptcha", "cloudflare", "cf-browser-verification", "verify you are human"]),
    ("maintenance", ["maintenance", "mantenimiento", "temporarily unavailable", "service unavailable", "503"]),
    ("error_page", ["404", "not found", "ha ocurrido un error", "ocurrió un error", "error interno", "internal server error"]),
]
# Names of forms with statements, and of forms without.
STATEMENT_FORMS = ["ESTADOS CONTABLES", "ESTADOS FINANCIEROS", "BALANCE", "NIIF", "INFORMACIÓN FINANCIERA", "ESTADO DE SITUACIÓN", "ESTADO DE RESULTADOS", "CONTROLADAS", "VINCULADAS"]
OTHER_FORMS = ["HECHO RELEVANTE", "ACTA", "ASAMBLEA", "DIRECTORIO", "PROSPECTO", "AVISO", "MEMORIA", "CONVOCATORIA", "EDICTO", "CALIFICACIÓN", "RENUNCIA", "DESIGNACIÓN", "AUTORIZACIÓN", "REORGANIZACIÓN", "FUSIÓN"]
# Kinds of change by the first word of the message.
CHANGE_KINDS = {"feat": "Feature", "fix": "Bug Fix", "docs": "Documentation", "refactor": "Refactor", "test": "Test"}


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b; NULL if b is NULL or zero."""
    return F.try_divide(col(a), col(b))


def guarded_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b where b is positive, else NULL."""
    return F.when(col(b) > 0, col(a) / col(b))


def strict_sum(*parts: Column | str) -> Column:
    """Sum; NULL if any part is."""
    return reduce(lambda a, b: a + b, map(col, parts))


def lenient_sum(*parts: Column | str) -> Column:
    """Sum of the parts present; NULL if none is."""
    some = list(map(col, parts))
    return F.when(F.coalesce(*some).isNotNull(), reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in some]))


def zero_as_missing(x: Column | str) -> Column:
    return F.nullif(col(x), F.lit(0))


def total_debt(long_term: Column | str, current: Column | str, short_term: Column | str, debt_current: Column | str) -> Column:
    """Long-term, current and short-term debt, as far as present; a short-term debt of zero falls through to debt_current."""
    return lenient_sum(long_term, current, F.coalesce(zero_as_missing(short_term), col(debt_current)))


def inclusive_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end), col(start)) + 1


def period_class(days: Column | str) -> Column:
    d = col(days)
    return F.when(d.isNull(), "unknown").when(d <= 120, "quarter").when(d <= 210, "half").when(d <= 300, "nine_months").otherwise("annual")


def month_end(year: Column | str, month: Column | str) -> Column:
    """Last day of the month; December where the month is NULL."""
    return F.last_day(F.make_date(col(year), F.coalesce(col(month), F.lit(12)), F.lit(1)))


def quarter_month(close: Column | str, quarter: Column | str) -> Column:
    """Calendar month in which a fiscal quarter ends, by the month of the fiscal close."""
    return F.pmod(col(close) - 3 * (4 - col(quarter)) - 1, F.lit(12)) + 1


def synthetic_year_start(end: Column | str) -> Column:
    return F.date_sub(col(end), 364)


def relative_divergence(x: Column | str, reference: Column | str) -> Column:
    """Signed, in percent of the reference."""
    return safe_ratio(col(x) - col(reference), reference) * 100


def divergence_text(x: Column | str) -> Column:
    """+2,45% with a decimal comma."""
    return F.concat(F.replace(F.format_string("%+.2f", col(x)), F.lit("."), F.lit(",")), F.lit("%"))


def percent_number(text: Column | str) -> Column:
    """'29,36%' as 29.36; NULL for other text, also with thousands marks."""
    bare = F.regexp_replace(F.trim(col(text)), "%+$", "")
    return F.replace(bare, F.lit(","), F.lit(".")).try_cast("double")


def argentine_number(text: Column | str) -> Column:
    """'(1.498,5)' as -1498.5: dots are thousands, the comma is decimal, parentheses or minus negate."""
    t = F.trim(col(text))
    value = F.replace(F.regexp_replace(t, "[^0-9,]", ""), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(t.startswith("(") | t.startswith("-"), -value).otherwise(value)


def english_number(text: Column | str) -> Column:
    """'(1,498.5)' as -1498.5."""
    t = F.trim(col(text))
    value = F.regexp_replace(t, "[^0-9.]", "").try_cast("double")
    return F.when(t.startswith("(") | t.startswith("-"), -value).otherwise(value)


def joined_numbers(text: Column | str) -> Column:
    """Numbers that white space splits, joined."""
    return F.regexp_replace(col(text), r"(?U)(?<=\d)\s+(?=[\d.])", "")


def sic_sector(sic: Column | str) -> Column:
    group = F.substring(col(sic), 1, 2).try_cast("int")
    chain = F
    for low, high, name in SIC_SECTORS:
        chain = chain.when(group.between(low, high), name)
    return F.when(group.isNotNull(), chain.otherwise("Otro"))


def page_fault(page: Column | str, wanted: Column | str | None = None, least: int = 10_000) -> Column:
    """Why a page is no valid document: empty_response, html_too_small, what it says of itself,
    id_missing; 'ok' otherwise. The first reason wins."""
    low = F.lower(col(page))
    out = F.when(F.coalesce(F.length(col(page)), F.lit(0)) == 0, "empty_response").when(F.length(col(page)) < least, "html_too_small")
    for name, words in PAGE_FAULTS:
        out = out.when(low.rlike("|".join(words)), name)
    if wanted is not None:
        out = out.when(~F.contains(col(page), col(wanted)), "id_missing")
    return out.otherwise("ok")


def joined_flags(flags: dict[str, Column], by: str = ";") -> Column:
    """The names whose condition holds, joined; NULL if none does."""
    return F.nullif(F.concat_ws(by, *[F.when(c, name) for name, c in flags.items()]), F.lit(""))


def first_match(text: Column | str, rules: list[tuple[str, str, int]]) -> Column:
    """struct(label, score) of the first rule (pattern, label, score) that matches."""
    chain = F
    for pattern, label, score in rules:
        chain = chain.when(col(text).rlike(pattern), F.struct(F.lit(label).alias("label"), F.lit(score).alias("score")))
    return chain.otherwise(F.struct(F.lit("other").alias("label"), F.lit(0).alias("score")))


def label_number(text: Column | str, labels: list[str], number=argentine_number) -> Column:
    """First number within forty other characters after the first label that has one."""
    return F.coalesce(*[number(F.nullif(F.regexp_extract(col(text), rf"(?iu){x}[^0-9(]{{0,40}}(\(?[0-9][0-9.,]*\)?)", 1), F.lit(""))) for x in labels])


def ticker_variants(ticker: Column | str) -> Column:
    """The spellings to try, in order: as it is, dot as dash, before the dot, dash as dot."""
    t = col(ticker)
    return F.array_distinct(F.array(t, F.replace(t, F.lit("."), F.lit("-")), F.substring_index(t, ".", 1), F.replace(t, F.lit("-"), F.lit("."))))


def padded_cik(cik: Column | str) -> Column:
    text = col(cik).cast("string")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def key_text(key: Column | str) -> Column:
    """A key as text, however it was read: 12, 12.0 and '12' are '12'; NULL, NaN and other text are NULL and match nothing."""
    number = col(key).cast("string").try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast("bigint").cast("string"))


def identity_gap(assets: Column | str, liabilities: Column | str, equity: Column | str) -> Column:
    """Percent by which liabilities and equity miss the assets."""
    return safe_ratio(F.abs(col(liabilities) + col(equity) - col(assets)), F.abs(col(assets))) * 100


def plain_text(markup: Column | str) -> Column:
    """Markup removed, the commonest entities decoded, white space collapsed."""
    t = F.regexp_replace(col(markup), "<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def sorted_tokens(text: Column | str) -> Column:
    """Lower-case tokens in order, for comparing names whatever their order."""
    return F.array_join(F.array_sort(F.split(F.trim(F.lower(col(text))), r"\s+")), " ")


def keyword_class(text: Column | str, allowed: list[str], denied: list[str]) -> Column:
    """1 if the text has a word of the first list, else 0 if of the second, else NULL; case is ignored."""
    upper = F.upper(col(text))
    return F.when(upper.rlike("|".join(allowed)), 1).when(upper.rlike("|".join(denied)), 0)


def prefix_class(text: Column | str, kinds: dict[str, str] = CHANGE_KINDS, other: str = "Other") -> Column:
    chain = F
    for prefix, name in kinds.items():
        chain = chain.when(col(text).startswith(prefix), name)
    return chain.otherwise(other)


def progress(state: Column | str) -> Column:
    return F.when(col(state) == "COMPLETADA", 100).when(col(state) == "EN PROGRESO", 50).otherwise(0)


def joined_notes(notes: dict[str, Column]) -> Column:
    """The notes whose condition holds, joined by '; '; empty if none does."""
    return F.concat_ws("; ", *[F.when(c, text) for text, c in notes.items()])


def extraction_state(accepted: Column, items: Column, empty_text: Column) -> Column:
    """OK if accepted, PARCIAL with some items, ESCANEADO without text, else VACIO."""
    return F.when(F.coalesce(accepted, F.lit(False)), "OK").when(items > 0, "PARCIAL").when(empty_text, "ESCANEADO").otherwise("VACIO")


def gross_gap(revenue: Column | str, cost: Column | str, gross: Column | str) -> Column:
    """Percent by which revenue and cost miss the gross profit; a cost may be given as negative."""
    made = col(revenue) + F.when(col(cost) < 0, col(cost)).otherwise(-col(cost))
    return safe_ratio(F.abs(made - col(gross)), F.abs(col(gross))) * 100


def reconciled_income(net: Column | str, comprehensive: Column | str, times: float = 5.0) -> Column:
    """The comprehensive income where the net one is missing or over `times` smaller, else the net one."""
    ratio = F.abs(safe_ratio(comprehensive, net))
    return F.when(col(comprehensive).isNotNull() & (col(net).isNull() | F.coalesce(ratio > times, F.lit(False))), col(comprehensive)).otherwise(col(net))


def token_similarity(a: Column | str, b: Column | str) -> Column:
    """0 to 100 by the edit distance of the names' sorted tokens."""
    x, y = sorted_tokens(a), sorted_tokens(b)
    return F.round(100 * (1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))), 4)


def existing(df: DataFrame, names: list[str]) -> DataFrame:
    """Those of the columns that df has."""
    return df.select(*[n for n in names if n in df.columns])
