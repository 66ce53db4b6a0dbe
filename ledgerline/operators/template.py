"""A regulator's template: amounts by code, its own twelve ratios, and how far they are from ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import col, relative_divergence
from ledgerline.operators.ratios import template_ratios

# Items of the template by code.
ITEMS = {
    "1122500": "cash", "1120100": "inventory", "1121999": "receivables", "1139999": "current_assets", "1999999": "assets", "2299999": "equity", "2322200": "debt_current",
    "2339999": "current_liabilities", "2312300": "debt_non_current", "2399999": "liabilities", "3000100": "revenue", "3000200": "cost", "3009999": "gross_profit",
    "3019999": "operating_income", "3021500": "interest", "3049999": "net_income", "8000003": "ebit", "8000004": "ebitda",
}
# Ratios that the template states itself, by code.
OFFICIAL = {
    "8000006": "liquidez", "8000007": "solvencia", "8000009": "roe", "8000010": "roa", "8000011": "endeudamiento", "8000013": "apalancamiento", "8000014": "margen_neto",
    "8000015": "deuda_fin_ebitda", "8000016": "ebitda_costos_fin", "8000027": "prueba_acida", "8000028": "cobertura_intereses", "8000029": "rotacion_activos",
}
#: Ours by the name of the official one.
COMPARED = {"liquidez": "current_ratio", "roe": "roe", "roa": "roa", "margen_neto": "margen_neto", "deuda_fin_ebitda": "deuda_ebitda"}


def by_code(amounts: Column | str, names: dict[str, str]) -> dict[str, Column]:
    """A column for each name, from an array of struct(code, amount); NULL where its code is missing."""
    held = F.map_from_entries(col(amounts))
    return {name: F.try_element_at(held, F.lit(code)) for code, name in names.items()}


def with_items(rows: DataFrame, amounts: str) -> DataFrame:
    return rows.withColumns(by_code(amounts, ITEMS))


def compared(rows: DataFrame, key: str, amounts: str, tolerance: float = 1.0) -> DataFrame:
    """key, ratio, official, ours, gap (in percent of the official one) and agrees, for every official ratio of a
    template, also those that we don't compute; agrees is NULL without both."""
    ours = template_ratios()
    wide = with_items(rows.select(key, amounts), amounts).withColumns({f"_{k}": c for k, c in by_code(amounts, OFFICIAL).items()}).withColumns({f"_our_{n}": ours[m] for n, m in COMPARED.items()})
    none = F.lit(None).cast("double")
    each = F.array(*[F.struct(F.lit(n).alias("ratio"), F.col(f"_{n}").alias("official"), (F.col(f"_our_{n}") if n in COMPARED else none).alias("ours")) for n in OFFICIAL.values()])
    long = wide.select(key, F.inline(each))
    gap = relative_divergence("ours", "official")
    return long.withColumns({"gap": gap, "agrees": F.abs(gap) <= tolerance})
