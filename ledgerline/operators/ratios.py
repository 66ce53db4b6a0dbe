"""The ratio catalogue, valuation and quality flags over one wide row for each entity.

Inputs are columns named as in INPUTS; each ratio is an expression, so one projection computes
all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import guarded_ratio, joined_flags, lenient_sum, safe_ratio, strict_sum, zero_as_missing

INPUTS = ("revenue", "gross_profit", "operating_income", "net_income", "depreciation", "cfo", "capex", "dividends", "assets", "current_assets", "current_liabilities", "inventory", "receivables", "cash", "equity", "average_equity", "long_debt", "debt", "shares")


def catalogue() -> dict[str, Column]:
    c = F.col
    ebitda, fcf = strict_sum("operating_income", "depreciation"), c("cfo") - c("capex")
    return {
        "ebitda": ebitda,
        "fcf": fcf,
        "gross_margin": safe_ratio("gross_profit", "revenue"),
        "operating_margin": safe_ratio("operating_income", "revenue"),
        "ebitda_margin": safe_ratio(ebitda, c("revenue")),
        "net_margin": safe_ratio("net_income", "revenue"),
        "roe": guarded_ratio("net_income", "average_equity"),
        "roa": safe_ratio("net_income", "assets"),
        "roce": safe_ratio(c("operating_income"), c("equity") + c("debt")),
        "debt_equity": guarded_ratio("debt", "equity"),
        "debt_ebitda": guarded_ratio(c("debt"), ebitda),
        "net_debt_ebitda": guarded_ratio(c("debt") - c("cash"), ebitda),
        "current_ratio": safe_ratio("current_assets", "current_liabilities"),
        "quick_ratio": safe_ratio(c("current_assets") - c("inventory"), c("current_liabilities")),
        "asset_turnover": safe_ratio("revenue", "assets"),
        "inventory_turnover": safe_ratio(c("revenue") - c("gross_profit"), c("inventory")),
        "days_receivable": safe_ratio(c("receivables"), c("revenue")) * 365,
        "fcf_margin": safe_ratio(fcf, c("revenue")),
        "capex_revenue": safe_ratio("capex", "revenue"),
        "earnings_quality": guarded_ratio("cfo", "net_income"),
        "payout": guarded_ratio("dividends", "net_income"),
        "fcf_payout": guarded_ratio(c("dividends"), fcf),
        "fcf_on_long_capital": safe_ratio(fcf, c("equity") + c("long_debt")),
        "fcf_on_net_capital": safe_ratio(fcf, c("equity") + c("debt") - c("cash")),
        "eps": safe_ratio(zero_as_missing("net_income"), c("shares")),
        "book_value_per_share": safe_ratio("equity", "shares"),
    }


def with_ratios(wide: DataFrame) -> DataFrame:
    missing = [c for c in INPUTS if c not in wide.columns]
    return wide.withColumns({c: F.lit(None).cast("double") for c in missing}).withColumns(catalogue())


def with_valuation(wide: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds valuation ratios in the market's currency: market_cap, and currency by rates (currency, rate).
    No currency means USD at 1; a currency without rate gives NULL."""
    joined = wide.join(F.broadcast(rates), "currency", "left")
    fx = F.when(F.coalesce("currency", F.lit("USD")) == "USD", 1.0).otherwise(F.col("rate"))
    cap = F.col("market_cap")
    local = lambda name: F.col(name) * F.col("fx")
    return joined.withColumn("fx", fx).drop("rate").withColumns(
        {
            "per": guarded_ratio(cap, local("net_income")),
            "price_book": guarded_ratio(cap, local("equity")),
            "price_sales": guarded_ratio(cap, local("revenue")),
            "ev_ebitda": guarded_ratio(cap + local("debt"), local("ebitda")),
            "earnings_yield": guarded_ratio(local("net_income"), cap),
            "fcf_yield": guarded_ratio(local("fcf"), cap),
            "dividend_yield": guarded_ratio(F.col("payout") * local("net_income"), cap),
        }
    )


def quality_flags(strategy: Column, equity: Column, assets: Column, currency: Column, fx: Column, price: Column, shares: Column, cap: Column) -> Column:
    """ni_fy: income of a whole old year; roe_ns: equity under 5 % of assets; fx_<currency> or no_fx;
    mktcap_rev: price times shares misses the market value by over half. NULL if none holds."""
    foreign = F.coalesce(currency, F.lit("USD")) != "USD"
    flags = {"ni_fy": strategy == "C", "roe_ns": equity < 0.05 * assets, "no_fx": foreign & fx.isNull(), "mktcap_rev": ~foreign & (F.abs(price * shares - cap) / F.nullif(cap, F.lit(0)) > 0.5)}
    return F.nullif(F.concat_ws(";", joined_flags(flags), F.when(foreign & fx.isNotNull(), F.concat(F.lit("fx_"), F.lower(currency)))), F.lit(""))


def plausible_shares(diluted: Column, outstanding: Column) -> Column:
    """Diluted shares, NULL if a hundred times off the outstanding ones."""
    r = safe_ratio(diluted, outstanding)
    return F.when((r > 100) | (r < 0.01), None).otherwise(diluted)


def depreciation(comprehensive: Column, first: Column, second: Column, second_is_depreciation: Column, intangibles: Column) -> Column:
    """The comprehensive figure if there is one, else the larger of two; plain depreciation takes the intangibles' amortisation along."""
    larger = F.greatest(first, second)
    plain = second_is_depreciation & (F.coalesce(second >= first, first.isNull()))
    return F.coalesce(comprehensive, F.when(plain, lenient_sum(second, intangibles)).otherwise(larger))


def plausible_shares_flag(diluted: Column, outstanding: Column) -> Column:
    """Whether plausible_shares discards the figure."""
    r = safe_ratio(diluted, outstanding)
    return F.when((r > 100) | (r < 0.01), "shares_descartadas_escala")


def four_part_ebitda(income: Column | str, depreciation: Column | str, interest: Column | str, tax: Column | str) -> Column:
    """Net income, depreciation, interest and tax; NULL if any is missing."""
    return strict_sum(income, depreciation, interest, tax)


def screener_ratios(price: str = "price", cap: str = "market_cap") -> dict[str, Column]:
    """The screener's ratios: debt is all liabilities; a zero income counts as missing; a ratio whose
    denominator is no positive number is NULL. Columns: net_income, revenue, equity, liabilities,
    operating_income, ebitda, fcf, diluted_shares, dividend_yield."""
    c = F.col
    some = zero_as_missing
    eps = guarded_ratio(some("net_income"), "diluted_shares")
    book = F.when(c("equity") > 0, guarded_ratio("equity", "diluted_shares"))
    return {
        "pe": guarded_ratio(some(price), eps),
        "p_book": guarded_ratio(some(price), book),
        "debt_equity": guarded_ratio(some("liabilities"), "equity"),
        "debt_ebitda": guarded_ratio(some("liabilities"), "ebitda"),
        "margin_neto": guarded_ratio(some("net_income"), "revenue"),
        "roe": guarded_ratio(some("net_income"), "equity"),
        "op_margin": guarded_ratio(some("operating_income"), "revenue"),
        "ebitda_margin": guarded_ratio(some("ebitda"), "revenue"),
        "fcf_yield": F.when(c("fcf") > 0, guarded_ratio("fcf", cap)),
        "payout_ratio": c("dividend_yield"),
        "current_ratio": F.lit(None).cast("double"),
        "eps_cagr_5y": F.lit(None).cast("double"),
    }


def template_ratios() -> dict[str, Column]:
    """Ratios of a regulator's template; missing debt counts as none."""
    debt = F.coalesce("debt_current", F.lit(0.0)) + F.coalesce("debt_non_current", F.lit(0.0))
    return {
        "margen_bruto": safe_ratio("gross_profit", "revenue"),
        "margen_neto": safe_ratio("net_income", "revenue"),
        "roe": safe_ratio("net_income", "equity"),
        "roa": safe_ratio("net_income", "assets"),
        "current_ratio": safe_ratio("current_assets", "current_liabilities"),
        "deuda_ebitda": safe_ratio(debt, F.col("ebitda")),
    }


def implied_by(metric: Column, value: Column) -> Column:
    """struct(implied, actual): the input that a reference value of a metric implies, and the actual
    one: net income for PER, EPS and Margen, mean equity for ROE, dividends for Payout, none for
    others. Columns: price, shares, net_income, revenue, average_equity, dividends."""
    some = zero_as_missing
    pair = lambda implied, actual: F.struct(implied.alias("implied"), F.col(actual).alias("actual"))
    none = F.lit(None).cast("double")
    rules = [
        ("PER", pair(safe_ratio(some("price"), value) * some("shares"), "net_income")),
        ("EPS", pair(value * some("shares"), "net_income")),
        ("Margen", pair(value * some("revenue"), "net_income")),
        ("ROE", pair(safe_ratio(some("net_income"), value), "average_equity")),
        ("Payout", pair(value * some("net_income"), "dividends")),
    ]
    chain = F
    for name, struct in rules:
        chain = chain.when(metric == name, struct)
    return chain.otherwise(F.struct(none.alias("implied"), none.alias("actual")))


def lineage_sheet(wide: DataFrame, key: str, parts: dict[str, tuple[str, str, bool]]) -> DataFrame:
    """wide with each ratio (numerator, denominator, guarded) and its formula where it could be computed."""
    made = {}
    for name, (a, b, guarded) in parts.items():
        made[name] = guarded_ratio(a, b) if guarded else safe_ratio(a, b)
        made[f"{name}_formula"] = F.when(made[name].isNotNull(), f"{a} / {b}")
    return wide.withColumns(made)
