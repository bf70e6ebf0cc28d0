"""Quantities recorded in different units, all converted to USD per million tokens (problem 6).

Method: ``regexp_extract`` of number and unit, alias words normalised by a join, ``coalesce`` of unit field, unit in the
text and the source's default, then the factor. Everything is built-in column work without a shuffle; the only joins
are to the alias table of a fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronodiff.functions import amounts as A
from chronodiff.operators.joins import where_not_null


def token_prices(df: DataFrame, price: str, unit: str | None, name: str | None, currency: str | None, default_unit: str | None = None) -> DataFrame:
    """Adds ``usd_per_mtok`` decimal(38,12) to rows with a numeric price column.

    The unit is that of ``unit``; where it is null, blank or a placeholder, the one written in ``name``; else
    ``default_unit``. Null where the price is null, the currency isn't US dollars (null currency counts as dollars only
    if ``currency`` is None), the unit is none or counts anything but tokens. Other columns, whatever their names, stay.
    """
    found = [A.named_unit(F.col(unit))] if unit else []
    found += [A.unit_in_name(F.col(name))] if name else []
    found += [F.lit(default_unit)] if default_unit else []
    # Parsed in columns of names that no input has; the caller's columns are kept aside in one struct.
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.coalesce(*found, F.lit(None).cast("string")).alias("_unit"),
                  F.col(price).alias("_price"), (F.lower(F.trim(F.col(currency))) if currency else F.lit("usd")).alias("_cur"))
    d = A.with_unit(d, "_unit", "_q")
    amount = F.col("_price").cast("decimal(30,16)")
    ok = (F.col("_cur") == "usd") & F.col("_q_tokens") & F.col("_price").isNotNull() & ~F.isnan(F.col("_price").cast("double"))
    value = F.when(ok, A.per_million(amount, F.col("_q_cents"), F.col("_q_count")))
    return d.select("_row.*", value.alias("usd_per_mtok"))


def micro(usd_per_mtok):
    """USD per million tokens times 1,000,000, rounded half up."""
    return F.round(usd_per_mtok * F.lit("1000000").cast("decimal(7,0)"), 0).cast("bigint")


def micro_prices(azure: DataFrame, models: DataFrame) -> DataFrame:
    """(record_table, row_id, micro_usd_per_mtok) of every row with a token price in US dollars or cents."""
    a = token_prices(azure.select("row_id", "retail_price", "unit_of_measure", "meter_name", "currency_code"), "retail_price", "unit_of_measure", "meter_name", "currency_code")
    m = A.with_price_text(models.select("row_id", F.col("pricing.prompt").alias("prompt")), "prompt", "usd_per_mtok")
    parts = [where_not_null(d.select(F.lit(t).alias("record_table"), "row_id", micro(F.col("usd_per_mtok")).alias("micro_usd_per_mtok")), "micro_usd_per_mtok")
             for t, d in (("azure_retail_prices", a), ("openrouter_models", m))]
    return parts[0].unionByName(parts[1])
