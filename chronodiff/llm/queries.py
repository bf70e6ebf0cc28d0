"""The queries of this subpackage by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronodiff.llm import canonical, encoding, mixing, spans
from chronodiff.plans.queries import read


def _documents(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: f(read(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda spark, d: canonical.map_names(read(spark, d, "azure_retail_prices"), read(spark, d, "model_aliases")),
    "p1_unmatched": lambda spark, d: canonical.unmatched(read(spark, d, "azure_retail_prices"), read(spark, d, "model_aliases")),
    "p7_ids": _documents(encoding.encode),
    "p8_mix": lambda spark, d: mixing.mix(read(spark, d, "documents"), read(spark, d, "mix_targets"))[0],
    "p8_report": lambda spark, d: mixing.mix(read(spark, d, "documents"), read(spark, d, "mix_targets"))[1],
    "p9_found": _documents(spans.shared_chars),
    "p9_repeats": _documents(spans.repeated_runs),
}
