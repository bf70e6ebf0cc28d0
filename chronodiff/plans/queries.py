"""The queries of the core by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronodiff.operators import instants, nested, references, snapshots, units
from chronodiff.plans.reference_queries import REFERENCE
from chronodiff.plans.run_queries import RUNS
from chronodiff.plans.source_queries import SOURCES
from chronodiff.session import prepare


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def _tables(*names: str):
    """Makes a query of a function of tables."""

    def wrap(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, d: f(*[read(spark, d, n) for n in names])

    return wrap


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": _tables("openrouter_models", "statuspage_incidents")(snapshots.record_changes),
    "p3_found": _tables("bedrock_offers")(lambda b: nested.offer_nodes(b).select("row_id", "level", "node_key", "parent_key")),
    "p4_found": _tables("change_events", "manifests", "sources")(references.orphan_references),
    "p4_report": _tables("change_events", "manifests", "sources")(lambda e, m, s: references.orphan_report(references.orphan_references(e, m, s))),
    "p4_keys": _tables("change_events", "manifests", "sources")(
        lambda e, m, s: references.orphans_now(e, m, s).select("target_table", "key", "refs", F.unix_micros("first_at").alias("first_us"), F.unix_micros("gone_at").alias("gone_us"))
    ),
    "p5_found": _tables("openrouter_models", "statuspage_incidents", "azure_retail_prices", "change_events", "sources")(
        lambda m, s, a, e, src: instants.normalise(instants.values(m, s, a, e), src).select("record_table", "row_id", "pos", "epoch_us")
    ),
    "p5_zones": _tables("openrouter_models", "statuspage_incidents", "azure_retail_prices", "change_events", "sources")(
        lambda m, s, a, e, src: instants.zone_report(instants.values(m, s, a, e), src)
    ),
    "p5_estimated": _tables("openrouter_models", "statuspage_incidents", "azure_retail_prices", "change_events", "sources")(
        lambda m, s, a, e, src: instants.normalise(instants.values(m, s, a, e), src, estimate=True).select("record_table", "row_id", "pos", "epoch_us")
    ),
    "p6_found": _tables("azure_retail_prices", "openrouter_models")(units.micro_prices),
    **REFERENCE,
    **RUNS,
    **SOURCES,
}
