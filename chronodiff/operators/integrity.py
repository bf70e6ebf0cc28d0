"""Integrity checks of the whole store: each gives rows (code, subject, message); no rows, no error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.functions.identity import id_matches_day
from chronodiff.operators.events import repeated_within
from chronodiff.operators.schemas import Catalogue, schema_errors


def _error(d: DataFrame, code: str, subject: Column, message: Column) -> DataFrame:
    return d.select(F.lit(code).alias("code"), subject.cast("string").alias("subject"), message.alias("message"))


def unreadable(files: DataFrame) -> DataFrame:
    """Files (path, text) that are no JSON."""
    return _error(files.where(F.try_parse_json("text").isNull()), "E-JSON", F.col("path"), F.lit("not readable as JSON"))


def invalid(files: DataFrame, schema: dict, schemas: Catalogue | None = None, code: str = "E-SCHEMA") -> DataFrame:
    """Files (path, text) that break a schema, a row for each error; a registry's document is checked with the code E-REG. Unreadable texts are :func:`unreadable`'s."""
    readable = files.where(F.try_parse_json("text").isNotNull())
    return _error(readable.select("path", F.explode(schema_errors(F.col("text"), schema, schemas)).alias("_m")), code, F.col("path"), F.col("_m"))


def misplaced(files: DataFrame) -> DataFrame:
    """Event files (path, id) that aren't under the year and month of their id, or not named by it."""
    want = F.concat(F.lit("events/"), F.substring("id", 5, 4), F.lit("/"), F.substring("id", 9, 2), F.lit("/"), "id", F.lit(".json"))
    return _error(files.where(~F.coalesce(F.col("path").endswith(want), F.lit(False))), "E-PATH", F.col("path"), F.lit("not in its place"))


def wrong_ids(events: DataFrame) -> DataFrame:
    return _error(events.where(~id_matches_day(F.col("id"), F.col("observed_at"))), "E-ID", F.col("id"), F.lit("malformed, or not of the day observed"))


def duplicates(events: DataFrame) -> DataFrame:
    """Ids that occur more than once, and later events with the hash of one less than 72 hours before."""
    n = events.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    one = events.select("id", "observed_at").dropDuplicates(["id"]).withColumn("hash8", F.substring("id", -8, 8))
    return _error(n, "E-DUP", F.col("id"), F.lit("id occurs more than once")).unionByName(_error(repeated_within(one, ["hash8"], "observed_at", ["id"]), "E-DUP", F.col("id"), F.lit("the same change less than 72 hours before")))


def dangling(rows: DataFrame, key: str, subject: str, targets: DataFrame, target: str, what: str) -> DataFrame:
    """Rows whose key isn't among the targets; null refers to nothing."""
    t = targets.select(F.col(target).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    d = rows.where(F.col(key).isNotNull()).join(t, F.col(key) == F.col("_t"), "left_anti")
    return _error(d, "E-REF", F.col(subject), F.concat(F.lit(f"{what}: "), F.col(key).cast("string")))


def gaps(chain: DataFrame, key: str, seq: str) -> DataFrame:
    """Chains whose numbers aren't 1, 2, 3 ..."""
    d = chain.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(seq)))
    return _error(d.groupBy(key).agg(F.bool_or(F.col(seq) != F.col("_n")).alias("_x")).where("_x"), "E-SEQ", F.col(key), F.lit("numbers are not contiguous"))


def key_mismatch(events: DataFrame, keys: DataFrame) -> DataFrame:
    """Events (id, event_type, provider) whose identity key (event_id, text, event_type, provider) has another hash, type or provider."""
    k = keys.select(F.col("event_id").alias("id"), F.substring(F.sha2("text", 256), 1, 8).alias("_h"), F.col("event_type").alias("_t"), F.col("provider").alias("_p"))
    d = events.join(k, "id").where((F.substring("id", -8, 8) != F.col("_h")) | ~F.col("event_type").eqNullSafe(F.col("_t")) | ~F.col("provider").eqNullSafe(F.col("_p")))
    return _error(d, "E-KEY", F.col("id"), F.lit("identity key does not belong to the event"))


def all_errors(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def check_store(events: DataFrame, manifests: DataFrame, sources: DataFrame) -> DataFrame:
    """(code, subject, message) of events with their evidence against manifests and sources."""
    e = events.select("id", F.explode("evidence").alias("e")).select("id", "e.source_id", "e.manifest_path")
    return all_errors([
        wrong_ids(events),
        duplicates(events),
        dangling(events, "correction_of", "id", events, "id", "corrects"),
        dangling(e, "source_id", "id", sources, "source_id", "source"),
        dangling(e, "manifest_path", "id", manifests, "path", "manifest"),
    ])
