"""Append-only tables: what is read as of now is a view, what is written is only what isn't there yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.operators.joins import bounded

#: An event's id: its day and the hash of its key.
EVENT_ID = r"^evt_\d{8}_[0-9a-f]{8}$"


def latest_snapshot(snapshots: DataFrame, series: str = "source_id", run: str = "run_ts") -> DataFrame:
    """All rows of the latest run of each series."""
    last = snapshots.groupBy(series).agg(F.max(run).alias(run))
    return snapshots.join(last, [series, run], "left_semi")


def absent(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The new rows whose key isn't stored; of equal new keys one (the smallest row as JSON text)."""
    one = new.groupBy(key).agg(F.min_by(F.struct(*new.columns), F.to_json(F.struct(*new.columns))).alias("_r")).select("_r.*")
    return one.join(stored.select(key), key, "left_anti").select(new.columns)


def insert_absent(new: DataFrame, path: str, key: str) -> DataFrame:
    """Appends the absent rows to a Parquet table and returns them as read back before the append was visible."""
    spark = new.sparkSession
    try:
        stored = spark.read.schema(new.schema).parquet(path)
        rows = absent(new, stored, key)
    except Exception as e:  # the table's first write
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = absent(new, new.limit(0), key)
    rows.write.mode("append").parquet(path)
    return rows


def next_seq(new: DataFrame, chain: DataFrame, key: str, order: list[str], seq: str = "seq") -> DataFrame:
    """New entries numbered on from the greatest number of their key's chain, in ``order``."""
    top = chain.groupBy(key).agg(F.max(seq).alias("_top"))
    n = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return new.join(top, key, "left").withColumn(seq, (F.coalesce("_top", F.lit(0)) + n).cast("bigint")).drop("_top")


def chains(entries: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """(key, entries): each key's entries in order of their numbers."""
    return entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(seq, *[c for c in entries.columns if c not in (key, seq)]))).alias("entries"))


def safe_path(path):
    """Neither absolute nor climbing out."""
    return ~path.rlike(r"^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)")


def existing_manifests(cited: DataFrame, path: str, manifests: DataFrame) -> DataFrame:
    """The cited rows whose manifest exists under a safe path."""
    return cited.where(safe_path(F.col(path))).join(manifests.select(F.col("path").alias(path)).distinct(), path, "left_semi")


def publish_run(tables: dict[str, DataFrame], root: str, run_id: str) -> None:
    """Writes all tables of a run under its own folder, and last one row to ``runs``; readers join on it, so a run is seen whole or not at all."""
    for name, df in tables.items():
        df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").parquet(f"{root}/{name}/run_id={run_id}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("append").parquet(f"{root}/runs")


def published(spark, root: str, name: str) -> DataFrame:
    """The rows of a table from published runs."""
    runs = spark.read.parquet(f"{root}/runs").distinct()
    return spark.read.option("recursiveFileLookup", True).parquet(f"{root}/{name}").join(bounded(runs), "run_id", "left_semi")


def upsert(state: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the row with the greatest ``order`` of both: caches of validators, stances and sentinels."""
    both = state.unionByName(new)
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), F.col(order)).alias("_r")).select(key, "_r.*").select(state.columns)


def manifest_path(source_id: Column, fetched_at: Column, page: Column) -> Column:
    """Where the manifest of a fetched body lies; a further page of a source has the suffix `.pN`."""
    suffix = F.when(F.coalesce(page, F.lit(1)) > 1, F.concat(F.lit(".p"), page.cast("string"))).otherwise("")
    return F.concat(F.lit("manifests/evidence/"), source_id, F.lit("/"), F.date_format(fetched_at, "yyyy-MM-dd'T'HH-mm-ss'Z'"), suffix, F.lit(".meta.json"))


def manifest_record(df: DataFrame) -> DataFrame:
    """(path, source_id, url, fetched_at, http_status, sha256_full, sha256_stored) of fetched bodies (columns body, stored, page).

    The stored hash is null where the stored bytes are the whole.
    """
    full, stored = F.sha2("body", 256), F.sha2("stored", 256)
    return df.select(manifest_path(F.col("source_id"), F.col("fetched_at"), F.col("page")).alias("path"), "source_id", "url", "fetched_at", "http_status",
                     full.alias("sha256_full"), F.nullif(stored, full).alias("sha256_stored"))


def event_ids(events: DataFrame, id_: str = "id") -> DataFrame:
    """(id): the well-formed ids, each once, in order."""
    return events.where(F.col(id_).rlike(EVENT_ID)).select(F.col(id_).alias("id")).distinct().orderBy("id")


def by_month(events: DataFrame, id_: str = "id") -> DataFrame:
    """``events`` with the ``year`` and ``month`` that their ids name, by which they are stored."""
    return events.withColumns({"year": F.substring(id_, 5, 4), "month": F.substring(id_, 9, 2)})


def write_events(events: DataFrame, path: str, id_: str = "id") -> None:
    """Appends events under the year and month of their ids."""
    by_month(events, id_).write.mode("append").partitionBy("year", "month").parquet(path)


def events_of(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """The stored events of some ids; only the partitions that the ids name are read."""
    months = sorted({(i[4:8], i[8:10]) for i in ids})
    place = F.concat_ws("-", "year", "month").isin([f"{y}-{m}" for y, m in months]) & F.col("year").isin(sorted({y for y, _ in months}))
    stored = spark.read.option("basePath", path).schema(_with_text_partitions(spark, path)).parquet(path)
    return stored.where(place).where(F.col("id").isin(ids)).drop("year", "month")


def _with_text_partitions(spark: SparkSession, path: str):
    """The table's schema with partitions as texts, as `01` isn't the number 1."""
    from pyspark.sql import types as T

    fields = [f for f in spark.read.parquet(path).schema if f.name not in ("year", "month")]
    return T.StructType([*fields, T.StructField("year", T.StringType()), T.StructField("month", T.StringType())])


def pretty(row: Column) -> Column:
    """A struct or map as JSON of two blanks a level."""
    return F.to_json(row, {"pretty": "true", "ignoreNullFields": "false"})


def write_json(rows: DataFrame, path: str, as_lines: bool = True) -> bool:
    """Writes small tables such as reports and queues as JSON, a line a row, or each row alone and readable; no rows, no files. True if it wrote.

    Columns named emitter, collector or run_ts are folders.
    """
    if rows.isEmpty():
        return False
    folders = [c for c in ("emitter", "collector", "run_ts") if c in rows.columns]
    if not as_lines:
        rows = rows.select(*folders, pretty(F.struct(*[c for c in rows.columns if c not in folders])).alias("value"))
    w = rows.write.mode("append").partitionBy(*folders)
    w.json(path) if as_lines else w.text(path)
    return True


def write_if_green(state: DataFrame, errors: DataFrame, path: str) -> bool:
    """Replaces the derived state if there is no error; else what is there stays. True if it wrote."""
    if not errors.isEmpty():
        return False
    state.write.mode("overwrite").parquet(path)
    return True


def drafts(reports: DataFrame) -> DataFrame:
    """(id, run): the events that run reports (run, report: JSON) name for review, under any of their collectors, each once with its first run."""
    each = F.explode(F.from_json(F.get_json_object("report", "$.collectors"), "map<string,struct<verdict_drafts array<struct<event_id string>>>>")).alias("collector", "c")
    d = reports.select("run", each).select("run", F.explode("c.verdict_drafts.event_id").alias("id")).where(F.col("id").isNotNull())
    return d.groupBy("id").agg(F.min("run").alias("run"))


def review_order(hinted: DataFrame, swept: DataFrame) -> DataFrame:
    """(id, hinted): what is to be reviewed, hinted ids first, then the rest, each once, in order of ids."""
    d = hinted.select("id", F.lit(True).alias("hinted")).unionByName(swept.select("id", F.lit(False).alias("hinted")))
    return d.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("hinted").alias("hinted")).orderBy(F.col("hinted").desc(), "id")


def write_evidence(df: DataFrame, root: str) -> DataFrame:
    """Appends fetched bodies (columns as for :func:`manifest_record`) and their manifests, and returns the manifests.

    ``evidence`` holds (path, body), the bytes as they are stored, under their source; the path is the manifest's without its suffix.
    """
    manifests = manifest_record(df)
    stored = df.withColumn("body", F.coalesce("stored", "body"))
    named = manifest_path(F.col("source_id"), F.col("fetched_at"), F.col("page"))
    stored.select("source_id", F.regexp_replace(named, r"\.meta\.json$", "").alias("path"), "body").write.mode("append").partitionBy("source_id").parquet(f"{root}/evidence")
    manifests.write.mode("append").parquet(f"{root}/manifests")
    return manifests


def append_audit(spark: SparkSession, log: list[dict], path: str) -> None:
    """Appends a connector's log of requests (source_id, url, status, attempt) to the audit table; one fetch's few rows."""
    if log:
        spark.createDataFrame([(x["source_id"], x["url"], x["status"], x["attempt"]) for x in log], "source_id string, url string, status int, attempt int").coalesce(1).write.mode("append").json(path)
