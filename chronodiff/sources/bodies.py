"""Landed bytes to text, JSON and rows. Network access belongs to whatever lands the bytes, never to a query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_text(body: Column) -> Column:
    """A JSON body as text: UTF-16 if it opens with that byte order mark, else UTF-8; a mark is dropped."""
    utf16 = F.hex(F.substring(body, 1, 2)).isin("FFFE", "FEFF")
    return F.regexp_replace(F.when(utf16, F.decode(body, "UTF-16")).otherwise(F.decode(F.encode(F.make_valid_utf8(body.cast("string")), "UTF-8"), "UTF-8")), "^﻿", "")


def text(body: Column) -> Column:
    """A text or HTML body; bytes that are no UTF-8 become the replacement character."""
    return F.make_valid_utf8(body.cast("string"))


#: Decoders by kind of body.
DECODERS: dict[str, Callable[[Column], Column]] = {"json": json_text, "text": text, "html": text, "atom": text, "rss": text}


def too_large(body: Column, most: int) -> Column:
    return F.octet_length(body) > most


def merged_pages(pages: DataFrame, run: list[str], page: str, body: str, most: int = 40) -> DataFrame:
    """run, items: the `Items` of all pages of a run in page order, as JSON texts; fails on a run of more than ``most`` pages.

    A run whose pages are more than allowed, unreadable or not contiguous from 1 must not pass as a snapshot, so it
    raises rather than giving a part.
    """
    p = pages.select(*run, F.col(page).alias("_p"), F.from_json(body, "Items array<string>, NextPageLink string").alias("_b"))
    g = p.groupBy(*run).agg(F.array_sort(F.collect_list(F.struct("_p", F.col("_b.Items").alias("_i")))).alias("_a"), F.count(F.lit(1)).alias("_n"), F.max("_p").alias("_m"), F.count_if(F.col("_b.Items").isNull()).alias("_bad"))
    wrong = (F.col("_n") > most) | (F.col("_n") != F.col("_m")) | (F.col("_bad") > 0)
    return g.select(*run, F.when(wrong, F.raise_error("incomplete or too many pages")).otherwise(F.flatten(F.transform("_a", lambda x: x._i))).alias("items"))


def tree_texts(spark, path: str) -> DataFrame:
    """(path, line, text) of a tree of JSON files (line null: the whole file) and JSONL files (numbered lines that aren't blank)."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path, wholetext=True)
    a = whole.select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("int").alias("line"), F.col("value").alias("text"))
    b = lines.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)
    return a.unionByName(b.where(F.trim("text") != ""))


def text_files(spark, path: str, skip: list[str] = ("/.git/", "/__pycache__/")) -> DataFrame:
    """(path, line, text) of all files of a tree without zero bytes, outside the directories skipped."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    for s in skip:
        f = f.where(~F.col("path").contains(s))
    f = f.where(~F.decode("content", "ISO-8859-1").contains("\x00"))
    return f.select("path", F.posexplode(F.split(text(F.col("content")), "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)
