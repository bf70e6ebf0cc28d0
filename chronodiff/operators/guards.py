"""Scanners of texts for credentials and personal data, and checks of who wrote where."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodiff.functions.urls import TOKEN_SHAPES, credential_parameters
from chronodiff.operators.joins import bounded

# Header names that carry credentials.
SECRET_HEADERS = ["authorization", "proxy-authorization", "cookie", "set-cookie", "x-api-key", "api-key", "x-auth-token"]
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"


def pointers(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pointer, name, value) of every scalar of JSON texts at any depth; an unreadable text gives none."""
    kind = docs.schema[key].dataType.simpleString()

    def walk(v):
        stack = [("", "", v)]
        while stack:
            at, name, x = stack.pop()
            if isinstance(x, dict):
                stack += [(f"{at}/{k.replace('~', '~0').replace('/', '~1')}", k, y) for k, y in x.items()]
            elif isinstance(x, list):
                stack += [(f"{at}/{i}", name, y) for i, y in enumerate(x)]
            else:
                yield at, name, x if isinstance(x, str) or x is None else json.dumps(x)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for k, t in zip(p["k"], p["t"]):
                try:
                    rows += [(k, *x) for x in walk(json.loads(t))]
                except (TypeError, ValueError):
                    continue
            yield pd.DataFrame(rows, columns=["k", "pointer", "name", "value"])

    d = docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInPandas(run, f"k {kind}, pointer string, name string, value string")
    return d.withColumnRenamed("k", key)


def secrets(nodes: DataFrame, key: str) -> DataFrame:
    """(key, pointer, why) of scalars that hold a credential: by their header's name, by a URL's parameters, by the shape of a token."""
    why = F.when(F.lower("name").isin(SECRET_HEADERS), "header").when(F.col("value").rlike("^[A-Za-z]+://") & (F.size(credential_parameters(F.col("value"))) > 0), "parameter").when(F.col("value").rlike("|".join(TOKEN_SHAPES)), "token")
    return nodes.withColumn("why", why).where(F.col("why").isNotNull() & F.col("value").isNotNull() & (F.col("value") != "")).select(key, "pointer", "why")


def masked(email: Column, shown: int = 1) -> Column:
    """An address with all but the first characters of its name hidden."""
    return F.concat(F.substring(email, 1, shown), F.lit("***@"), F.substring_index(email, "@", -1))


def emails(lines: DataFrame, key: str, line: str, text: str, allowed: list[str] = ()) -> DataFrame:
    """(key, line, masked) of each address found, but for those of allowed domains."""
    d = lines.select(key, line, F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({EMAIL})"), 1)).alias("_m"))
    return d.where(~F.lower(F.substring_index("_m", "@", -1)).isin(list(allowed))).select(key, line, masked(F.col("_m")).alias("masked"))


def allowed(path: Column, prefixes: list[str]) -> Column:
    """Whether a path is one of the prefixes, or under one."""
    out = F.lit(False)
    for p in prefixes:
        out = out | (path == p.rstrip("/")) | path.startswith(p.rstrip("/") + "/")
    return out


def text_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, text): the lines of each text from 1."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def forbidden_pair(path: Column, pair: str) -> Column:
    """Whether two directories stand next to each other in a path."""
    return F.lower(path).rlike(rf"(^|/){pair}(/|$)")


def out_of_scope(writes: DataFrame, scopes: DataFrame) -> DataFrame:
    """Writes (writer, path) that no scope (pattern of the writer, prefix of the path) allows."""
    return writes.join(bounded(scopes), F.regexp_like(writes.writer, scopes.pattern) & writes.path.startswith(scopes.prefix), "left_anti")


def rewrites(changes: DataFrame, prefixes: list[str]) -> DataFrame:
    """(status, path) of changes in a name-status list (column line) other than additions under append-only prefixes; a rename counts for both paths."""
    p = F.split("line", "\t")
    d = changes.select(F.substring(p[0], 1, 1).alias("status"), F.explode(F.slice(p, F.lit(2), F.size(p) - 1)).alias("path"))
    return d.where((F.col("status") != "A") & F.col("path").rlike("^(" + "|".join(prefixes) + ")"))
