"""Deeply nested records turned into related flat tables (problem 3).

Method: Dewey labelling. Each node of a document gets the path of its ordinals as a label, the parent is found by cutting
the label, and nodes with the same schema path form a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodiff.functions.dewey import nodes
from chronodiff.operators.joins import skew_left_join
from chronodiff.session import kept

#: Objects of price lists whose member names are data.
OFFER_MAPS = ["$.products", "$.terms", "$.terms.*", "$.terms.*.*", "$.terms.*.*.*.priceDimensions", "$.products.*.terms", "$.products[].terms", "$.products.*.terms.*", "$.products[].terms.*", "$.products.*.terms.*.*", "$.products[].terms.*.*",
              "$.terms[].priceDimensions", "$.products[].terms.*[].priceDimensions", "$.products.*.terms.*[].priceDimensions", "$.products[].terms.*.*.priceDimensions", "$.products.*.terms.*.*.priceDimensions"]

_PRODUCT = r"^\$\.products(?:\.\*|\[\])$"
_FEATURE = r"^\$\.products(?:\.\*|\[\])\.features\[\]$"
_TERM = r"^\$(?:\.terms\.\*\.\*\.\*|\.terms\[\]|\.products(?:\.\*|\[\])\.terms\.\*(?:\[\]|\.\*))$"
_PRICE = r"^\$.*\.priceDimensions(?:\.\*|\[\])$"


def up(label: Column, levels: int) -> Column:
    """The label of the ancestor so many levels above."""
    return F.regexp_replace(label, rf"(?:\.\d+){{{levels}}}$", "")


def table(all_nodes: DataFrame, path: str, *columns: Column) -> DataFrame:
    """The flat table of the nodes whose schema path matches a regular expression."""
    return all_nodes.where(F.col("path").rlike(path)).select(*columns)


def offer_nodes(offers: DataFrame) -> DataFrame:
    """(row_id, level, node_key, parent_key, label, fields): products, features, terms and price dimensions of each readable price list.

    A body that is null, blank, cut off, not JSON or no object gives nothing. A product is keyed by its sku (else its
    name in a keyed layout), a term by sku and code, a price by its rate code, else by its name. Nulls in place of
    objects aren't nodes. Rows repeated in a body are rows of the result.
    """
    # Parsed once; the tables are views of the nodes.
    n = kept(nodes(offers, "row_id", "body", OFFER_MAPS))
    f = lambda k: F.element_at("fields", F.lit(k))
    root = table(n, r"^\$$", "row_id", F.coalesce(f("offerCode"), F.lit("")).alias("offer_code"))
    products = table(n, _PRODUCT, "row_id", "label", F.coalesce(f("sku"), "name").alias("node_key"), "fields").where(F.col("node_key").isNotNull())
    features = table(n, _FEATURE, "row_id", "label", f("name").alias("node_key"), "fields", up(F.col("label"), 2).alias("parent_label")).where(F.col("node_key").isNotNull())
    terms = table(n, _TERM, "row_id", "label", F.coalesce(f("sku"), F.split_part("name", F.lit("."), F.lit(1))).alias("sku"), F.coalesce(f("offerTermCode"), F.split_part("name", F.lit("."), F.lit(2))).alias("code"), "fields")
    terms = terms.where(F.col("sku").isNotNull() & F.col("code").isNotNull()).select("row_id", "label", "sku", F.concat_ws(".", "sku", "code").alias("node_key"), "fields")
    prices = table(n, _PRICE, "row_id", "label", F.coalesce(f("rateCode"), "name").alias("node_key"), "fields", up(F.col("label"), 2).alias("parent_label")).where(F.col("node_key").isNotNull())

    out = ["row_id", "level", "node_key", "parent_key", "label", "fields"]
    p = skew_left_join(products, root, ["row_id"]).select("row_id", F.lit("product").alias("level"), "node_key", F.col("offer_code").alias("parent_key"), "label", "fields")
    link = lambda d: d.select("row_id", F.col("label").alias("parent_label"), F.col("node_key").alias("parent_key"))
    fe = features.join(link(products), ["row_id", "parent_label"]).select("row_id", F.lit("feature").alias("level"), "node_key", "parent_key", "label", "fields")
    te = terms.select("row_id", F.lit("term").alias("level"), "node_key", F.col("sku").alias("parent_key"), "label", "fields")
    pr = prices.join(link(terms), ["row_id", "parent_label"]).select("row_id", F.lit("price").alias("level"), "node_key", "parent_key", "label", "fields")
    return p.select(out).unionByName(fe.select(out)).unionByName(te.select(out)).unionByName(pr.select(out))
