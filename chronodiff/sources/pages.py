"""HTML pages to sections: a parser emits blocks, windows over their positions make the sections."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from chronodiff.functions.identity import slug, text_hash

# Elements without content of their own, and those that are no content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIPPED = {"script", "style", "noscript", "svg", "nav", "header", "footer", "aside", "form", "iframe"}


@dataclass(frozen=True)
class Rule:
    """How a page becomes items. ``roots``: elements that hold the content, the first found counts; body is the last resort."""

    kind: str = "headings"
    roots: tuple[str, ...] = ("article", "main")
    levels: tuple[int, ...] = (2, 3)
    hierarchical: bool = False
    model: str | None = None


class _Events(HTMLParser):
    """A page as one list of (what, value, classes): opened and closed elements by name, and texts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, tuple[str, ...]]] = []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.events.append(("open", tag, tuple(c for k, v in attrs if k == "class" and v for c in v.split())))

    def handle_endtag(self, tag):
        if tag not in VOID:
            self.events.append(("close", tag, ()))

    def handle_data(self, data):
        self.events.append(("text", data, ()))


def _chosen(root: str, tag: str, classes: tuple[str, ...]) -> bool:
    return any(c.startswith(root[1:]) for c in classes) if root.startswith(".") else tag == root


def _heard(events: list[tuple], root: str) -> Iterator[tuple[str, str]]:
    """The events inside all elements that ``root`` chooses, without skipped subtrees; `leave` follows each element.

    Extents are counted in elements of one name, so unclosed elements of other names don't matter.
    """
    within = mute = None
    depth = 0
    for what, value, classes in events:
        if within is None:
            if what == "open" and _chosen(root, value, classes):
                within, outer = value, 1
            continue
        if mute is not None:
            depth += (value == mute) * ((what == "open") - (what == "close"))
            mute = mute if depth else None
            continue
        if what == "open" and value in SKIPPED:
            mute, depth = value, 1
        if what != "text" and value == within:
            outer += 1 if what == "open" else -1
            if not outer:
                within = None
                yield "leave", ""
                continue
        yield what, value


def _heading(tag: str) -> int:
    return int(tag[1]) if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" else 0


def _grouped(heard: Iterator[tuple[str, str]]) -> list[tuple[int, str]]:
    """(level, text) of each heading and of each stretch of text between headings. A heading that isn't closed is dropped."""
    out: list[tuple[int, str]] = []
    level, texts = 0, []

    def end(as_level: int) -> None:
        if as_level:
            # Symbols of icon fonts are private characters.
            one = "".join(c for c in "".join(texts) if unicodedata.category(c) not in ("Co", "Cc", "Cf"))
            whole = " ".join(one.split())
        else:
            whole = "\n".join(x for x in (t.strip() for t in texts) if x)
        if whole:
            out.append((as_level, whole))
        texts.clear()

    for what, value in heard:
        if what == "text":
            texts.append(value)
        elif what == "leave":
            if level:
                texts.clear()
            level = 0
            end(0)
        elif what == "open" and not level and _heading(value):
            end(0)
            level = _heading(value)
        elif what == "close" and level and _heading(value):
            end(level)
            level = 0
    if not level:
        end(0)
    return out


def blocks(html: str | None, roots: tuple[str, ...]) -> list[tuple[int, str]]:
    """(level, text) of a page; level 0 is text. The page is read once; the first of the roots with any block counts, then body."""
    page = _Events()
    page.feed(html or "")
    page.close()
    return next((b for b in (_grouped(_heard(page.events, r)) for r in (*roots, "body")) if b), [])


def page_blocks(pages: DataFrame, key: str, html: str, rule: Rule) -> DataFrame:
    """(key, pos, level, text): the blocks of each page in order."""
    kind = pages.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [(k, i, level, t) for k, h in zip(p["k"], p["h"]) for i, (level, t) in enumerate(blocks(h, rule.roots))]
            yield pd.DataFrame(rows, columns=["k", "pos", "level", "text"])

    d = pages.select(pages[key].alias("k"), pages[html].alias("h")).mapInPandas(run, f"k {kind}, pos bigint, level int, text string")
    return d.withColumnRenamed("k", key)


def heading_sections(b: DataFrame, key: str, rule: Rule) -> DataFrame:
    """(key, n, name, heading, text): sections begin at the rule's heading levels and end at a higher heading.

    A name that comes again in a page has its number behind it. In a hierarchical rule names of lower headings follow
    that of the last top heading.
    """
    top = min(rule.levels)
    order = W.partitionBy(key).orderBy("pos")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    opens, ends = F.col("level").isin(list(rule.levels)), (F.col("level") > 0) & (F.col("level") < top)
    b = b.withColumn("_mark", F.when(opens, F.col("pos")).when(ends, -1)).withColumn("_n", F.last("_mark", True).over(so_far))
    if rule.hierarchical:
        b = b.withColumn("_parent", F.last(F.when(opens & (F.col("level") == top), slug("text")).when(ends, ""), True).over(so_far))
    s = b.where(F.col("_n") >= 0)
    name = slug("text")
    if rule.hierarchical:
        name = F.when((F.col("level") > top) & (F.coalesce("_parent", F.lit("")) != ""), F.concat("_parent", F.lit("/"), name)).otherwise(name)
    heads = s.where(opens).select(key, F.col("_n").alias("n"), name.alias("name"), F.col("text").alias("heading"))
    texts = s.where("level = 0").groupBy(key, F.col("_n").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x.text), "\n").alias("text"))
    return numbered(heads.join(texts, [key, "n"], "left").withColumn("text", F.coalesce("text", F.lit(""))), key)


def numbered(sections: DataFrame, key: str) -> DataFrame:
    """Names that come again in a page, with their number behind them."""
    i = F.row_number().over(W.partitionBy(key, "name").orderBy("n"))
    return sections.withColumn("_i", i).withColumn("name", F.when(F.col("_i") > 1, F.concat("name", F.lit("-"), F.col("_i").cast("string"))).otherwise(F.col("name"))).drop("_i")


def date_sections(b: DataFrame, key: str) -> DataFrame:
    """(key, n, name, heading, text) of pages whose lines are a month (`July, 2026`), a day (`Jul 8`) and then its text."""
    lines = b.select(key, "pos", F.posexplode(F.split("text", "\n")).alias("_i", "line")).select(key, (F.col("pos") * 1_000_000 + F.col("_i")).alias("pos"), F.trim("line").alias("line")).where("line <> ''")
    month = F.col("line").rlike(r"^(January|February|March|April|May|June|July|August|September|October|November|December),?\s+\d{4}$")
    day = F.col("line").rlike(r"^(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{1,2}$")
    so_far = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    d = lines.withColumns({"_m": F.last(F.when(month, F.col("line")), True).over(so_far), "_n": F.last(F.when(day, F.col("pos")), True).over(so_far), "_day": day, "_month": month})
    d = d.where(F.col("_n").isNotNull() & ~F.col("_month"))
    heads = d.where("_day").select(key, F.col("_n").alias("n"), F.when(F.col("_m").isNull(), slug("line")).otherwise(F.concat(slug("_m"), F.lit("/"), slug("line"))).alias("name"), F.trim(F.concat_ws(" ", "_m", "line")).alias("heading"))
    texts = d.where("not _day").groupBy(key, F.col("_n").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x.line), "\n").alias("text"))
    return numbered(heads.join(texts, [key, "n"], "left").withColumn("text", F.coalesce("text", F.lit(""))), key)


def imports(pages: DataFrame, key: str, text: str) -> DataFrame:
    """(key, model) of the lines `import x from './model';` of an index, each once."""
    line = pages.select(key, F.explode(F.split(text, r"\r?\n")).alias("l"))
    return line.select(key, F.nullif(F.regexp_extract(F.trim("l"), r"^import\s+\w+\s+from\s+'\./([a-z0-9\-]+)';?$", 1), F.lit("")).alias("model")).where(F.col("model").isNotNull()).distinct()


def section_items(sections: DataFrame, key: str, rule: Rule) -> DataFrame:
    """(key, field_path, value): a model's section as `models[id]` (its first section in a page), any other as `sections[name]`."""
    value = F.to_json(F.struct(text_hash(F.col("text")).alias("content_hash"), "heading"))
    d = sections.withColumn("_id", F.nullif(F.regexp_extract("text", rule.model, 0), F.lit("")) if rule.model else F.lit(None).cast("string"))
    d = d.withColumn("_i", F.when(F.col("_id").isNotNull(), F.row_number().over(W.partitionBy(key, "_id").orderBy("n"))))
    path = F.when(F.col("_i") == 1, F.concat(F.lit("models["), "_id", F.lit("]"))).otherwise(F.concat(F.lit("sections["), "name", F.lit("]")))
    return d.select(key, path.alias("field_path"), value.alias("value"))


def extract(pages: DataFrame, key: str, html: str, rule: Rule) -> DataFrame:
    """(key, field_path, value) of each page by its rule; a page without items has one, the hash of its text."""
    if rule.kind == "imports":
        items = imports(pages, key, html).select(key, F.concat(F.lit("models["), "model", F.lit("]")).alias("field_path"), F.to_json(F.struct(F.col("model").alias("model_id"))).alias("value"))
    else:
        b = page_blocks(pages, key, html, rule)
        items = section_items(date_sections(b, key) if rule.kind == "dates" else heading_sections(b, key, rule), key, rule)
    rest = pages.join(items.select(key).distinct(), key, "left_anti")
    whole = F.to_json(F.struct(text_hash(visible_text(F.col(html))).alias("content_hash")))
    return items.unionByName(rest.select(key, F.lit("page[text-hash]").alias("field_path"), whole.alias("value")))


@F.pandas_udf(T.StringType())
def visible_text(s: pd.Series) -> pd.Series:
    """The text of a page without elements that are no content."""
    return s.map(lambda h: None if h is None else "\n".join(t for _, t in blocks(h, ())))


@F.pandas_udf(T.ArrayType(T.StringType()))
def same_host_paths(html: pd.Series, base: pd.Series) -> pd.Series:
    """Sorted distinct paths of links that stay on the page's host; relative links are resolved."""

    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.found += [v for k, v in attrs if k == "href" and v]

    def one(h, b):
        p = Links()
        p.feed(h or "")
        home, out = urlsplit(b or "").netloc.lower(), set()
        for link in p.found:
            try:
                u = urlsplit(urljoin(b or "", link))
            except ValueError:
                continue
            if u.scheme in ("http", "https") and u.netloc.lower() == home and u.path:
                out.add(u.path)
        return sorted(out)

    return pd.Series([one(h, b) for h, b in zip(html, base)])


def parity(page_text: DataFrame, key: str, text: str, mirror: DataFrame, model: str, least: float = 0.5) -> DataFrame:
    """(key, found, listed, ratio, ok): which part of a mirror's models (of the same key) the page's text contains, to 4 digits."""
    d = mirror.join(page_text, key)
    g = d.groupBy(key).agg(F.count_if(F.col(text).contains(F.col(model))).alias("found"), F.count(F.lit(1)).alias("listed"))
    return g.withColumn("ratio", F.round(F.col("found") / F.col("listed"), 4)).withColumn("ok", F.col("ratio") >= least)
