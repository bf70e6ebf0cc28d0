"""Prices and their units as text: number, money and denominator are extracted with regular expressions and the unit's
words are looked up in one alias table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of units, the factor each stands for and the thing it counts ('' = none named).
UNIT_WORDS = [
    ("", "1", ""),
    ("k", "1000", ""),
    ("thousand", "1000", ""),
    ("tausend", "1000", ""),
    ("m", "1000000", ""),
    ("mm", "1000000", ""),
    ("mn", "1000000", ""),
    ("mio", "1000000", ""),
    ("million", "1000000", ""),
    ("millionen", "1000000", ""),
    ("b", "1000000000", ""),
    ("billion", "1000000000", ""),
    ("token", "1", "token"),
    ("tokens", "1", "token"),
    ("tok", "1", "token"),
    ("toks", "1", "token"),
    ("ktok", "1000", "token"),
    ("ktoken", "1000", "token"),
    ("ktokens", "1000", "token"),
    ("mtok", "1000000", "token"),
    ("mtoken", "1000000", "token"),
    ("mtokens", "1000000", "token"),
]
#: What stands in a unit column where no unit is known.
PLACEHOLDERS = ["n/a", "na", "none", "null", "unknown", "tbd", "-", "--", "?"]

SPACE = r"[\s   _]+"
_CENT = r"(?:us\s*)?(?:cents?|¢)"
_OTHER_MONEY = r"€|£|¥|\b(?:eur|gbp|jpy|cny|inr|chf)\b"


def tidy(text: Column) -> Column:
    """Lower case, each run of blanks (also no-break and underscore) one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), SPACE, " "))


def named_unit(unit: Column) -> Column:
    """The tidy unit, or null where it is null, blank or a placeholder."""
    t = tidy(unit)
    return F.when((t != "") & ~t.isin(PLACEHOLDERS), t)


def unit_in_name(name: Column) -> Column:
    """The unit of tokens written inside a free name, tidy, or null. A bare word `tokens` names no unit."""
    t = tidy(name)
    some = r"(?:\d[\d,.]*\s*)?(?:k|m|thousand|million)?\s*-?\s*tok(?:en)?s?"
    forms = [
        rf"\(\s*per\s+([^)]+)\)",
        rf"(?:\bper\s|/)\s*({some})\b",
        r"(?:^|[\s(/-])((?:k|m)tok(?:en)?s?)\b",
        r"(?:^|[\s(/-])(\d[\d,.]*(?:[km]| thousand| million)\s*tok(?:en)?s?)\b",
    ]
    found = [F.regexp_extract(t, f, 1) for f in forms]
    return F.coalesce(*[F.when(x != "", x) for x in found])


def with_unit(df: DataFrame, unit: str, prefix: str) -> DataFrame:
    """Adds ``{prefix}_cents`` (money is cents), ``{prefix}_count`` (things per price, decimal) and ``{prefix}_tokens``.

    ``unit`` is a column of tidy units such as ``us cents / 1k tokens``, ``10^3 tokens``, ``1 gb/month`` or ``mtok``. A
    unit whose words aren't in the alias table has a null count; one that names no thing counts tokens.
    """
    spark = df.sparkSession
    u = F.regexp_replace(F.col(unit), rf"^(?:{_CENT}|us\$|\$|usd)\s*", "")
    u = F.regexp_replace(u, r"^(?:/|per\b|je\b)\s*", "")
    shape = r"^([\d.,]*)(?:\^(\d+))?\s*([a-z]*)\.?\s*(?:of\s+)?([a-z]*)$"
    d = df.withColumn("_u", u).withColumn("_cents", F.col(unit).rlike(rf"^{_CENT}"))
    d = d.withColumn("_parts", F.when(F.col("_u").rlike(shape), F.split(F.regexp_replace("_u", shape, "$1|$2|$3|$4"), r"\|", -1)))
    number = F.regexp_replace(F.col("_parts")[0], r",(?=\d{3}(?:\D|$))", "")
    base = F.when(number == "", F.lit("1")).otherwise(F.regexp_replace(number, ",", "."))
    power = F.when(F.col("_parts")[1] != "", F.pow(base.try_cast("double"), F.col("_parts")[1].try_cast("double")).cast("decimal(20,4)"))
    d = d.withColumn("_qty", F.coalesce(power, base.try_cast("decimal(20,4)")))
    words = unit_words(spark)
    one = words.select(F.col("word").alias("_w1"), F.col("factor").alias("_f1"), F.col("thing").alias("_t1"))
    two = words.select(F.col("word").alias("_w2"), F.col("factor").alias("_f2"), F.col("thing").alias("_t2"))
    d = d.withColumn("_w1", F.col("_parts")[2]).withColumn("_w2", F.col("_parts")[3])
    d = d.join(F.broadcast(one), "_w1", "left").join(F.broadcast(two), "_w2", "left")
    count = (F.col("_qty") * F.col("_f1") * F.col("_f2")).cast("decimal(24,4)")
    ok = F.col("_f1").isNotNull() & F.col("_f2").isNotNull() & (F.col("_qty") > 0)
    d = d.withColumns({
        f"{prefix}_cents": F.coalesce(F.col("_cents"), F.lit(False)),
        f"{prefix}_count": F.when(ok, count),
        f"{prefix}_tokens": ok & ~((F.col("_t1") == "token") & (F.col("_t2") == "token")),
    })
    return d.drop("_u", "_cents", "_parts", "_qty", "_w1", "_w2", "_f1", "_f2", "_t1", "_t2")


def unit_words(spark: SparkSession) -> DataFrame:
    """(word, factor, thing) as a local relation, which needs no job of its own."""
    rows = ", ".join(f"('{w}', {f}, '{t}')" for w, f, t in UNIT_WORDS)
    return spark.sql(f"SELECT word, CAST(factor AS DECIMAL(12, 0)) AS factor, thing FROM VALUES {rows} AS t(word, factor, thing)")


def number_in(text: Column) -> Column:
    """The first number of a text as it is written, blank if there is none."""
    n = F.regexp_extract(text, r"([-+]?\d[\d.,]*(?:[eE][-+]?\d+)?|[-+]?\.\d+(?:[eE][-+]?\d+)?)", 1)
    return F.rtrim(n, F.lit(".,"))


def plain_number(n: Column) -> Column:
    """A number as plain digits with a point, null if it is blank; a comma after which no point comes is a decimal comma, several aren't."""
    point, comma = F.replace(n, F.lit(",")), F.replace(F.replace(n, F.lit(".")), F.lit(","), F.lit("."))
    one_comma = F.length(n) - F.length(point) == 1
    last_comma, last_point = F.instr(F.reverse(n), ","), F.instr(F.reverse(n), ".")
    decimal = F.when(last_point == 0, one_comma).otherwise((last_comma > 0) & (last_comma < last_point))
    return F.when(n == "", F.lit(None)).when(decimal, comma).otherwise(point)


def with_price_text(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: a price written as text, as USD per million tokens (decimal), or null.

    A bare number is USD per token. Null, blank, negative and other currencies give null; zero is a price.
    """
    t = tidy(F.col(text))
    bare = t.rlike(r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:e[-+]?\d+)?$")
    # What is said beside the number is looked at only where there is something beside it.
    d = df.withColumn("_t", t).withColumn("_bare", F.coalesce(bare, F.lit(True)))
    d = d.withColumn("_said", F.when(~F.col("_bare"), F.col("_t")))
    # In columns of their own, so that each is computed once.
    d = d.withColumn("_in", number_in(F.col("_said")))
    d = d.withColumn("_amount", F.when(F.col("_bare"), F.col("_t")).otherwise(plain_number(F.col("_in"))).try_cast("decimal(30,18)"))
    rest = F.regexp_replace("_said", r"[-+]?(?:\d[\d.,]*)(?:e[-+]?\d+)?", "#")
    cents = F.col("_said").rlike(r"¢|\bcents?\b")
    # Behind the price's own number stands the denominator.
    tail = F.regexp_extract("_said", r"^\D*?[-+]?(?:\d[\d.,]*|\.\d+)(?:e[-+]?\d+)?\s*(?:us\s*cents?|cents?|¢|usd|us\$|\$|dollars?)?\s*(?:/|per\b|je\b)?\s*(.*)$", 1)
    money = rest.rlike(r"\$|\busd\b|¢|\bcents?\b|\bdollars?\b")
    d = d.withColumn("_money", F.when(~F.col("_bare"), money & ~F.col("_said").rlike(_OTHER_MONEY))).withColumn("_c", F.when(~F.col("_bare"), cents))
    d = d.withColumn("_unit", F.when(~F.col("_bare"), tail))
    d = with_unit(d, "_unit", "_q")
    amount = F.col("_amount")
    said = F.when(F.col("_money") & F.col("_q_tokens"), per_million(amount, F.col("_c"), F.col("_q_count")))
    # The default of a price alone: dollars for one token.
    alone = per_million(amount, F.lit(False), F.lit(1))
    d = d.withColumn(out, F.when(amount >= 0, F.when(F.col("_bare"), alone).otherwise(said)))
    return d.drop("_t", "_bare", "_said", "_in", "_amount", "_money", "_c", "_unit", "_q_cents", "_q_count", "_q_tokens")


def per_million(amount: Column, cents: Column, count: Column) -> Column:
    """USD per million tokens, decimal(38,12), of ``amount`` dollars (or cents) for ``count`` tokens."""
    factor = (F.lit("1000000").cast("decimal(7,0)") / count.cast("decimal(18,4)")).cast("decimal(18,10)")
    dollars = F.when(cents, amount.cast("decimal(26,16)") * F.lit("0.01").cast("decimal(3,2)")).otherwise(amount.cast("decimal(26,16)")).cast("decimal(20,14)")
    return (dollars * factor).cast("decimal(38,12)")
