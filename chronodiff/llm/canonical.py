"""Free-entered names mapped to the entries of a reference list (problem 1).

Method: token-level repair and soft TF-IDF. Each distinct token is joined to the list's vocabulary by edit distance (over
strings with one character left out, so that the join is by equality) and, for short forms, by its first letter. A
token may have several corrections; of the entries that agree with a name in all tokens under some choice of them, the
one with the highest soft TF-IDF counts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodiff.operators.joins import bounded
from chronodiff.session import kept

UNMATCHED = "UNMATCHED"
#: Words of a meter's name that say nothing about the model (direction, scope, tier, unit); a parameter of :func:`map_names`.
NOISE = """inp input in out outp opt output cached cchd cache gl glbl global rgnl regional region dz dzone data zone
 batch btch flex pp priority prio standard std tokens token tok per thousand million k m""".split()
#: Words shorter than this must be exact, or a short form.
REPAIR_LENGTH = 5
#: A provider may be shortened to so many letters.
PROVIDER_LETTERS = 4
#: Most entries of a reference list: it is known to every worker.
LIST_ROWS = 100_000

_UNIT = re.compile(r"\(\s*per [^)]*\)|\bper (?:\d+ ?[km]? ?|thousand |million )?tok\w*|\bper \d+ ?[km]\b|/ ?\d* ?[km]? ?tok\w*|(?<![\d.])\d+(?: ?[km] |[km])tok\w*|\b[km]?tok\w*")
_DATE = re.compile(r"\b20\d\d-\d\d-\d\d\b|(?<![\d.])\d{4,}(?![\d.])")
_TOKEN = re.compile(r"\d+(?:\.\d+)?(?:x\d+(?:\.\d+)?)?b(?![^\W\d_])|\d+ ?[km](?![^\W\d_])|\d+(?:[.p]\d+)*|[^\W\d_]+|[?*#]+")
_ZEROS = re.compile(r"(?:\.0+)+$")
_V = re.compile(r"\bv[ .\-]?(?=\d)")


def plain(text: str) -> str:
    """Lower case without accents, compatible forms (wide digits and the like) replaced, blanks and underscores one space."""
    if not text.isascii():
        t = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text).lower())
        text = "".join(c for c in t if not unicodedata.combining(c))
    return " ".join(text.lower().replace("_", " ").split())


def tokens_of(text: str | None, contexts: frozenset[str] = frozenset()) -> list[str]:
    """The tokens of a name in order: words, and behind them numbers with their role, which begin with `#`.

    Roles: a version `#1.5` (whole numbers next to each other are one version, `.0` at its end doesn't count), a size
    `#70b` or `#8x7b`, a context `#32k`. A number that comes again is a token of its own. Units, date codes and the v of
    a version are left out; so are 1, 10, 100 or 1000 k or m, as units, unless they are among ``contexts``. Null and blank names have no
    tokens.
    """
    t = plain(text or "")
    if "tok" in t or "per " in t:
        t = _UNIT.sub(" ", t)
    t = _DATE.sub(" ", t)
    if "v" in t:
        t = _V.sub(" ", t)
    words: list[str] = []
    numbers: list[str] = []
    last, whole = -2, False
    for i, m in enumerate(_TOKEN.findall(t)):
        if not m[0].isdigit():
            words.append(m)
        elif m[-1] in "kmb":
            n = m.replace(" ", "")
            if m[-1] == "b" or n in contexts or n[:-1] not in ("1", "10", "100", "1000"):
                numbers.append(n)
        elif whole and i == last + 1 and m.isdigit():
            numbers[-1] += f".{m}"
            last = i
        else:
            numbers.append(m.replace("p", "."))
            last, whole = i, m.isdigit()
    for n in numbers:
        n = "#" + (_ZEROS.sub("", n) if "." in n else n)
        while n in words:
            n += "'"
        words.append(n)
    return words


def bare(word: str) -> str:
    """The word without vowels after its first letter, as some abbreviate."""
    return word[:1] + re.sub("[aeiou]", "", word[1:])


@dataclass
class Lexicon:
    """What the reference list knows: its words, the bags of tokens that denote its entries, and the weights of tokens."""

    #: word -> (kind, token, whether it may be misspelled); kinds: family, variant, alias, noise.
    words: dict[str, tuple[str, str, bool]] = field(default_factory=dict)
    #: bag of tokens -> the entry it denotes, None if it is that of several.
    bags: dict[frozenset[str], str | None] = field(default_factory=dict)
    contexts: frozenset[str] = frozenset()
    weights: dict[str, float] = field(default_factory=dict)
    #: token -> bags that hold it.
    index: dict[str, set[frozenset[str]]] = field(default_factory=lambda: defaultdict(set))


def _alias_part(alias: str) -> str:
    """The model's part of an id: behind the provider, before a tag and a revision."""
    return re.sub(r"-v\d+$", "", re.sub(r"^[a-z]+\.(?=[a-z])", "", plain(alias).split("/")[-1].split(":")[0]))


def lexicon(entries: list[dict], noise: list[str] | tuple[str, ...] = NOISE) -> Lexicon:
    """The lexicon of entries (canonical_id, display_name, provider, aliases).

    A display name's bag goes before one that is only an alias'. A bag of several entries denotes none of them:
    :func:`shared_bags` lists those.
    """
    x = Lexicon()
    x.contexts = frozenset(t.strip("#'") for e in entries for t in tokens_of(e["display_name"]) if t[0] == "#" and t[-1] in "km")
    x.contexts |= frozenset(m.replace(" ", "") for e in entries for m in re.findall(r"(?<![\d.])1(?:0{0,3}) ?[km](?![a-z])", plain(e["display_name"] or "")))
    names = {e["canonical_id"]: tokens_of(e["display_name"], x.contexts) for e in entries}
    families = {n[0] for n in names.values() if n and n[0][0] != "#"}
    variants = {w for n in names.values() for w in n[1:] if w[0] != "#"}
    for p in sorted({plain(e["provider"]) for e in entries if e["provider"]}):
        x.words[p[:PROVIDER_LETTERS]] = ("noise", "", False)
        for w in [p, *tokens_of(p)]:
            x.words[w] = ("noise", "", True)
    for w in noise:
        x.words[w] = ("noise", "", True)
    for v in sorted(variants):
        x.words[v] = ("variant", v, True)
    for f in sorted(families):
        x.words.setdefault(bare(f), ("family", f, False))
        x.words[f] = ("family", f, True)

    def put(bag: frozenset[str], entry: str, into: dict) -> None:
        into[bag] = entry if into.get(bag, entry) == entry else None

    shown: dict[frozenset[str], str | None] = {}
    also: dict[frozenset[str], str | None] = {}
    for i, n in names.items():
        if n:
            put(frozenset(n), i, shown)
    for e in entries:
        for alias in sorted({_alias_part(a) for group in (e["aliases"] or {}).values() for a in group or [] if a}):
            tokens = tokens_of(alias, x.contexts)
            said = [w for w in tokens if w[0] != "#"]
            if not said or all(x.words.get(w, ("",))[0] == "noise" for w in said):
                continue
            put(frozenset(tokens), e["canonical_id"], also)
            if not families & set(said):
                whole = "".join(said)
                for w in {*said, whole}:
                    x.words.setdefault(w, ("alias", w, True))
                    x.words.setdefault(bare(w), ("alias", w, False))
                put(frozenset({whole, *(t for t in tokens if t[0] == "#")}), e["canonical_id"], also)
                # A name of its own needs no version.
                put(frozenset({whole}), e["canonical_id"], also)
    x.bags = also | shown
    df = Counter(t for bag in x.bags for t in bag)
    x.weights = {t: math.log(1 + len(x.bags) / n) for t, n in df.items()}
    for bag in x.bags:
        for t in bag:
            x.index[t].add(bag)
    return x


def _dropped(word: Column) -> Column:
    """The word and all strings with one character left out."""
    return F.array_union(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))))


def _one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion, replacement or swap of neighbours apart."""
    swapped = F.exists(F.sequence(F.lit(1), F.length(a) - 1), lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))) == b)
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (F.length(a) > 1) & swapped)


def repairs(tokens: DataFrame, words: dict[str, tuple[str, str, bool]]) -> DataFrame:
    """(token, kind, value, sim): the corrections of each distinct token.

    An exact word has itself alone. Another of at least REPAIR_LENGTH - 1 letters has every word of at least
    REPAIR_LENGTH within one edit, each with its similarity. One that is left, of two letters or more, is the short form of a
    variant word if it has that word's first letter and its letters in their order, and no other variant word does.
    """
    spark = tokens.sparkSession
    vocab = spark.createDataFrame([(w, *v) for w, v in words.items()], "word string, kind string, value string, repaired boolean")
    # Some 50 strings a word of a list of at most LIST_ROWS entries.
    near = bounded(vocab.where(F.col("repaired") & (F.length("word") >= REPAIR_LENGTH)).select("*", F.explode(_dropped(F.col("word"))).alias("_key")))
    exact = tokens.join(bounded(vocab), F.col("token") == F.col("word")).select("token", "kind", "value", F.lit(1.0).alias("sim"))
    new = tokens.join(bounded(vocab.select(F.col("word").alias("token"))), "token", "left_anti")
    t = new.where(F.length("token") >= REPAIR_LENGTH - 1).select("token", F.explode(_dropped(F.col("token"))).alias("_key"))
    c = t.join(near, "_key").select("token", "word", "kind", "value").distinct().where(_one_edit(F.col("token"), F.col("word")))
    close = c.groupBy("token", "kind", "value").agg(F.max(1 - 1 / F.greatest(F.length("token"), F.length("word"))).alias("sim"))
    variants = bounded(vocab.where("kind = 'variant'").select("word", "value"))
    short = new.where(F.col("token").rlike("^[a-z]{2,}$")).join(close.select("token"), "token", "left_anti")
    letters = F.concat(F.lit("^"), F.regexp_replace("token", "(.)", "$1.*"))
    short = short.join(variants, (F.substring("token", 1, 1) == F.substring("word", 1, 1)) & (F.length("token") < F.length("word"))).where(F.regexp_like("word", letters))
    short = short.groupBy("token").agg(F.count(F.lit(1)).alias("_n"), F.max("value").alias("value"), F.max(F.length("token") / F.length("word")).alias("sim")).where("_n = 1")
    return exact.unionByName(close).unionByName(short.select("token", F.lit("variant").alias("kind"), "value", "sim"))


class Matcher:
    """Names to entries, with what is known of their tokens; equal names are looked up once."""

    def __init__(self, lex: Lexicon, known: dict[str, list[tuple[str, str, float]]], remembered: int = 200_000):
        self.lex, self.known, self.remembered = lex, known, remembered
        self.seen: dict[str, str] = {}

    def __call__(self, name: str) -> str:
        got = self.seen.get(name)
        if got is None:
            # Names that differ in what doesn't matter, or in order alone, share their tokens.
            tokens = tokens_of(name, self.lex.contexts)
            got = self.seen.get(key := "\t".join(tokens))
            if got is None:
                got = self.best(tokens) or UNMATCHED
            if len(self.seen) >= self.remembered:
                self.seen.clear()
            self.seen[name] = self.seen[key] = got
        return got

    def units(self, tokens: list[str]) -> list[list[tuple[str, str, float]]] | None:
        """The corrections of each token; None if one has none. Two neighbours of which one is unknown are taken as one word that was split, if that is known."""
        words, known, out, i = [t for t in tokens if t[0] != "#"], self.known, [], 0
        while i < len(words):
            got, step = known.get(words[i]), 1
            if i + 1 < len(words) and (got is None or words[i + 1] not in known):
                joined = [c for c in known.get(words[i] + words[i + 1], ()) if c[0] in ("family", "alias")]
                if joined:
                    got, step = joined, 2
            if not got:
                return None
            out.append(got)
            i += step
        return out + [[("number", t, 1.0)] for t in tokens if t[0] == "#"]

    def best(self, tokens: list[str]) -> str | None:
        """The entry with the highest soft TF-IDF among those that agree in all tokens; None without one, or if the best are several."""
        units = self.units(tokens)
        if not units:
            return None
        bags: set[frozenset[str]] | None = None
        for u in units:
            if not any(kind == "noise" for kind, _, _ in u):
                of = set().union(*(self.lex.index.get(v, ()) for _, v, _ in u))
                bags = of if bags is None else bags & of
                if not bags:
                    return None
        scores: dict[str | None, float] = {}
        for bag in bags or ():
            sims: dict[str, float] = {}
            for u in units:
                in_bag = [(s, v) for _, v, s in u if v in bag]
                if in_bag:
                    s, v = max(in_bag)
                    sims[v] = max(sims.get(v, 0.0), s)
            if len(sims) == len(bag):
                w = self.lex.weights
                norm = sum(w[t] ** 2 for t in bag)
                entry = self.lex.bags[bag]
                # The soft cosine: both bags have the same tokens, so the norms are equal. Ties go to the bag that says more.
                scores[entry] = max(scores.get(entry, (0.0, 0.0)), (sum(s * w[t] ** 2 for t, s in sims.items()) / norm, norm))
        if not scores:
            return None
        top = max(scores.values())
        winners = [e for e, s in scores.items() if s == top]
        return winners[0] if len(winners) == 1 else None


def _listed(reference: DataFrame) -> list[dict]:
    got = reference.select("canonical_id", "display_name", "provider", "aliases").where(F.col("canonical_id").isNotNull()).limit(LIST_ROWS + 1).collect()
    if len(got) > LIST_ROWS:
        raise ValueError(f"a reference list of more than {LIST_ROWS} entries can't be known to every worker")
    return [r.asDict() for r in got]


def shared_bags(reference: DataFrame, noise: list[str] | tuple[str, ...] = NOISE) -> DataFrame:
    """(tokens): bags that are those of several entries; names with them are UNMATCHED."""
    lex = lexicon(_listed(reference), noise)
    return reference.sparkSession.createDataFrame([(" ".join(sorted(b)),) for b, e in lex.bags.items() if e is None], "tokens string")


def distinct_tokens(rows: DataFrame, name: str, contexts: frozenset[str]) -> DataFrame:
    """(token): the words of all names, and neighbours joined; distinct in a batch before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[str] = set()
        for b in batches:
            out: set[str] = set()
            for n in set(b.column(0).to_pylist()):
                w = [t for t in tokens_of(n, contexts) if t[0] != "#"]
                out.update(w)
                out.update(map("".join, zip(w, w[1:])))
            out -= given
            given = given | out if len(given) < 1_000_000 else out
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.string())], names=["token"])

    return rows.select(name).where(F.col(name).isNotNull()).mapInArrow(run, "token string").distinct()


def with_entries(rows: DataFrame, reference: DataFrame, name: str = "meter_name", out: str = "canonical_id", noise: list[str] | tuple[str, ...] = NOISE) -> DataFrame:
    """The rows whose name isn't null, with ``out``: the entry of their name; UNMATCHED where it denotes none.

    A name denotes an entry if its family, numbers and variant words are all those of the entry, or if it is an alias
    name of it. Spelling within one edit, short forms, order, split words, accents, ``noise`` words, and those for provider, date code
    and unit don't matter; any other word makes it UNMATCHED, as do a blank name, a missing version, and tokens that
    fit several entries equally well.

    Rows never shuffle, only distinct tokens do. The reference list (at most LIST_ROWS entries, else this raises) and the
    corrections of tokens (bounded by the list's words, checked) are known to all workers.
    """
    lex = lexicon(_listed(reference), noise)
    # Strings within one edit of a word of n letters, and short forms of it.
    bound = sum(53 * len(w) + 27 + 2 ** min(len(w), 12) for w in lex.words)
    tokens = kept(distinct_tokens(rows, name, lex.contexts))
    fixed = repairs(tokens, lex.words).limit(bound + 1).collect()
    tokens.unpersist()
    if len(fixed) > bound:
        raise ValueError("more corrections than the list's words can have")
    known: dict[str, list[tuple[str, str, float]]] = defaultdict(list)
    for x in fixed:
        known[x.token].append((x.kind, x.value, x.sim))
    matcher = Matcher(lex, dict(known))

    @F.pandas_udf(T.StringType())
    def match(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in names:
            yield s.map(matcher)

    return rows.where(F.col(name).isNotNull()).withColumn(out, match(F.col(name)))


def map_names(rows: DataFrame, reference: DataFrame, key: str = "row_id", name: str = "meter_name", noise: list[str] | tuple[str, ...] = NOISE) -> DataFrame:
    """(key, canonical_id) of :func:`with_entries`."""
    return with_entries(rows.select(key, name), reference, name, noise=noise).select(key, "canonical_id")


def unmatched(rows: DataFrame, reference: DataFrame, name: str = "meter_name", noise: list[str] | tuple[str, ...] = NOISE) -> DataFrame:
    """(name, n): the names that denote no entry, with their numbers of rows; counted before the shuffle."""
    d = with_entries(rows.select(name), reference, name, "_entry", noise).where(F.col("_entry") == UNMATCHED)
    return d.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
