"""Canonical values, short hashes and content-addressed ids."""

from __future__ import annotations

import hashlib
import json
import math
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_FIELDS = ("provider", "canonical_model_id", "event_type", "normalized_field_path", "old_value", "new_value")


def canonical(value):
    """Strings in normal form C without outer blanks, whole floats as integers, members canonical; NaN and infinity are refused."""
    if isinstance(value, str):
        return unicodedata.normalize("NFC", value).strip()
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("a number that is not finite has no canonical form")
        return int(value) if value.is_integer() else value
    if isinstance(value, dict):
        return {canonical(k): canonical(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return value


def canonical_json(value) -> str:
    return json.dumps(canonical(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def identity_json(key: dict) -> str:
    """The text that identifies a change; exactly the KEY_FIELDS must be there."""
    if set(key) != set(KEY_FIELDS):
        raise ValueError(f"fields of an identity key: missing or extra {set(key) ^ set(KEY_FIELDS)}")
    return canonical_json(key)


def short_hash(key: dict) -> str:
    return hashlib.sha256(identity_json(key).encode()).hexdigest()[:8]


@F.pandas_udf(T.StringType())
def _canonical_text(s: pd.Series) -> pd.Series:
    def one(t):
        try:
            return None if t is None else canonical_json(json.loads(t))
        except ValueError:
            return None

    return s.map(one)


def canonical_text(json_text: Column) -> Column:
    """Canonical form of a JSON text; null if it is null or not JSON."""
    return _canonical_text(json_text)


def key_text(provider: Column, model: Column, event_type: Column, path: Column, old_json: Column, new_json: Column) -> Column:
    """The identity text of columns, by built-in functions. ``old_json``, ``new_json`` are canonical JSON texts (null: JSON null)."""
    quote = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.array(F.trim(c))), r"^\[|\]$", ""), F.lit("null"))
    null = lambda c: F.coalesce(c, F.lit("null"))
    q = lambda c: F.when(c.isNull(), "null").otherwise(quote(c))
    return F.concat(F.lit('{"canonical_model_id":'), q(model), F.lit(',"event_type":'), q(event_type), F.lit(',"new_value":'), null(new_json), F.lit(',"normalized_field_path":'), q(path), F.lit(',"old_value":'), null(old_json), F.lit(',"provider":'), q(provider), F.lit("}"))


def hash8(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 8)


def event_id(text: Column, observed_at: Column) -> Column:
    """evt_, the UTC day, and the short hash of the identity text."""
    return F.concat(F.lit("evt_"), F.date_format(observed_at, "yyyyMMdd"), F.lit("_"), hash8(text))


def id_matches_day(identifier: Column, observed_at: Column) -> Column:
    return F.coalesce(identifier.rlike(r"^evt_\d{8}_[0-9a-f]{8}$") & (F.substring(identifier, 5, 8) == F.date_format(observed_at, "yyyyMMdd")), F.lit(False))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def collapse(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def text_hash(text: Column, digits: int = 16) -> Column:
    """Hash of the text in normal form C with white space collapsed."""
    return F.substring(F.sha2(collapse(nfc(text)), 256), 1, digits)


def slug(text: Column, most: int | None = 60, default: str = "untitled") -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    if most:
        s = F.regexp_replace(F.substring(s, 1, most), r"-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def file_time(text: Column) -> Column:
    """A time as part of a file name."""
    return F.replace(text, F.lit(":"), F.lit("-"))
