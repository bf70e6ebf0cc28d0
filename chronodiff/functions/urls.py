"""URLs: canonical form, and credentials in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of parameter names that hold credentials, and token shapes.
CREDENTIAL_WORDS = ["api_key", "apikey", "api-key", "access_token", "auth", "bearer", "credential", "key", "password", "passwd", "secret", "session", "sig", "signature", "token"]
TOKEN_SHAPES = [r"sk-[A-Za-z0-9_-]{16,}", r"AKIA[0-9A-Z]{16}", r"ghp_[A-Za-z0-9]{20,}", r"AIza[0-9A-Za-z_-]{30,}", r"xox[abpr]-[A-Za-z0-9-]{10,}", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"]

_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, _SHAPE, i)


def is_credential(name: Column) -> Column:
    return F.lower(name).rlike("|".join(CREDENTIAL_WORDS))


def parameters(url: Column) -> Column:
    return F.filter(F.split(_part(url, 5), "&"), lambda p: p != "")


def credential_parameters(url: Column) -> Column:
    """Names of the query parameters that may hold credentials, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(parameters(url), lambda p: F.split_part(p, F.lit("="), F.lit(1))), is_credential)))


def has_credential(url: Column) -> Column:
    """User information, a credential parameter or a token in the URL."""
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#@]*@") | (F.size(credential_parameters(url)) > 0) | url.rlike("|".join(TOKEN_SHAPES))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case; user, default port, fragment and credential parameters dropped. Null if it is no URL."""
    scheme, host, port = F.lower(_part(url, 1)), F.lower(_part(url, 2)), _part(url, 3)
    usual = (port == "") | ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80"))
    kept = F.array_join(F.filter(parameters(url), lambda p: ~is_credential(F.split_part(p, F.lit("="), F.lit(1)))), "&")
    full = F.concat(scheme, F.lit("://"), host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), _part(url, 4), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.rlike(_SHAPE), full)


def host(url: Column) -> Column:
    return F.nullif(F.lower(_part(url, 2)), F.lit(""))


def same_endpoint(a: Column, b: Column) -> Column:
    """Scheme, host with port and path agree: a page link stays on its source."""
    end = lambda u: F.concat_ws("|", F.lower(_part(u, 1)), F.lower(_part(u, 2)), _part(u, 3), _part(u, 4))
    return F.coalesce(a.rlike(_SHAPE) & b.rlike(_SHAPE) & (end(a) == end(b)), F.lit(False))
