"""Plain Python versions of the dealt operators of the core, written apart from them, for comparison on small tables."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from datetime import UTC, datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

TOKEN_WORDS = {"tok", "toks", "token", "tokens"}
SCALES = {"k": 1000, "thousand": 1000, "m": 10**6, "million": 10**6, "mio": 10**6, "mtok": 10**6, "mtokens": 10**6}


def unit(text):
    """(cents, number of tokens) of a unit text, or None."""
    t = text.lower().strip()
    cents = "¢" in t or "cent" in t
    t = re.sub(r"^(us )?(cents?|¢|\$|usd)", "", t).strip()
    t = re.sub(r"^(/|per|je)", "", t).strip()
    number, words = Decimal(1), []
    for part in re.findall(r"10\^\d+|[\d,.]+|[a-z]+|\S", t):
        if part.startswith("10^"):
            number *= 10 ** int(part[3:])
        elif part[0].isdigit():
            number *= Decimal(part.replace(",", ""))
        elif part == ".":
            continue
        else:
            words.append(part)
    for w in words:
        if w in SCALES:
            number *= SCALES[w]
        elif w not in TOKEN_WORDS:
            return None
    return cents, number


def micro(amount, cents, count):
    usd = amount / 100 if cents else amount
    return int((usd * 10**12 / count).quantize(Decimal(1), ROUND_HALF_UP))


def azure_micro(row):
    if row["retail_price"] is None or (row["currency_code"] or "").lower() != "usd":
        return None
    u = (row["unit_of_measure"] or "").strip()
    if u.lower() in ("", "n/a"):
        name = re.sub(r"[\s _]+", " ", (row["meter_name"] or "").lower())
        m = re.search(r"per (thousand|million) tokens|/(1[km]) tok|\(per (1[km])\)|\b(1[km]) tokens|\b(mtok)\b|per (token)", name)
        if not m:
            return None
        u = next(g for g in m.groups() if g)
    got = unit(u)
    return None if got is None else micro(Decimal(repr(row["retail_price"])), *got)


def prompt_micro(text):
    t = (text or "").strip()
    if not t:
        return None
    try:
        v = Decimal(t)
        return None if v < 0 else micro(v, False, 1)
    except ArithmeticError:
        pass
    m = re.match(r"^(?:usd|\$)?\s*([\d.,]+)\s*(usd|\$|¢|cents?)?\s*(?:/|per|je)\s*(.*)$", t.lower())
    n = m[1].replace(",", ".") if "," in m[1] and "." not in m[1] else m[1].replace(",", "")
    return micro(Decimal(n), m[2] in ("¢", "cent", "cents"), unit(m[3])[1])


ABBR = {"UTC": 0, "GMT": 0, "Z": 0, "PST": -8, "PDT": -7, "EST": -5, "EDT": -4, "CET": 1, "CEST": 2, "JST": 9}


def instant(text, zone, order):
    t = (text or "").strip()
    if re.fullmatch(r"\d+(\.\d+)?", t):
        v = Decimal(t)
        return int(v * (10**6 if v < 10**11 else 10**3 if v < 10**14 else 1))
    frac, at, wall, where = 0, None, None, None
    if m := re.search(r"[.](\d+)(?=$|[zZ+\-\[ ])", t):
        if not re.match(r"\d+\.\d+\.\d{4}", t):
            frac, t = int((m[1] + "000000")[:6]), t[: m.start()] + t[m.end() :]
    if m := re.search(r"\[?([A-Z][A-Za-z]+/[A-Za-z_]+)\]?$", t):
        where, t = m[1], t[: m.start()].strip()
    elif m := re.search(r" ([A-Z]{1,4})$", t):
        if m[1] not in ("AM", "PM"):
            at, t = timezone(timedelta(hours=ABBR[m[1]])), t[: m.start()].strip()
    t = re.sub(r"^[A-Z][a-z]{2}, ", "", t)
    t = re.sub(r"^(\d{4}-\d\d-\d\dT\d\d)-(\d\d)-(\d\d)Z$", r"\1:\2:\3Z", t)
    if re.match(r"\d{4}-\d\d-\d\d[Tt ].*[+-]\d\d$", t):
        t += "00"
    t = re.sub(r"[zZ]$", "+0000", t)
    slash = ("%d/%m/%Y", "%d.%m.%Y") if order == "dmy" else ("%m/%d/%Y", "%m.%d.%Y")
    days = ("%Y-%m-%d", "%Y%m%d", "%d %b %Y", "%d %B %Y", "%d %B %Y,", "%b %d, %Y", *slash)
    for d in days:
        for h in ("", "T%H:%M:%S", "t%H:%M:%S", "T%H%M%S", " %H:%M:%S", " %H:%M", " %I:%M %p"):
            for z in ("", "%z", " %z"):
                try:
                    wall = datetime.strptime(t, d + h + z)
                except ValueError:
                    continue
                break
            if wall:
                break
        if wall:
            break
    if not wall:
        return None
    if wall.tzinfo is None and at is not None:
        wall = wall.replace(tzinfo=at)
    if wall.tzinfo is None:
        z = ZoneInfo(where or zone or "UTC")
        there = wall.replace(tzinfo=z)
        if there.astimezone(UTC).astimezone(z).replace(tzinfo=None) != wall:
            return None
        wall = there
    return (wall.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1) + frac


def changes(rows, state):
    """rows: dicts; -> (snapshot_id, id, change)."""
    best, run, feed = {}, {}, {}
    for r in rows:
        k = (r["snapshot_id"], r["id"])
        if k not in best or (r["landed_at"], r["row_id"]) > (best[k]["landed_at"], best[k]["row_id"]):
            best[k] = r
        run[r["snapshot_id"]], feed[r["snapshot_id"]] = r["run_ts"], r["feed_id"]
    content, series = defaultdict(dict), defaultdict(list)
    for (s, i), r in best.items():
        content[s][i] = state(r)
    for s in run:
        series[feed[s]].append((run[s], s))
    out = set()
    for v in series.values():
        v.sort()
        for (_, a), (_, b) in zip(v, v[1:]):
            for i in content[a].keys() | content[b].keys():
                if i not in content[a]:
                    out.add((b, i, "added"))
                elif i not in content[b]:
                    out.add((b, i, "removed"))
                elif content[a][i] != content[b][i]:
                    out.add((b, i, "changed"))
    return out


def first(rows, key):
    out = {}
    for r in rows:
        k = r[key]
        if k is not None and (k not in out or (r["landed_at"], r["row_id"]) < (out[k]["landed_at"], out[k]["row_id"])):
            out[k] = r
    return out


def orphans(events, manifests, sources):
    ev, man, src, out = first(events, "id"), first(manifests, "path"), {s["source_id"]: s for s in sources}, set()
    for i, e in ev.items():
        refs = [(p, f, x[f]) for p, x in enumerate(e["evidence"] or []) for f in ("source_id", "manifest_path")] + [(-1, "correction_of", e["correction_of"])]
        for pos, field, key in refs:
            if key is None:
                continue
            t = {"source_id": src, "manifest_path": man, "correction_of": ev}[field].get(key)
            born, gone = (None, None) if t is None else (t["added_at"], t["removed_at"]) if field == "source_id" else (t["landed_at"], t.get("deleted_at"))
            kind = "missing" if t is None else "late" if born > e["landed_at"] else "deleted" if gone is not None and gone <= e["landed_at"] else None
            if kind:
                out.add((i, pos, field, e["observed_at"].strftime("%Y-%m"), kind))
    return out


def offer(body):
    """[(level, key, parent)] of a price list."""
    try:
        v = json.loads((body or "").lstrip("﻿"))
        v = json.loads(v) if isinstance(v, str) else v
    except ValueError:
        return []
    if not isinstance(v, dict):
        return []
    out, terms = [], []
    products = v.get("products") or []
    for p in products.values() if isinstance(products, dict) else products:
        out.append(("product", p["sku"], v.get("offerCode") or ""))
        out += [("feature", f["name"], p["sku"]) for f in p.get("features") or []]
        for ts in (p.get("terms") or {}).values():
            terms += ts
    top = v.get("terms") or []
    if isinstance(top, dict):
        terms += [t for kind in top.values() for by_sku in kind.values() for t in by_sku.values()]
    else:
        terms += top
    for t in terms:
        key = f"{t['sku']}.{t['offerTermCode']}"
        out.append(("term", key, t["sku"]))
        dims = t.get("priceDimensions") or []
        for k, d in dims.items() if isinstance(dims, dict) else [(None, d) for d in dims]:
            out.append(("price", d.get("rateCode") or k, key))
    return out
