"""Problems 2 to 6 against plain Python on a given small scale, and on small tables with every kind of odd row."""

import datetime as dt
import json
import os
import random
import zoneinfo
from collections import Counter

import brute
import pytest

from chronodiff.functions import amounts, dewey
from chronodiff.operators import instants, nested, references, snapshots, units
from chronodiff.plans.queries import QUERIES, read
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
T0 = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)


def at(h):
    return T0 + dt.timedelta(hours=h)


def rows(spark, table):
    out = []
    for r in read(spark, SF, table).toLocalIterator():
        d = r.asDict(recursive=True)
        # Session times are UTC; the driver's datetimes carry no zone.
        out.append({k: v.replace(tzinfo=dt.UTC) if isinstance(v, dt.datetime) else v for k, v in d.items()})
    return out


def got(spark, q):
    return Counter(tuple(r) for r in QUERIES[q](spark, SF).collect())


@pytest.fixture(autouse=True, scope="module")
def utc():
    os.environ["TZ"] = "UTC"
    import time

    time.tzset()


def test_changes_whole(spark):
    price = lambda r: brute.prompt_micro(r["pricing"]["prompt"] if r["pricing"] else None)
    want = {("openrouter_models", *x) for x in brute.changes(rows(spark, "openrouter_models"), price)}
    want |= {("statuspage_incidents", *x) for x in brute.changes(rows(spark, "statuspage_incidents"), lambda r: r["status"] and r["status"].strip().lower())}
    assert got(spark, "p2_found") == Counter(want)


def test_offers_whole(spark):
    assert got(spark, "p3_found") == Counter((r["row_id"], *x) for r in rows(spark, "bedrock_offers") for x in brute.offer(r["body"]))


def test_orphans_whole(spark):
    want = brute.orphans(rows(spark, "change_events"), rows(spark, "manifests"), rows(spark, "sources"))
    assert got(spark, "p4_found") == Counter(want)


def test_instants_whole(spark):
    src = {s["source_id"]: s for s in rows(spark, "sources")}
    of = lambda sid: (src[sid]["zone"], src[sid]["date_order"]) if sid in src else (None, "mdy")
    want = Counter()
    for t, c in (("openrouter_models", "created"), ("statuspage_incidents", "created_at"), ("azure_retail_prices", "effective_start_date")):
        for r in rows(spark, t):
            if (v := brute.instant(r[c], *of(r["source_id"]))) is not None:
                want[t, r["row_id"], 0, v] += 1
    for r in rows(spark, "change_events"):
        for p, e in enumerate(r["evidence"] or []):
            if (v := brute.instant(e["fetched_at"], *of(e["source_id"]))) is not None:
                want["change_events", r["row_id"], p, v] += 1
    assert got(spark, "p5_found") == want


def test_prices_whole(spark):
    want = {("azure_retail_prices", r["row_id"], v) for r in rows(spark, "azure_retail_prices") if (v := brute.azure_micro(r)) is not None}
    want |= {("openrouter_models", r["row_id"], v) for r in rows(spark, "openrouter_models") if (v := brute.prompt_micro(r["pricing"]["prompt"] if r["pricing"] else None)) is not None}
    assert got(spark, "p6_found") == Counter(want)


SNAP = "g bigint, s bigint, run timestamp, k string, landed timestamp, row_id bigint, v string, change string"


def changes(spark, data):
    d = spark.createDataFrame(data, SNAP)
    out = snapshots.snapshot_changes(d, ["g"], "s", "run", "k", ["landed", "row_id"], snapshots.row_hash(F.col("v")))
    return {tuple(r) for r in out.collect()}


def test_changes_of_a_series_without_name(spark):
    rows = [(None, 1, at(0), "a", at(0), 1, "x", "-"), (None, 2, at(1), "b", at(1), 2, "x", "-")]
    assert changes(spark, rows) == {(None, 2, "a", "removed"), (None, 2, "b", "added")}


def test_changes_of_odd_rows(spark):
    # Ids of snapshots don't follow time; the later landed of equal keys counts, ties by row; a null key and value are states.
    data = [(1, 9, at(0), "a", at(1), 1, "x", "-"), (1, 9, at(0), None, at(1), 2, None, "-"), (1, 9, at(0), "b", at(1), 3, "x", "-"), (1, 5, at(2), "a", at(5), 4, "x", "-"), (1, 5, at(2), "a", at(3), 5, "y", "-"),
            (1, 5, at(2), None, at(3), 6, "", "-"), (1, 5, at(2), "c", at(3), 7, "z", "-"), (1, 7, at(4), "a", at(5), 8, "q", "-"), (1, 7, at(4), "a", at(5), 9, "x", "-"), (2, 1, at(0), "a", at(1), 10, "n", "-")]
    assert changes(spark, data) == {(1, 5, None, "changed"), (1, 5, "b", "removed"), (1, 5, "c", "added"), (1, 7, "c", "removed"), (1, 7, None, "removed")}
    assert changes(spark, data * 3) == changes(spark, data)
    assert changes(spark, []) == set()


def test_zones_of_many_sources(spark):
    """Sources in zones of every kind, 40 values each over a year; a third are written with their offset. One in thirty is wrong by days."""
    r = random.Random(2)
    zones = ["UTC", "Europe/Berlin", "Asia/Kolkata", "Asia/Tokyo", "Australia/Sydney", "America/New_York", "America/Los_Angeles", "America/Phoenix", "Africa/Lagos", "Asia/Kathmandu", "America/Sao_Paulo", "Europe/London"]
    data = []
    for k, z in enumerate(zones):
        for i in range(60):
            true = dt.datetime(2025, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=r.randrange(365 * 86400))
            landed = true + dt.timedelta(seconds=r.expovariate(1 / 2400))
            said = true + dt.timedelta(days=r.choice([-9, 9])) if i % 30 == 7 else true
            local = said.astimezone(zoneinfo.ZoneInfo(z))
            data.append(("t", 100 * k + i, 0, f"s{k}", local.isoformat() if i % 3 == 0 else local.strftime("%Y-%m-%d %H:%M:%S"), landed, None, k))
    vals = spark.createDataFrame(data, "record_table string, row_id bigint, pos bigint, source_id string, text string, landed_at timestamp, record string, zone int")
    src = spark.createDataFrame([(f"s{k}", None, "mdy") for k in range(len(zones))], "source_id string, zone string, date_order string")
    out = {r.source_id: r.estimated_zone for r in instants.zone_report(vals, src).collect()}
    assert sum(same_history(out[f"s{k}"], z) for k, z in enumerate(zones)) >= 0.9 * len(zones), out
    # Through the records: the lags say nothing, another delivery wrote the same record with its offset.
    true = [dt.datetime(2025, 1, 1, 0, 5, tzinfo=dt.UTC) + dt.timedelta(hours=211 * i) for i in range(30)]
    late = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    twins = [("t", i, 0, "a", t.isoformat(), late, f"r{i}") for i, t in enumerate(true)] + [("t", 50 + i, 0, "a", t.astimezone(zoneinfo.ZoneInfo("America/New_York")).strftime("%Y-%m-%d %H:%M:%S"), late, f"r{i}") for i, t in enumerate(true)]
    vals = spark.createDataFrame(twins, "record_table string, row_id bigint, pos bigint, source_id string, text string, landed_at timestamp, record string")
    got = {r.row_id: r.epoch_us for r in instants.normalise(vals, src, estimate=True).collect()}
    assert all(got[i] == got[50 + i] for i in range(30))


VALS = "record_table string, row_id bigint, pos bigint, source_id string, text string, landed_at timestamp, record string"


def test_zones_by_order(spark):
    """A backlog landed in order much later: lags say nothing of hours. Every second value is written with its offset, and the others lie between."""
    r = random.Random(5)
    zones = ["Asia/Tokyo", "America/New_York", "Europe/Berlin", "Asia/Kolkata", "UTC", "Australia/Sydney"]
    data, true, src = [], {}, [(f"s{k}", None, "mdy") for k in range(len(zones))]
    for k, z in enumerate(zones):
        for i in range(41 * 5):
            # 41 bursts in a year, of values some minutes apart.
            t = dt.datetime(2025, 1, 1, 0, 7, tzinfo=dt.UTC) + dt.timedelta(days=9 * (i // 5), hours=r.randrange(20) if i % 5 == 0 else 0)
            t = t if i % 5 == 0 else data[-1][7] + dt.timedelta(minutes=r.randint(6, 25))
            local = t.astimezone(zoneinfo.ZoneInfo(z))
            landed = dt.datetime(2027, 1, 1, tzinfo=dt.UTC) + dt.timedelta(minutes=i)
            data.append(("t", 1000 * k + i, 0, f"s{k}", local.strftime("%Y-%m-%d %H:%M:%S") if i % 5 in (1, 3) else local.isoformat(), landed, None, t))
            true[1000 * k + i] = (t - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)
    vals = spark.createDataFrame([x[:7] for x in data], VALS)
    sources = spark.createDataFrame(src, "source_id string, zone string, date_order string")
    out = {x.source_id: x.estimated_zone for x in instants.zone_report(vals, sources).collect()}
    assert all(same_history(out[f"s{k}"], z) for k, z in enumerate(zones)), out
    assert {x.row_id: x.epoch_us for x in instants.normalise(vals, sources, estimate=True).collect()} == true


def test_sequence_of_odd_values(spark):
    """Nulls, arrivals together, bare days, repeated and contradicting records, other tables, far neighbours."""
    rows = [("a", 1, "s", "2026-01-01T10:00:00Z", at(1), None), ("a", 2, "s", "2026-01-01 11:00:00", at(2), None), ("a", 3, "s", "2026-01-01 12:00:00", at(2), None), ("a", 4, "s", "2026-01-01", at(3), None),
            ("a", 5, "s", "2026-01-01T13:00:00Z", at(4), None), ("a", 6, "s", "2026-01-04T13:00:00Z", at(5), None), ("a", 7, "s", "2026-01-04 14:00:00", None, None), ("a", 8, None, "2026-01-04 14:00:00", at(6), None),
            ("b", 9, "s", "2026-01-01 10:00:00", at(1), "x"), ("b", 10, "s", "2026-01-01T09:00:00Z", at(7), "x"), ("b", 11, "s", "2026-01-01", at(2), "y"), ("b", 12, "s", "2026-01-01 10:30:00", at(8), "y"),
            ("b", 13, "s", "2026-01-01T09:00:00Z", at(3), "z"), ("b", 14, "s", "2026-01-01T19:00:00Z", at(4), "z"), ("b", 15, "s", "n/a", at(5), "w"), ("b", 16, "s", "2026-01-01 10:40:00", at(6), "v")]
    vals = spark.createDataFrame([(t, i, 0, s, x, at_, rec) for t, i, s, x, at_, rec in rows], VALS)
    src = spark.createDataFrame([("s", None, "mdy")], "source_id string, zone string, date_order string")
    us = lambda h, m=0: (dt.datetime(2026, 1, 1, h, m) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    want = Counter([("s", "a", us(10), None, None, us(11)), ("s", "a", us(10), None, None, us(12)), ("s", "a", None, us(12), us(13), None), ("s", "b", us(9), None, None, us(10, 30)), ("s", "b", None, us(10, 30), None, us(10, 40))])
    assert Counter(tuple(x) for x in instants.sequence_pairs(instants.located(vals, src)).collect()) == want


def same_history(a, b):
    days = [dt.datetime(2025, 1, 1, tzinfo=dt.UTC) + dt.timedelta(days=d) for d in range(365)]
    return all(d.astimezone(zoneinfo.ZoneInfo(a)).utcoffset() == d.astimezone(zoneinfo.ZoneInfo(b)).utcoffset() for d in days)


PRICE_TEXTS = [
    *[("0.0000025", 2500000), ("1e-05", 10000000), ("$2.5/M", 2500000), ("$ 0.003 / thousand tokens", 3000000), ("2,1867 USD je 1 Mio. Tokens", 2186700), ("125¢ / 1M tokens", 1250000), ("0.5 cents per 1K", 5000000), ("USD 3.00 per 1M", 3000000),
     ("0,00 $ / 1M Tokens", 0), ("0", 0), ("-1", None), ("", None), ("  ", None), (None, None), ("3 EUR per 1M", None), ("$1,234.50 per million tokens", 1234500000), ("free", None), ("$3 per image", None)]
]
UNIT_TEXTS = [
    *[("1K", None, 0.003, "USD", 3000000), ("10^6 tokens", "x", 2.5, "usd", 2500000), ("1,000,000", "x", 2.5, "USD", 2500000), ("¢ per 1K tokens", "x", 0.3, "USD", 3000000), ("US cents / 1M tokens", "x", 250.0, "USD", 2500000),
     ("0.5M", "x", 1.0, "USD", 2000000), ("token", "x", 0.0, "USD", 0), ("1", "x", 1e-6, "USD", 1000000), ("1/Month", "x 1K Tokens", 1.0, "USD", None), ("1M Characters", "x", 1.0, "USD", None), ("1 GB", "x", 1.0, "USD", None),
     ("N/A", "Veltra 7 MTok", 2.5, "USD", 2500000), (None, "a per thousand tokens glbl", 0.001, "USD", 1000000), (" ", "a (per 1M)", 4.0, "USD", 4000000), (None, "Veltra 7 Tokens", 1.0, "USD", None), (None, None, 1.0, "USD", None),
     ("1K", "x", None, "USD", None), ("1K", "x", 1.0, "EUR", None), ("1K", "x", 1.0, None, None), ("1K", "x", float("nan"), "USD", None)]
]


def test_price_texts(spark):
    d = amounts.with_price_text(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PRICE_TEXTS)], "i int, p string"), "p", "usd")
    out = {PRICE_TEXTS[r.i]: r.v for r in d.select("i", units.micro(F.col("usd")).alias("v")).collect()}
    assert out == {x: x[1] for x in PRICE_TEXTS}


def test_unit_texts(spark):
    d = spark.createDataFrame([(*x[:4], i) for i, x in enumerate(UNIT_TEXTS)], "u string, n string, p double, c string, _q_tokens int")
    out = units.token_prices(d, "p", "u", "n", "c")
    assert out.columns == ["u", "n", "p", "c", "_q_tokens", "usd_per_mtok"]
    got = {r[0]: r.v for r in out.select("_q_tokens", units.micro(F.col("usd_per_mtok")).alias("v")).collect()}
    assert got == {i: x[4] for i, x in enumerate(UNIT_TEXTS)}


INSTANTS = [
    ("2026-03-08T01:30:00Z", "2026-03-08T01:30:00+00:00"),
    ("2026-03-08 02:30:00", None),  # skipped
    ("2025-11-02 01:30:00", "2025-11-02T05:30:00+00:00"),  # twice: the first
    ("2026-01-05", "2026-01-05T05:00:00+00:00"),
    ("1/2/2026 12:05 AM", "2026-01-02T05:05:00+00:00"),
    ("13/02/2026 10:00", None),
    ("01 June 2026, 11:22:06 CEST", "2026-06-01T09:22:06+00:00"),
    ("Tue, 07 Apr 2026 00:00:00 +0530", "2026-04-06T18:30:00+00:00"),
    ("2026-01-01T00:00:00.123456999Z", "2026-01-01T00:00:00.123456+00:00"),
    ("1700000000", "2023-11-14T22:13:20+00:00"),
    ("1700000000.25", "2023-11-14T22:13:20.250000+00:00"),
    ("1700000000123", "2023-11-14T22:13:20.123000+00:00"),
    ("1700000000123456", "2023-11-14T22:13:20.123456+00:00"),
    ("\t2026-01-01T00:00:00-03\n", "2026-01-01T03:00:00+00:00"),
    ("2026-01-01T00-00-01Z", "2026-01-01T00:00:01+00:00"),
    ("20260101T000000Z", "2026-01-01T00:00:00+00:00"),
    ("2026-07-01 00:00:00 Asia/Tokyo", "2026-06-30T15:00:00+00:00"),
    ("2026-07-01T00:00:00[Mars/Base]", None),
    *[(x, None) for x in ("", "  ", None, "n/a", "null", "TBD", "25:61", "0000-00-00T00:00:00Z", "2026-02-30T10:00:00Z", "2026-01-01T24:00:00Z", "a|b|c|d|e|f|g|h|i", "9" * 40)],
]


def test_instant_texts(spark):
    data = [("t", i, 0, "s", x, T0) for i, (x, _) in enumerate(INSTANTS)]
    vals = spark.createDataFrame(data, "record_table string, row_id bigint, pos bigint, source_id string, text string, landed_at timestamp")
    src = spark.createDataFrame([("s", "America/New_York", "mdy")], "source_id string, zone string, date_order string")
    out = {r.row_id: r.epoch_us for r in instants.normalise(vals, src).collect()}
    want = {i: (dt.datetime.fromisoformat(y) - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1) for i, (_, y) in enumerate(INSTANTS) if y}
    assert out == want
    assert instants.normalise(vals.limit(0), src).count() == 0


def test_zone_of_unknown_source_and_estimate(spark):
    # Local times of Tokyo, each landed ten minutes later; the source declares nothing.
    data = [("t", i, 0, "s", f"2026-03-{1 + i % 28:02d} {i % 24:02d}:00:00", dt.datetime(2026, 3, 1 + i % 28, i % 24, 10, tzinfo=dt.UTC) - dt.timedelta(hours=9)) for i in range(50)]
    vals = spark.createDataFrame(data, "record_table string, row_id bigint, pos bigint, source_id string, text string, landed_at timestamp")
    src = spark.createDataFrame([("other", "UTC", "mdy")], "source_id string, zone string, date_order string")
    assert {r.estimated_zone for r in instants.zone_report(vals, src).collect()} == {"Asia/Tokyo"}
    plain = {r.row_id: r.epoch_us for r in instants.normalise(vals, src).collect()}
    guessed = {r.row_id: r.epoch_us for r in instants.normalise(vals, src, estimate=True).collect()}
    assert all(plain[i] - guessed[i] == 9 * 3600 * 10**6 for i in plain) and len(plain) == 50


def test_dewey_labels():
    value = {"a": [{"x": 1}, None, {"y": {"z": "t"}}], "m": {"k1": {"q": 2}}}
    out = list(dewey.walk(value, frozenset({"$.m"})))
    assert [(x[0], x[1]) for x in out] == [("1", "$"), ("1.1", "$.a"), ("1.1.1", "$.a[]"), ("1.1.2", "$.a[]"), ("1.1.3", "$.a[]"), ("1.1.3.1", "$.a[].y"), ("1.2", "$.m"), ("1.2.1", "$.m.*")]
    assert out[-1][2:] == ("k1", {"q": "2"})
    wrapped = '{"a": 1}'
    for _ in range(8):
        wrapped = json.dumps(wrapped)
    assert dewey.parse(wrapped) == {"a": 1} and dewey.parse('""') is None and dewey.parse('"x"') is None
    assert dewey.parse('"{\\"a\\": 1}"') == {"a": 1} and dewey.parse("﻿[]") == [] and dewey.parse("{") is None and dewey.parse(None) is None


def test_offers_of_odd_bodies(spark):
    bodies = ['{"offerCode": "o", "products": {"A": {"sku": "A", "features": null}, "B": null}, "terms": {"OnDemand": {"Z": {"Z.t": {"offerTermCode": "t", "sku": "Z", "priceDimensions": {"Z.t.r": {}}}}}}}', '{"products": [], "terms": null}', '{"a": ', "", None, "[]", "null", "<html>", "[" * 100_000]
    d = spark.createDataFrame([(i, b, "x") for i, b in enumerate(bodies)], "row_id bigint, body string, label string")
    out = {tuple(r) for r in nested.offer_nodes(d).select("row_id", "level", "node_key", "parent_key").collect()}
    assert out == {(0, "product", "A", "o"), (0, "term", "Z.t", "Z"), (0, "price", "Z.t.r", "Z.t")}
    assert nested.offer_nodes(d.limit(0)).count() == 0


EVENT = "row_id bigint, id string, observed_at timestamp, landed_at timestamp, correction_of string, evidence array<struct<source_id string, manifest_path string>>, key string"


def test_orphans_of_odd_rows(spark):
    ev = spark.createDataFrame([(1, "e1", T0, at(5), "e2", [("s", "m"), (None, None), ("S", "late"), ("old", "gone")], "k"), (2, "e1", T0, at(1), None, [("s", "none")], "k"), (3, "e2", T0, at(9), "e2", None, "k"), (4, None, T0, at(9), "x", None, "k"), (5, "e3", None, at(10), "e1", [], "k"), (6, "e3", None, at(10), "zz", [], "k")], EVENT)
    man = spark.createDataFrame([(1, "m", at(0), None), (2, "late", at(20), None), (3, "gone", at(0), at(3)), (4, None, at(0), None)], "row_id bigint, path string, landed_at timestamp, deleted_at timestamp")
    src = spark.createDataFrame([("s", at(0), None), ("old", at(0), at(4))], "source_id string, added_at timestamp, removed_at timestamp")
    out = {tuple(r) for r in references.orphan_references(ev, man, src).collect()}
    assert out == {("e1", 0, "manifest_path", "2026-01", "missing")}
    # The row delivered first counts: without it the other one's references do.
    out = {tuple(r) for r in references.orphan_references(ev.where("row_id <> 2"), man, src).collect()}
    assert out == {("e1", -1, "correction_of", "2026-01", "late"), ("e1", 2, "source_id", "2026-01", "missing"), ("e1", 2, "manifest_path", "2026-01", "late"), ("e1", 3, "source_id", "2026-01", "deleted"), ("e1", 3, "manifest_path", "2026-01", "deleted")}
    assert references.orphan_references(ev.limit(0), man, src).count() == 0


def test_counts_are_maintained_from_deltas(spark):
    cols = "target_table string, key string, refs int, existence int, at timestamp"
    a = spark.createDataFrame([("t", "k", 1, 0, at(1)), ("t", "k", 1, 0, at(2)), ("t", "x", 0, 1, at(0)), ("t", "x", 1, 0, at(1))], cols)
    b = spark.createDataFrame([("t", "k", 0, 1, at(3)), ("t", "x", 0, -1, at(4))], cols)
    one = references.merge_counts(a)
    assert {r.key for r in references.orphan_keys(one).collect()} == {"k"}
    two = references.merge_counts(b, one)
    assert {r.key for r in references.orphan_keys(two).collect()} == {"x"}
    assert {tuple(r) for r in two.collect()} == {tuple(r) for r in references.merge_counts(a.unionByName(b)).collect()}


def test_orphans_of_a_key_that_comes_back(spark):
    there = spark.createDataFrame([("t", "k", at(1), at(3)), ("t", "k", at(6), None), ("t", "x", at(9), None), ("t", "z", None, None)], "target_table string, key string, at timestamp, gone_at timestamp")
    refs = spark.createDataFrame([(f"{k}{h}", 0, "f", "t", k, "p", at(h)) for k, h in [("k", 0), ("k", 1), ("k", 2), ("k", 3), ("k", 5), ("k", 6), ("k", 7), ("x", 8), ("x", 9), ("y", 5), ("z", 5)]],
                                 "event_id string, pos bigint, field string, target_table string, key string, period string, landed_at timestamp")
    out = {r.event_id: r.kind for r in references.orphans(refs, there).collect()}
    assert out == {"k0": "late", "k3": "deleted", "k5": "deleted", "x8": "late", "y5": "missing", "z5": "missing"}


def test_orphan_keys_of_the_tables(spark):
    ev, man, src = (read(spark, SF, t) for t in ("change_events", "manifests", "sources"))
    first = lambda rows, k: {r[k]: r for r in sorted((r for r in rows if r[k] is not None), key=lambda r: (r.landed_at, r.row_id), reverse=True)}
    e, m = first(ev.collect(), "id"), first(man.collect(), "path")
    ended = {("sources", r.source_id): r.removed_at is not None for r in src.collect()} | {("manifests", p): r.deleted_at is not None for p, r in m.items()} | {("change_events", i): False for i in e}
    refs = Counter(k for r in e.values() for k in [("change_events", r.correction_of), *[k for x in r.evidence for k in (("sources", x.source_id), ("manifests", x.manifest_path))]] if k[1] is not None)
    want = {(*k, n) for k, n in refs.items() if ended.get(k, True)}
    assert want and {(r.target_table, r.key, r.refs) for r in QUERIES["p4_keys"](spark, SF).collect()} == want


def test_skewed_join_keeps_all_rows(spark):
    from chronodiff.operators.joins import skew_left_join

    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("5", 2), ("nobody", 3)], "k string, v int")
    out = skew_left_join(left, right, ["k"])
    assert out.count() == 3000 and out.where("v = 1").count() == 1000 and out.where("v = 2").count() == 1 and out.where("v = 3").count() == 0
    assert skew_left_join(left.limit(0), right, ["k"]).count() == 0
