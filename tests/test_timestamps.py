"""Notations, zones and clock changes, against the standard library's zone rules."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from feedloom.operators import timestamps as ts

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def us(*parts, zone="UTC", micro=0):
    return (datetime(*parts, tzinfo=ZoneInfo(zone)) - EPOCH) // timedelta(microseconds=1) + micro


CASES = [
    ("2024-05-01T10:20:30Z", "Asia/Tokyo", "dmy", us(2024, 5, 1, 10, 20, 30)),
    ("2024-05-01t10:20:30z", "Asia/Tokyo", "dmy", us(2024, 5, 1, 10, 20, 30)),
    ("2024-05-01T10:20:30.123456789Z", "UTC", "dmy", us(2024, 5, 1, 10, 20, 30, micro=123456)),
    ("2024-05-01T10:20:30,5Z", "UTC", "dmy", us(2024, 5, 1, 10, 20, 30, micro=500000)),
    ("2024-05-01T10:20:30-0530", "UTC", "dmy", us(2024, 5, 1, 15, 50, 30)),
    ("2024-05-01T10:20:30+02", "UTC", "dmy", us(2024, 5, 1, 8, 20, 30)),
    ("2023-12-27T03:10:03-05:00[America/New_York]", "UTC", "dmy", us(2023, 12, 27, 8, 10, 3)),
    ("2024-01-04T14:58:39[Europe/Paris]", "UTC", "dmy", us(2024, 1, 4, 13, 58, 39)),
    ("20240501T102030Z", "Asia/Tokyo", "dmy", us(2024, 5, 1, 10, 20, 30)),
    ("20240501102030", "Asia/Tokyo", "dmy", us(2024, 5, 1, 1, 20, 30)),
    (" 1714558830 \n", "Asia/Tokyo", "dmy", 1714558830 * 10**6),
    ("1714558830123", "Asia/Tokyo", "dmy", 1714558830123 * 10**3),
    ("2024-05-01", "America/New_York", "dmy", us(2024, 5, 1, 4, 0, 0)),
    ("2024/05/01 10:20", "Europe/London", "dmy", us(2024, 5, 1, 9, 20)),
    ("03/04/2024 13:05", "UTC", "dmy", us(2024, 4, 3, 13, 5)),
    ("03/04/2024 1:05 PM", "UTC", "mdy", us(2024, 3, 4, 13, 5)),
    ("03/04/2024 12:05 AM", "UTC", "mdy", us(2024, 3, 4, 0, 5)),
    ("03.04.2024 13:05", "Europe/Berlin", "dmy", us(2024, 4, 3, 11, 5)),
    ("Mon, 4 Mar 2024 10:00:00 EST", "America/New_York", "mdy", us(2024, 3, 4, 15)),
    ("04 Jul 2024 10:00:00 IST", "Asia/Kolkata", "dmy", us(2024, 7, 4, 4, 30)),
    ("04 Jul 2024 10:00:00 IST", "Europe/Dublin", "dmy", us(2024, 7, 4, 9)),
    ("12. Dezember 2021 12:52 Uhr", "Europe/Berlin", "dmy", us(2021, 12, 12, 11, 52)),
    ("18 décembre 2022 à 23h47", "Europe/Paris", "dmy", us(2022, 12, 18, 22, 47)),
    ("25 de julio de 2021, 20:24", "Europe/Madrid", "dmy", us(2021, 7, 25, 18, 24)),
    ("February 23, 2024 2:03 PM", "America/Chicago", "mdy", us(2024, 2, 23, 20, 3)),
    ("2023-11-05 01:30:00", "America/New_York", "mdy", us(2023, 11, 5, 5, 30)),  # occurs twice: the earlier one
    ("2024-03-10 02:30:00", "America/New_York", "mdy", us(2024, 3, 10, 7, 30)),  # skipped: the offset before
    *[(v, "UTC", "dmy", None) for v in (None, "", " ", "TBA", "n.d.", "-", "0001-01-01", "0000-00-00", "2024-13-45", "2024-02-30", "Spring issue", "32/01/2024 10:00", "13:05", "x" * 100_000)],
    ("2024-05-01 10:20", None, "dmy", None),
    ("2024-05-01 10:20", "No/Zone", "dmy", None),
    ("04 Jul 2024 10:00:00 QQT", "UTC", "dmy", None),
]


def test_values(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, v string, z string, o string")
    got = {r.i: r.utc for r in ts.to_utc_us(df, "v", "z", "o", "utc").collect()}
    assert {i: got[i] for i in got if got[i] != CASES[i][3]} == {}


@pytest.mark.parametrize("session", ["America/New_York", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        test_values(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_against_the_zone_rules(spark):
    rows = [(f"{2021 + k % 5}-{1 + k % 12:02}-{1 + k % 28:02} {k % 24:02}:{k % 60:02}:{k * 7 % 60:02}", z) for k in range(400) for z in ("America/New_York", "Europe/London", "Australia/Sydney", "Asia/Kolkata")]
    got = ts.to_utc_us(spark.createDataFrame(rows, "v string, z string").withColumn("o", F.lit("dmy")), "v", "z", "o", "utc").collect()
    for r in got:
        assert r.utc == (datetime.fromisoformat(r.v).replace(tzinfo=ZoneInfo(r.z)) - EPOCH) // timedelta(microseconds=1), r


def test_zone_estimates(spark):
    rows = []
    for feed, zone in (("a", "America/Chicago"), ("b", "Asia/Tokyo"), ("c", "Europe/Berlin")):
        for k in range(300):
            at = datetime(2023, 1, 1, tzinfo=timezone.utc) + timedelta(hours=29 * k)
            rows.append((feed, at.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"), "dmy", (at + timedelta(minutes=1 + k % 50)).replace(tzinfo=None)))
    rows += [("d", "in press", "dmy", None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "f string, v string, o string, t timestamp_ntz")
    zones = ["America/Chicago", "America/New_York", "Asia/Tokyo", "Europe/Berlin", "Europe/London", "UTC"]
    got = {r.f: (r.zone_estimate, r.violations) for r in ts.estimate_zones(df, "f", "v", "o", "t", zones).collect()}
    assert got == {"a": ("America/Chicago", 0), "b": ("Asia/Tokyo", 0), "c": ("Europe/Berlin", 0)}
    assert ts.estimate_zones(df.limit(0), "f", "v", "o", "t", zones).count() == 0


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([("2024-05-01T10:20:30Z", "UTC", "dmy", 1, 2)], "v string, z string, o string, kind int, year int")
    assert ts.to_utc_us(df.limit(0), "v", "z", "o").count() == 0
    assert ts.to_utc_us(df, "v", "z", "o").columns == ["v", "z", "o", "kind", "year", "utc_us"]


def planted(spark, zone, n=60):
    """Local times of a feed that declares no zone, each fetched ten minutes later; others of it name UTC."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    rows = []
    for k in range(n):
        at = datetime(2024, 1, 5, 3, tzinfo=timezone.utc) + timedelta(days=6 * k, hours=k % 24)
        rows.append((k, "f", at.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"), "dmy", at + timedelta(minutes=10)))
        rows.append((10_000 + k, "f", (at - timedelta(days=2)).strftime("%Y-%m-%dT%H:%M:%SZ"), "dmy", at + timedelta(minutes=10)))
    return spark.createDataFrame(rows, "i bigint, k string, v string, o string, at timestamp")


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/Chicago", "Europe/Berlin"])
def test_planted_feed_without_zone(spark, zone):
    zones = ["Asia/Kolkata", "America/Chicago", "Europe/Berlin", "UTC"]
    got = ts.estimate_zones(planted(spark, zone), "k", "v", "o", "at", zones).first()
    assert (got.zone_estimate, got.violations, got.values_used) == (zone, 0, 60)


def test_order_of_arrival_tells_a_zone_without_ingestion_times(spark):
    """Local times between others that name UTC: only the right zone keeps the order, and without it nothing is known."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    rows = []
    for k in range(40):
        at = datetime(2024, 3, 1, tzinfo=timezone.utc) + timedelta(hours=5 * k)
        rows.append((2 * k, "f", (at - timedelta(minutes=20)).strftime("%Y-%m-%dT%H:%M:%SZ"), "dmy"))
        rows.append((2 * k + 1, "f", at.astimezone(ZoneInfo("America/Chicago")).strftime("%Y-%m-%d %H:%M:%S"), "dmy"))
    df = spark.createDataFrame(rows, "i bigint, k string, v string, o string").withColumn("at", F.lit(None).cast("timestamp"))
    zones = ["America/Chicago", "America/New_York", "America/Los_Angeles", "Europe/Berlin"]
    got = ts.estimate_zones(df, "k", "v", "o", "at", zones, sequence="i").first()
    assert (got.zone_estimate, got.violations) == ("America/Chicago", 0)
    assert ts.estimate_zones(df, "k", "v", "o", "at", zones).count() == 0


def test_more_zones_than_are_compared_at_once(spark, monkeypatch):
    want = ts.estimate_zones(planted(spark, "Asia/Kolkata"), "k", "v", "o", "at", ["UTC", "Asia/Kolkata", "Europe/Berlin"]).collect()
    monkeypatch.setattr(ts, "ZONES_AT_ONCE", 1)
    assert ts.estimate_zones(planted(spark, "Asia/Kolkata"), "k", "v", "o", "at", ["UTC", "Asia/Kolkata", "Europe/Berlin"]).collect() == want


def test_the_query_uses_the_estimate(spark, monkeypatch):
    """Without the estimate the local times of a feed that the configuration does not know have no row."""
    from feedloom.plans import instants

    items = planted(spark, "Asia/Kolkata").select(F.col("i").alias("seq"), F.col("k").alias("feed_url"), F.col("v").alias("published_at"), F.lit(None).cast("string").alias("updated_at"), F.col("at").alias("fetched_at"))
    feeds = spark.createDataFrame([(1, "other", "other", "Asia/Kolkata", "dmy"), (2, "more", "more", "UTC", "dmy")], "feed_id bigint, name string, url string, tz_name string, date_order string")
    old = spark.createDataFrame([], "id bigint, source_name string, first_seen_at string, last_seen_at string")
    monkeypatch.setattr(instants, "load", lambda spark, sf, name: {"normalized_item": items, "feed_config": feeds, "history": old}[name])
    got = {r.row_id: r.utc_us for r in instants.p2_found(spark, "").collect()}
    want = {r.seq: r.us - 600_000_000 for r in items.filter("seq < 10000").select("seq", F.unix_micros("fetched_at").alias("us")).collect()}
    assert {k: v for k, v in got.items() if k < 10_000} == want
    monkeypatch.setattr(ts, "estimate_zones", lambda df, key, *a, **k: df.limit(0).select(key, F.lit("").alias("zone_estimate")))
    assert not any(r.row_id < 10_000 for r in instants.p2_found(spark, "").collect())
