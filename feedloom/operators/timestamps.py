"""Mixed timestamp notations and zones to one UTC instant, as native column expressions.

A value is rewritten by at most four regular expressions into one canonical ``kind|y|m|d|H|M|S|frac|zone``
string, which is split once.  Local times are converted with the zone rules of the JVM, for which a time that
occurs twice is the earlier instant and a skipped one takes the offset in force before the change.

Zones that no configuration declares are estimated: of the candidate zones (each one an offset history) the one is taken
under which the fewest values lie after the time at which they were ingested, or before one that arrived earlier.

Defined results: null, blank, placeholder and unreadable values give null; years outside 1900-2199 are
placeholders; a null or unknown zone leaves values without zone null unless it can be estimated.
"""

from __future__ import annotations

from functools import reduce
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Month names and abbreviations of the supported locales.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en_short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de_short": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "fr_short": "janv févr mars avr mai juin juil août sept oct nov déc",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "es_short": "ene feb mar abr may jun jul ago sept oct nov dic",
}

# Minutes east of UTC of zone abbreviations; the second table holds those that a region reads differently.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "msk": 180, "ist": 330, "jst": 540, "kst": 540, "aest": 600, "aedt": 660, "acst": 570, "acdt": 630,
    "awst": 480, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360,
    "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "ast": -240, "adt": -180, "brt": -180,
}
REGIONAL = {
    ("Australia/", "est"): 600, ("Australia/", "edt"): 660, ("Australia/", "cst"): 570, ("Asia/Shanghai", "cst"): 480,
    ("Europe/Dublin", "ist"): 60, ("Asia/Jerusalem", "ist"): 120, ("Asia/Dhaka", "bst"): 360,
}

CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00\z"
_ZONE = r"\s*([Zz]|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Za-z]{2,5})?"
_CLOCK = r"(\d{1,2})[:h.](\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?:Uhr)?\s*([AaPp]\.?[Mm]\.?)?"
_ISO = r"^(\d{4})([-/]?)(\d{2})\2(\d{2})(?:(?:[Tt]|\s+)?(\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?" + _ZONE + r"(?:\[([^\]]+)\])?$"
_DIGITS = r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?:,?\s+" + _CLOCK + r")?" + _ZONE + "$"
_DAY_FIRST = r"^(?:\p{L}+\.?,\s*)?(\d{1,2})\.?\s+(?:de\s+)?(\p{L}+)\.?\s+(?:de\s+)?(\d{4}),?(?:\s+(?:à\s+|um\s+|at\s+|a las\s+)?" + _CLOCK + r")?" + _ZONE + "$"
_MONTH_FIRST = r"^(?:\p{L}+\.?,\s*)?(\p{L}+)\.?\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+(?:at\s+)?" + _CLOCK + r")?" + _ZONE + "$"

DAY_US, MINUTE_US = 86_400_000_000, 60_000_000
#: The candidate zones that a value is compared with at once; more are compared in further blocks.
ZONES_AT_ONCE = 64
#: Values of a writer, by their order of arrival, that one window runs over.
SEQUENCE_BLOCK = 100_000


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _canonical(value: Column) -> Column:
    """``kind|y|m|d|H|M|S|frac|ampm|zone|named``; anything unreadable stays without bars."""
    v = F.translate(_strip(value), "|", "")
    v = F.regexp_replace(v, _ISO, r"i|$1|$3|$4|$5|$6|$7|$8||$9|$10")
    v = F.regexp_replace(v, _DIGITS, r"n|$3|$1|$2|$4|$5|$6|$7|$8|$9|")
    v = F.regexp_replace(v, _DAY_FIRST, r"t|$3|$2|$1|$4|$5|$6|$7|$8|$9|")
    return F.regexp_replace(v, _MONTH_FIRST, r"t|$3|$1|$2|$4|$5|$6|$7|$8|$9|")


def _month_map() -> Column:
    pairs = {name: i for names in MONTHS.values() for i, name in enumerate(names.split(), 1)}
    return F.create_map(*[F.lit(x) for pair in sorted(pairs.items()) for x in pair])


def _abbreviation(zone: Column, tz: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in sorted(ABBREVIATIONS.items()) for x in pair])
    local = reduce(lambda acc, kv: acc.when((zone == kv[0][1]) & tz.startswith(kv[0][0]), F.lit(kv[1])), REGIONAL.items(), F.when(F.lit(False), F.lit(0)))
    return F.coalesce(local, F.try_element_at(known, zone))


def _us(ntz: Column) -> Column:
    """Microseconds of a zone-free timestamp with whole minutes, whatever the session's zone is."""
    return F.unix_date(ntz.cast("date")).cast("bigint") * DAY_US + (F.hour(ntz) * 60 + F.minute(ntz)).cast("bigint") * MINUTE_US


def _int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def parsed(df: DataFrame, value: str, tz: str, order: str, prefix: str = "_ts") -> DataFrame:
    """Add ``{prefix}_epoch`` (µs named by a number), ``{prefix}_min`` (local minute, zone-free), ``{prefix}_sub`` (µs within
    the minute) and ``{prefix}_off`` (minutes east of UTC, null for local times), plus ``{prefix}_zone`` for a bracketed zone."""
    names = dict(zip(("kind", "y", "a", "b", "H", "M", "S", "frac", "half", "zone", "named"), [f"{prefix}_p{i}" for i in range(11)]))
    part = {k: F.col(v) for k, v in names.items()}
    df = df.withColumn(f"{prefix}_t", _strip(F.col(value))).withColumn(f"{prefix}_c", F.split(_canonical(F.col(f"{prefix}_t")), r"\|"))
    df = df.withColumns({v: F.when(F.size(f"{prefix}_c") == 11, F.get(f"{prefix}_c", F.lit(i))) for i, v in enumerate(names.values())})
    kind, mdy = part["kind"], F.lower(F.coalesce(F.col(order), F.lit("dmy"))) == "mdy"
    swap = (kind == "n") & ~mdy
    month, day = F.when(swap, part["b"]).otherwise(part["a"]), _int(F.when(swap, part["a"]).otherwise(part["b"]))
    month = F.when(kind == "t", F.try_element_at(_month_map(), F.lower(month))).otherwise(_int(month))
    df = df.withColumns({f"{prefix}_mon": month, f"{prefix}_day": day, f"{prefix}_zon": F.lower(part["zone"]), f"{prefix}_sec": F.coalesce(_int(part["S"]), F.lit(0)), f"{prefix}_h": F.coalesce(_int(part["H"]), F.lit(0)), f"{prefix}_ap": F.lower(F.substring(part["half"], 1, 1)), f"{prefix}_row": F.monotonically_increasing_id()})  # its last column keeps filters on the result from being pushed down, and the whole tree of expressions with them
    h, half, zone, second = F.col(f"{prefix}_h"), F.col(f"{prefix}_ap"), F.col(f"{prefix}_zon"), F.col(f"{prefix}_sec")
    hour = F.when(half == "", h).when(~h.between(1, 12), F.lit(None)).otherwise(h % 12 + F.when(half == "p", 12).otherwise(0))
    fraction = F.rpad(F.substring(part["frac"], 1, 6), 6, "0").try_cast("int")
    digits = F.rpad(F.translate(F.substring(zone, 2, 5), ":", ""), 4, "0").try_cast("int")
    numeric = F.when(zone.startswith("-"), -1).otherwise(1) * (F.floor(digits / 100) * 60 + digits % 100)
    offset = F.when(zone == "", F.lit(None)).when(zone.rlike("^[+-]"), numeric).otherwise(F.coalesce(_abbreviation(zone, F.col(tz)), F.lit(9999)))
    text = F.col(f"{prefix}_t")
    whole, size = F.when(text.rlike(r"^\d+$"), text.try_cast("bigint")), F.length(text)
    epoch = F.when(size == 10, whole * 1_000_000).when(size == 13, whole * 1_000).when(size == 16, whole)
    year = _int(part["y"])
    minute = F.when(year.between(1900, 2199) & second.between(0, 60) & (F.col(f"{prefix}_row") >= 0), F.try_make_timestamp_ntz(year, F.col(f"{prefix}_mon"), F.col(f"{prefix}_day"), hour, F.coalesce(_int(part["M"]), F.lit(0)), F.lit(0).cast("decimal(8,6)")))
    df = df.withColumns({f"{prefix}_epoch": epoch, f"{prefix}_min": minute, f"{prefix}_sub": second.cast("bigint") * 1_000_000 + F.coalesce(fraction, F.lit(0)), f"{prefix}_off": offset, f"{prefix}_zone": F.nullif(part["named"], F.lit(""))})
    return df.drop(*names.values(), *(f"{prefix}_{x}" for x in ("t", "c", "mon", "day", "zon", "sec", "h", "ap", "row")))


def _valid_zone(tz: Column) -> Column:
    return F.when(tz.isin(*sorted(available_timezones())), tz)


def _in_zone(minute: Column, tz: Column) -> Column:
    return _us(F.convert_timezone(_valid_zone(tz), F.lit("UTC"), minute))


def to_utc_us(df: DataFrame, value: str, tz: str, order: str, out: str = "utc_us") -> DataFrame:
    """Add ``out``: the instant that ``value`` names, in µs since 1970 UTC, or null.

    ``tz`` and ``order`` name the columns with the zone and the digit order (``dmy``/``mdy``) of the value's writer.
    """
    parts = [f"_ts_{x}" for x in ("epoch", "min", "sub", "off", "zone")]
    epoch, minute, sub, off, named = map(F.col, parts)
    at = F.when(off.isNotNull(), F.when(off.between(-1080, 1080), _us(minute) - off * F.lit(MINUTE_US).cast("bigint"))).otherwise(_in_zone(minute, F.coalesce(named, F.col(tz))))
    return parsed(df, value, tz, order).withColumn(out, F.coalesce(epoch, at + sub)).drop(*parts)


def estimate_zones(df: DataFrame, key: str, value: str, order: str, ingested: str, zones: list[str], slack_s: int = 0, sequence: str | None = None) -> DataFrame:
    """``(key, zone_estimate, violations, values_used)``: for each writer the candidate zone under which the fewest local
    times are violated; ties go to the smallest total delay, then to the first name.

    A local time is violated if it lies after its ingestion by more than ``slack_s`` seconds; with ``sequence``, the order in
    which a writer's values arrived, also if a value that arrived before it and names its own zone lies later.  Values
    without time of ingestion are judged by that order alone.  Each value is compared with every candidate in its own row
    and counted map-side, so that the shuffle holds one row for each writer, candidate and partition.
    """
    zones = sorted(set(zones) & available_timezones()) or ["UTC"]
    cols = [F.col(key).alias("_key"), F.col(value).alias("_v"), F.col(order).alias("_order"), F.col(ingested).cast("timestamp").alias("_in"), F.lit(None).cast("string").alias("_tz")]
    read = parsed(df.select(*cols, (F.col(sequence).cast("bigint") if sequence else F.lit(None).cast("bigint")).alias("_seq")), "_v", "_tz", "_order")
    if sequence:
        # the last instant before a value that names its own zone: a running value of one writer's day of arrival and a
        # maximum over its days, so that a writer with many rows is split
        known = F.when(F.col("_ts_off").between(-1080, 1080), _us(F.col("_ts_min")) - F.col("_ts_off") * F.lit(MINUTE_US).cast("bigint") + F.col("_ts_sub"))
        read = read.withColumn("_known", known).withColumn("_block", F.floor(F.col("_seq") / SEQUENCE_BLOCK))
        mine = Window.partitionBy("_key", "_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
        tops = read.groupBy("_key", "_block").agg(F.max("_known").alias("_top"))
        tops = tops.withColumn("_before", F.max("_top").over(Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).drop("_top")
        read = read.withColumn("_here", F.max("_known").over(mine)).join(tops.select(F.col("_key").alias("_k"), F.col("_block").alias("_b"), "_before"), F.col("_key").eqNullSafe(F.col("_k")) & F.col("_block").eqNullSafe(F.col("_b")), "left").withColumn("_last", F.greatest("_here", "_before"))
    else:
        read = read.withColumn("_last", F.lit(None).cast("bigint"))
    local = read.filter("_ts_off is null and _ts_zone is null and _ts_min is not null and (_in is not null or _last is not null)")
    blocks = []
    for k in range(0, len(zones), ZONES_AT_ONCE):
        each = local.select("_key", F.explode(F.array(*map(F.lit, zones[k : k + ZONES_AT_ONCE]))).alias("_zone"), "_ts_min", "_ts_sub", "_last", F.unix_micros("_in").alias("_in_us"))
        at = _in_zone(F.col("_ts_min"), F.col("_zone")) + F.col("_ts_sub")
        lag = F.col("_in_us") - at
        late = F.coalesce(lag < -slack_s * 1_000_000, F.lit(False)) | F.coalesce(at < F.col("_last") - slack_s * 1_000_000, F.lit(False))
        made = each.select("_key", "_zone", F.coalesce(lag, at - F.col("_last")).alias("_lag"), late.cast("bigint").alias("_late"))
        blocks.append(made.groupBy("_key", "_zone").agg(F.sum("_late").alias("_bad"), F.sum(F.abs("_lag").cast("double")).alias("_delay"), F.count("*").alias("_n")))
    best = reduce(DataFrame.unionByName, blocks).groupBy("_key").agg(F.min(F.struct("_bad", "_delay", "_zone", "_n")).alias("_b"))
    return best.select(F.col("_key").alias(key), F.col("_b._zone").alias("zone_estimate"), F.col("_b._bad").alias("violations"), F.col("_b._n").alias("values_used"))
