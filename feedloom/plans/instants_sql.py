"""The instants of problem 2 in SQL, written apart from the operator: patterns for each notation, then the zone rules.

``INSTANTS_SQL`` are common table expressions; ``instants (source_table, row_id, field_name, v, us)`` has one row for each
value of the three timestamp fields, ``us`` null for values that name no instant.
"""

from __future__ import annotations

from feedloom.operators.timestamps import ABBREVIATIONS, MONTHS, REGIONAL

_MONTHS = ", ".join(f"('{name}', {k})" for name, k in sorted({n: k for names in MONTHS.values() for k, n in enumerate(names.split(), 1)}.items()))
_ZONES = ", ".join(f"('{a}', {m})" for a, m in ABBREVIATIONS.items())
_LOCAL = " ".join(f"when z = '{a}' and starts_with(tz, '{region}') then {m}" for (region, a), m in REGIONAL.items())
_CLOCK = r"(\d{1,2})[:h.](\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?:Uhr)?\s*([AaPp]\.?[Mm]\.?)?"
_ZONE = r"\s*([Zz]|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Za-z]{2,5})?"
_KINDS = {
    **{f"i{sep}": (r"^(\d{4})" + sep + r"(\d{2})" + sep + r"(\d{2})(?:(?:[Tt]|\s+)?(\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?" + _ZONE + r"(?:\[([^\]]+)\])?$", ("y", "m1", "d1", "h", "mi", "s", "f", "z", "named")) for sep in ("", "-", "/")},
    "n": (r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?:,?\s+" + _CLOCK + ")?" + _ZONE + "$", ("a", "b", "y", "h", "mi", "s", "f", "half", "z")),
    "d": (r"^(?:\p{L}+\.?,\s*)?(\d{1,2})\.?\s+(?:de\s+)?(\p{L}+)\.?\s+(?:de\s+)?(\d{4}),?(?:\s+(?:à\s+|um\s+|at\s+|a las\s+)?" + _CLOCK + ")?" + _ZONE + "$", ("d1", "name", "y", "h", "mi", "s", "f", "half", "z")),
    "t": (r"^(?:\p{L}+\.?,\s*)?(\p{L}+)\.?\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+(?:at\s+)?" + _CLOCK + ")?" + _ZONE + "$", ("name", "d1", "y", "h", "mi", "s", "f", "half", "z")),
}
_COLUMNS = ("y", "m1", "d1", "a", "b", "name", "h", "mi", "s", "f", "half", "z", "named")


def _kind(k: str) -> str:
    pattern, groups = _KINDS[k]
    cols = ", ".join(f"regexp_extract(v, '{pattern}', {groups.index(c) + 1}) as {c}" if c in groups else f"'' as {c}" for c in _COLUMNS)
    return f"select *, '{k}' as kind, {cols} from vals where regexp_matches(v, '{pattern}')"


INSTANTS_SQL = rf"""raw as (
    select 'normalized_item' as source_table, seq as row_id, feed_url as feed, 'published_at' as field_name, published_at as value from normalized_item
    union all select 'normalized_item', seq, feed_url, 'updated_at', updated_at from normalized_item
    union all select 'history', id, source_name, 'first_seen_at', first_seen_at from history),
  writers as (select feed, arg_min(tz_name, feed_id) as tz, arg_min(date_order, feed_id) as ord from (select url as feed, * from feed_config union all select name, * from feed_config) group by feed),
  vals as (select r.*, regexp_replace(r.value, '^[\s\x{{0B}}\x{{85}}\p{{Z}}]+|[\s\x{{0B}}\x{{85}}\p{{Z}}]+$', '', 'g') as v, w.tz, w.ord from raw r left join writers w on r.feed = w.feed where r.value is not null),
  parts as ({' union all '.join(_kind(k) for k in _KINDS)}),
  months(name, k) as (values {_MONTHS}), zones(z, off) as (values {_ZONES}),
  nums as (select p.source_table, p.row_id, p.field_name, p.kind, p.tz, p.named, lower(p.z) as z, try_cast(p.y as int) as y,
    case when p.kind[1] = 'i' then try_cast(p.m1 as int) when p.kind = 'n' then try_cast(case when coalesce(p.ord, 'dmy') = 'mdy' then p.a else p.b end as int) else m.k end as mo,
    case when p.kind[1] = 'i' then try_cast(p.d1 as int) when p.kind = 'n' then try_cast(case when coalesce(p.ord, 'dmy') = 'mdy' then p.b else p.a end as int) else try_cast(p.d1 as int) end as d,
    coalesce(try_cast(nullif(p.h, '') as int), 0) as h, coalesce(try_cast(nullif(p.mi, '') as int), 0) as mi, coalesce(try_cast(nullif(p.s, '') as int), 0) as s, lower(substr(p.half, 1, 1)) as half,
    coalesce(try_cast(rpad(substr(nullif(p.f, ''), 1, 6), 6, '0') as bigint), 0) as f from parts p left join months m on m.name = lower(p.name)),
  clock as (select *, case when half = '' then h when h between 1 and 12 then h % 12 + case when half = 'p' then 12 else 0 end end as hh from nums),
  minutes as (select *, case when y between 1900 and 2199 and s between 0 and 60 and mo between 1 and 12 and hh between 0 and 23 and mi between 0 and 59 and d between 1 and day(last_day(make_date(y, mo, 1))) then make_timestamp(y, mo, d, hh, mi, 0.0) end as loc from clock),
  shifts as (select m.*, coalesce(nullif(m.named, ''), m.tz) as at_zone, case when m.z = '' then null when regexp_matches(m.z, '^[+-]') then (case when m.z[1] = '-' then -1 else 1 end) * (cast(substr(rpad(replace(substr(m.z, 2), ':', ''), 4, '0'), 1, 2) as int) * 60 + cast(substr(rpad(replace(substr(m.z, 2), ':', ''), 4, '0'), 3, 2) as int))
    else case {_LOCAL.replace('z =', 'm.z =').replace('starts_with(tz', 'starts_with(m.tz')} else coalesce(k.off, 9999) end end as off from minutes m left join zones k on k.z = m.z),
  utc as (select *, case when off is null and at_zone in (select name from pg_timezone_names()) then cast(timezone('UTC', timezone(at_zone, loc)) as timestamp) end as u from shifts where loc is not null),
  firsts as (select *, case when off is not null then case when off between -1080 and 1080 then epoch_us(loc) - cast(off as bigint) * 60000000 end
    else epoch_us(u) - coalesce(case when cast(timezone(at_zone, timezone('UTC', u - interval 1 hour)) as timestamp) = loc then 3600000000 when cast(timezone(at_zone, timezone('UTC', u - interval 30 minute)) as timestamp) = loc then 1800000000 end, 0) end + s * 1000000 + f as us from utc),
  numbers as (select source_table, row_id, field_name, case length(v) when 10 then cast(v as bigint) * 1000000 when 13 then cast(v as bigint) * 1000 when 16 then cast(v as bigint) end as us from vals where regexp_matches(v, '^\d{{10}}$|^\d{{13}}$|^\d{{16}}$')),
  found as (select source_table, row_id, field_name, max(us) as us from (select source_table, row_id, field_name, us from numbers union all select source_table, row_id, field_name, us from firsts) group by 1, 2, 3),
  instants as (select x.source_table, x.row_id, x.field_name, x.value as v, f.us from vals x left join found f on f.source_table = x.source_table and f.row_id = x.row_id and f.field_name = x.field_name)"""
