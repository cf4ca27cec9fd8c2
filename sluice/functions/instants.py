"""Mixed timestamp spellings to one UTC instant.

All spellings are compiled into one regex alternation with named groups. ``normalise`` runs it once per value (a single
``regexp_replace`` whose replacement lines up the groups), checks calendar ranges on the integer parts, and assembles the
instant by integer day arithmetic. Everything stays inside JVM expressions; the only join is with a fixed table of zone
names (some 600 rows, it does not grow with the data).
"""

from __future__ import annotations

import functools
import zoneinfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Offsets of zone abbreviations, in minutes. Fixed values.
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "met": 60, "mest": 120, "eet": 120, "eest": 180, "msk": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
    "ist": 330, "jst": 540, "kst": 540, "awst": 480, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "lhst": 630, "lhdt": 660, "nzst": 720, "nzdt": 780,
}
#: First letters of month names in English, German, French and Spanish, by month. Fixed values.
MONTHS = {
    1: "jan jän ene", 2: "feb fév fev", 3: "mar mär mrz mae", 4: "apr avr abr", 5: "may mai", 6: "jun juin", 7: "jul juil", 8: "aug aoû aou ago", 9: "sep set", 10: "oct okt", 11: "nov", 12: "dec dez déc dic",
}

_CLOCK = r"(?<h{0}>\d{{1,2}}):(?<n{0}>\d{{2}})(?::(?<s{0}>\d{{2}})(?:[.,](?<f{0}>\d{{1,9}}))?)?"
_HALF = r"(?:\s*(?<p{0}>[ap])\.?m\b\.?)?"
_ZONE = r"\s*(?<z{0}>[+-]\d{{2}}(?::?\d{{2}})?|[a-z]{{1,5}})?\s*(?:\[\s*(?<r{0}>[a-z0-9_/+-]+)\s*\])?"
_WEEKDAY = r"(?:\p{L}{2,10}\.?,?\s+)?"
#: One alternative per way to write a time; the number at a group's end is that of its alternative.
FORMS = {
    1: r"(?<y1>\d{4})(?<sep1>[-/.])(?<m1>\d{1,2})\k<sep1>(?<d1>\d{1,2})(?:\s*t\s*|\s+)" + _CLOCK.format(1) + _HALF.format(1) + _ZONE.format(1),
    2: r"(?<y2>\d{4})(?<m2>\d{2})(?<d2>\d{2})\s*t?\s*(?<h2>\d{2})(?<n2>\d{2})(?:(?<s2>\d{2})(?:[.,](?<f2>\d{1,9}))?)?(?=\s*[z+\[-])" + _ZONE.format(2),
    3: r"(?<a3>\d{1,2})(?<sep3>[-/.])(?<b3>\d{1,2})\k<sep3>(?<y3>\d{4})(?:\s*[,t]\s*|\s+)" + _CLOCK.format(3) + _HALF.format(3) + _ZONE.format(3),
    4: _WEEKDAY + r"(?<d4>\d{1,2})(?:st|nd|rd|th|\.)?[ -](?:de\s+)?(?<o4>\p{L}{3,4})\p{L}*\.?,?[ -](?:de\s+)?(?<y4>\d{4})(?:,?\s+(?:at\s+)?|t)" + _CLOCK.format(4) + _HALF.format(4) + _ZONE.format(4),
    5: r"(?<e5>-?\d{9,10}|-?\d{12,13}|-?\d{15,16}|-?\d{18,19})",
    # Digits only: 14 are a date and time, as no epoch has so many; 8 and up to 6 stand apart.
    6: r"(?<y6>\d{4})(?<m6>\d{2})(?<d6>\d{2})(?:\s*t\s*|\s+|(?=\d{6}(?!\d)))(?<h6>\d{2})(?<n6>\d{2})(?<s6>\d{2})?",
    7: _WEEKDAY + r"(?<o7>\p{L}{3,4})\p{L}*\.?\s+(?<d7>\d{1,2})(?:st|nd|rd|th)?,?\s+(?<y7>\d{4})(?:,?\s+(?:at\s+)?)" + _CLOCK.format(7) + _HALF.format(7) + _ZONE.format(7),
    8: _WEEKDAY + r"(?<o8>\p{L}{3,4})\p{L}*\s+(?<d8>\d{1,2})\s+" + _CLOCK.format(8) + r"(?:\s+(?<z8>[+-]\d{4}|[a-z]{1,5}))?\s+(?<y8>\d{4})",
}
_BLANK = r"[\s   ﻿]"
ALTERNATION = "(?iu)^" + _BLANK + "*(?:" + "|".join(FORMS[k] for k in (1, 6, 2, 3, 4, 5, 7, 8)) + ")" + _BLANK + "*$"
_PARTS = {
    "y": (1, 2, 3, 4, 6, 7, 8), "m": (1, 2, 6), "d": (1, 2, 4, 6, 7, 8), "h": (1, 2, 3, 4, 6, 7, 8), "n": (1, 2, 3, 4, 6, 7, 8), "s": (1, 2, 3, 4, 6, 7, 8), "f": (1, 2, 3, 4, 7, 8), "z": (1, 2, 3, 4, 7, 8),
    "r": (1, 2, 3, 4, 7), "a": (3,), "b": (3,), "p": (1, 3, 4, 7), "o": (4, 7, 8), "e": (5,), "sep": (3,),
}
_MARK = "\x01"
_LINED_UP = "\x02".join([_MARK, *("".join(f"${{{k}{i}}}" for i in forms) for k, forms in _PARTS.items())])

DAY_US, HOUR_US = 86_400_000_000, 3_600_000_000


@functools.lru_cache(maxsize=1)
def _zone_rows() -> tuple[tuple[str, str | None, int | None], ...]:
    """(lower-case key, canonical region or None, fixed offset in minutes or None), keys unique."""
    regions = {z.lower(): z for z in zoneinfo.available_timezones() if "/" in z or z in ("UTC", "GMT")}
    rows = {k: (k, z, None) for k, z in regions.items() if not k.startswith(("posix/", "right/", "systemv/"))}
    rows |= {k: (k, None, m) for k, m in ABBREVIATIONS.items()}
    return tuple(sorted(rows.values()))


def zone_table(spark: SparkSession) -> DataFrame:
    """The fixed table of zone regions and abbreviations; a few hundred rows whatever the data, so it may be broadcast."""
    columns = [pa.array(c, t) for c, t in zip(zip(*_zone_rows()), (pa.string(), pa.string(), pa.int32()))]
    return F.broadcast(spark.createDataFrame(pa.table(columns, ["__zkey", "__region", "__zfixed"])))


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date from year 1 on, in integer arithmetic; ``m`` and ``d`` in range."""

    def div(a: Column, b: int) -> Column:  # nothing here is negative, so cutting is rounding down
        return F.call_function("div", a.cast("bigint"), F.lit(b))

    y = (y - F.when(m <= 2, 1).otherwise(0)).cast("bigint")
    era = div(y, 400)
    yoe = y - era * 400
    doy = div((m + F.when(m > 2, -3).otherwise(9)) * 153 + 2, 5) + d - 1
    return era * 146097 + yoe * 365 + div(yoe, 4) - div(yoe, 100) + doy - 719468


def _offset(us: Column, region: Column) -> Column:
    """The region's offset in microseconds at the instant ``us``."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), region)) - us


def utc_instant(column: Column) -> Column:
    """A zone-less time that is UTC, as an instant, whatever the session's zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column))


def _let(df: DataFrame, **named: str | Column) -> DataFrame:
    """Columns added behind a one-row generator, so that later filters and projections use their values and never inline
    (and so repeat) their expressions. SQL text builds faster than columns piece by piece."""
    return df.select("*", F.inline(F.array(F.struct(*[(F.expr(c) if isinstance(c, str) else c).alias(k) for k, c in named.items()]))))


def normalise(df: DataFrame, value: str, zone: Column | None = None, month_first: Column | None = None, prefix: str = "t") -> DataFrame:
    """``df`` with ``<prefix>_instant`` (timestamp), ``<prefix>_nanos`` (int, digits below the microsecond) and
    ``<prefix>_status``.

    value: a string column. zone: region name that a value without zone takes (null: unknown). month_first: whether
    ``01/02/2025`` is January 2nd; where null, such a value counts only if one reading is a date or both agree.

    Status: ``ok``; ``null`` for a null value; ``unreadable`` (no form fits, also for an empty text, and for 11 digits, which could be
    seconds or milliseconds); ``invalid`` (no such
    date or time of day); ``no_zone`` (zone needed, but unknown or not a known region); ``gap`` / ``overlap`` (local time
    that the zone skipped / showed twice); ``day_or_month``. The instant is null unless ``ok``. Rows are never dropped or
    added, ties and repeated rows stay as they are; other columns pass through whatever their names, except that columns
    named ``<prefix>_instant/_nanos/_status`` are replaced. An empty table gives an empty table.
    """
    out = [f"{prefix}_instant", f"{prefix}_nanos", f"{prefix}_status"]
    df = df.drop(*out)
    own = df.columns
    zone = F.lit(None).cast("string") if zone is None else zone
    month_first = F.lit(None).cast("boolean") if month_first is None else month_first
    v, c = F.col("__v"), F.col

    x = df.select("*", c(f"`{value}`").alias("__v"), zone.alias("__zone"), month_first.alias("__mf")).toDF(*[f"c{i}" for i in range(len(own))], "__v", "__zone", "__mf")
    x = _let(x, __cut=F.split(F.regexp_replace(v, ALTERNATION, _LINED_UP), "\x02"))
    ints = ("y", "m", "d", "h", "n", "s", "a", "b")
    part = {k: f"if(element_at(__cut, 1) = '{_MARK}', nullif(element_at(__cut, {i}), ''), null)" for i, k in enumerate(_PARTS, 2)}
    x = _let(x, __fits=f"element_at(__cut, 1) = '{_MARK}'", **{f"__{k}": f"cast({p} as int)" if k in ints else f"lower({p})" for k, p in part.items()})
    # Dotted dates have the day first; a clock of 12 hours goes with the month first unless known otherwise; else by what is a date.
    us = "coalesce(case when __sep = '.' then false when __p is not null then coalesce(__mf, true) else __mf end, case when __a > 12 and __b <= 12 then false when __b > 12 and __a <= 12 then true when __a = __b then true end)"
    num, digits = "coalesce(__z rlike '^[+-][0-9]', false)", "regexp_replace(__z, '[:+-]', '')"
    named = ", ".join(f"'{k}', {m}" for m, names in MONTHS.items() for k in names.split())
    x = _let(
        x,
        __us=us,
        __mo=f"coalesce(__m, case when {us} then __a when not {us} then __b end, if(__o is null, null, coalesce(try_element_at(map({named}), __o), try_element_at(map({named}), substring(__o, 1, 3)))))",
        __da=f"coalesce(__d, case when {us} then __b when not {us} then __a end)",
        __ho="case when __p is null then __h when __h between 1 and 12 then __h % 12 + if(__p = 'p', 12, 0) else 99 end",
        __se="coalesce(__s, 0)",
        __ns="cast(rpad(coalesce(__f, '0'), 9, '0') as bigint)",
        __num=num,
        __zkey=f"if({num}, '', coalesce(__z, __r, lower(trim(__zone)), ''))",
        __oh=f"if({num}, cast(substring({digits}, 1, 2) as int), null)",
        __om=f"if({num}, coalesce(cast(nullif(substring({digits}, 3, 2), '') as int), 0), null)",
    )
    x = x.join(zone_table(df.sparkSession), "__zkey", "left")

    leap = "(__y % 4 = 0 and __y % 100 <> 0) or __y % 400 = 0"
    days = f"case when __mo in (4, 6, 9, 11) then 30 when __mo = 2 then if({leap}, 29, 28) else 31 end"
    valid = F.expr(f"coalesce(__y between 1 and 9999 and __mo between 1 and 12 and __da between 1 and {days} and __ho between 0 and 23 and __n between 0 and 59 and __se between 0 and 59 and (not __num or (__oh <= 18 and __om < 60)), false)")
    x = _let(
        x,
        __eus="case when length(replace(__e, '-', '')) <= 10 then bigint(__e) * 1000000 when length(replace(__e, '-', '')) <= 13 then bigint(__e) * 1000 when length(replace(__e, '-', '')) <= 16 then bigint(__e) else (bigint(__e) - pmod(bigint(__e), 1000)) div 1000 end",
        __ens="case when length(replace(__e, '-', '')) >= 18 then cast(pmod(bigint(__e), 1000) as int) when __e is not null then 0 end",
        __fix="if(__num, (__oh * 60 + __om) * if(substring(__z, 1, 1) = '-', -1, 1), __zfixed)",
        # Null unless all is in range.
        __local=F.when(valid, days_from_civil(c("__y"), c("__mo"), c("__da")) * DAY_US + (c("__ho") * 3600 + c("__n") * 60 + c("__se")).cast("bigint") * 1_000_000 + F.expr("__ns div 1000")),
    )
    region = c("__region")
    free = c("__local").isNotNull() & c("__fix").isNull() & region.isNotNull()
    x = _let(x, __before=F.when(free, _offset(c("__local") - DAY_US, region)), __after=F.when(free, _offset(c("__local") + DAY_US, region)))
    before, after = c("__before"), c("__after")
    x = _let(x, __first=F.when(before != after, _offset(c("__local") - before, region) == before).otherwise(before.isNotNull()),
             __second=F.when(before != after, _offset(c("__local") - after, region) == after).otherwise(False))
    x = _let(
        x,
        __status="case when __v is null then 'null' when not __fits then 'unreadable' when __e is not null then 'ok' when __a is not null and __us is null and __a <= 12 then 'day_or_month' when __local is null then 'invalid'"
        " when __fix is not null then 'ok' when __region is null then 'no_zone' when __first and __second then 'overlap' when __first or __second then 'ok' else 'gap' end",
        __us_utc="case when __e is not null then __eus when __fix is not null then __local - bigint(__fix) * 60000000 when __first then __local - __before else __local - __after end",
        __rest="coalesce(__ens, cast(__ns % 1000 as int))",
    )
    ok = c("__status") == "ok"
    return x.select(*[c(f"c{i}").alias(k) for i, k in enumerate(own)], F.when(ok, F.timestamp_micros("__us_utc")).alias(out[0]), F.when(ok, c("__rest")).alias(out[1]), c("__status").alias(out[2]))
