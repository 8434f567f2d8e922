"""Scalar expressions over Columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def blank_to_null(c: Column) -> Column:
    """NULL for a blank text or a literal 'None'."""
    return F.when(F.trim(c).isin("", "None"), F.lit(None)).otherwise(c)


def per(a: Column, b: Column) -> Column:
    """a / b where b is positive, else NULL."""
    return F.when(b > 0, a / b)


def safe_size(c: Column) -> Column:
    """Elements of an array; 0 for NULL."""
    return F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0))


def one_of(c: Column, groups: Mapping[str, Sequence[str]], other: str) -> Column:
    """The name of the group that holds the value."""
    out = None
    for name, members in groups.items():
        out = F.when(c.isin(*members), name) if out is None else out.when(c.isin(*members), name)
    return out.otherwise(other)


def label_from(c: Column, names: Mapping[str, str], unassigned: str, prefix: int = 6) -> Column:
    """A label by key; ``unassigned`` for NULL; the key's first characters for an unknown key."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c] if names else F.lit(None).cast("string")
    return F.when(c.isNull(), unassigned).otherwise(F.coalesce(known, F.concat(F.lit("other("), F.substring(c, 1, prefix), F.lit("…)"))))


def minutes_seconds(seconds: Column) -> Column:
    """m:ss, by seconds rounded half up; NULL stays."""
    whole = F.round(seconds).cast("long")
    return F.when(seconds.isNotNull(), F.concat(F.floor(whole / 60).cast("string"), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0")))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) ** 2
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def strip_markup(c: Column) -> Column:
    """Text of markup: scripts, styles and tags out, common entities decoded, white space single."""
    out = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"[ \t\r\n]+", " "))


def fingerprint(*columns: Column) -> Column:
    """sha1 of the columns as JSON; NULLs count."""
    return F.sha1(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
