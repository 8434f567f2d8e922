"""Collecting from services and handing on: decisions as plain functions and DataFrames, transports injected.

Nothing here opens a connection. A transport is ``(path, params, headers) -> Reply``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veloframe.functions import fingerprint


@dataclass(frozen=True)
class Reply:
    status: int
    body: object = None
    headers: Mapping[str, str] = field(default_factory=dict)


class DailyLimit(Exception):
    """The service's calls of the day are used up."""


class Refused(LookupError):
    """A reply of status 400 or above."""

    def __init__(self, path: str, status: int):
        super().__init__(f"{path}: status {status}")
        self.status = status


class Maintenance(Refused):
    """The service is down for maintenance: a run is skipped, it has not failed."""


@dataclass
class Client:
    """GET with a token that is renewed before it ends, a pace that fits the service's two limits, and one retry after a 429.

    ``renew`` gives (token, end in epoch seconds). Limits are read from the replies: ``x-ratelimit-limit`` and ``-usage`` as 'short,daily'.
    """

    transport: Callable[[str, Mapping, Mapping], Reply]
    renew: Callable[[], tuple[str, float]]
    now: Callable[[], float]
    sleep: Callable[[float], None]
    margin_s: float = 300
    short_window_s: float = 900
    daily_share: float = 0.97
    _token: str | None = None
    _ends: float = 0.0
    _used: tuple[int, int] = (0, 0)
    _limits: tuple[int, int] = (0, 0)

    def get(self, path: str, params: Mapping | None = None) -> object:
        for attempt in range(2):
            if self._limits[1] and self._used[1] >= self.daily_share * self._limits[1]:
                raise DailyLimit(f"{self._used[1]} of {self._limits[1]} calls")
            if self._token is None or self.now() >= self._ends - self.margin_s:
                self._token, self._ends = self.renew()
            reply = self.transport(path, params or {}, {"Authorization": f"Bearer {self._token}"})
            self._seen(reply.headers)
            if reply.status == 429 and attempt == 0:
                self.sleep(self.short_window_s - self.now() % self.short_window_s + 1)
                continue
            if reply.status >= 400:
                resting = reply.status == 503 and "Maintenance" in str(reply.body)
                raise (Maintenance if resting else Refused)(path, reply.status)
            self._pace()
            return reply.body
        raise AssertionError

    def _seen(self, headers: Mapping[str, str]) -> None:
        pair = lambda k: tuple(int(x) for x in headers[k].split(",")) if k in headers else None
        self._limits, self._used = pair("x-ratelimit-limit") or self._limits, pair("x-ratelimit-usage") or self._used

    def _pace(self) -> None:
        """Spread what is left of the short window over its rest, once half of it is used."""
        limit, used = self._limits[0], self._used[0]
        if limit and used > limit / 2:
            left = self.short_window_s - self.now() % self.short_window_s
            self.sleep(left / max(1, limit - used))


def pages(client: Client, path: str, after: int, size: int = 100) -> Iterator[list]:
    """Lists of a paged collection, until a short one."""
    page = 1
    while True:
        rows = client.get(path, {"after": after, "page": page, "per_page": size})
        if rows:
            yield rows
        if len(rows) < size:
            return
        page += 1


def to_fetch(wanted: DataFrame, *done: DataFrame, key: str = "activity_id") -> DataFrame:
    """Wanted rows whose key none of ``done`` has."""
    for d in done:
        wanted = wanted.join(d.select(key), key, "left_anti")
    return wanted


def worth_streams(activities: DataFrame, places: bool = True) -> DataFrame:
    """Dated activities with power, or (``places``) with a place."""
    worth = F.col("average_watts").isNotNull()
    return activities.filter(F.col("start_date_key").isNotNull() & (worth | F.col("start_lat").isNotNull() if places else worth))


def stream_todo(activities: DataFrame, stored: DataFrame, ledger: DataFrame, places: bool = True) -> DataFrame:
    """Activities whose streams are worth a call: not ``stored`` (activity_id), and not known to the ``ledger`` (activity_id, status) as done, missing or empty."""
    known = ledger.filter(F.col("status").isin("done", "missing", "empty"))
    return to_fetch(worth_streams(activities, places), stored, known)


def changed(now: DataFrame, seen: DataFrame, columns: list[str], key: str = "id", since: dt.date | None = None, date: str = "date") -> DataFrame:
    """Rows whose content is new: no seen row has their key and fingerprint. Rows before ``since`` belong to another source."""
    if since:
        now = now.filter(F.col(date) >= F.lit(since))
    return now.withColumn("fingerprint", fingerprint(*[F.col(c) for c in columns])).join(seen.select(key, "fingerprint"), [key, "fingerprint"], "left_anti")


def second_service_todo(now: DataFrame, seen: DataFrame, upgraded: DataFrame, columns: list[str], since: dt.date, swims: tuple[str, ...] = ("Swim", "OpenWaterSwim")) -> DataFrame:
    """``now`` (id, type, date, ...) from ``since`` on: rows whose content is new (``seen``: id, fingerprint), and swims whose detail was never fetched (``upgraded``: id)."""
    known = seen.select("id", "fingerprint").distinct().withColumn("_seen", F.lit(True))
    detailed = upgraded.select("id").distinct().withColumn("_detailed", F.lit(True))
    own = now.filter(F.col("date") >= F.lit(since)).withColumn("fingerprint", fingerprint(*[F.col(c) for c in columns]))
    swim = F.coalesce(F.col("type").isin(*swims), F.lit(False))
    both = own.join(known, ["id", "fingerprint"], "left").join(detailed, "id", "left")
    return both.filter(F.col("_seen").isNull() | (swim & F.col("_detailed").isNull())).drop("_seen", "_detailed")


@dataclass
class Debounce:
    """Notifications wait until it has been quiet, at most ``longest_s``, and at most ``most`` at a time."""

    owner: int
    quiet_s: float = 90
    longest_s: float = 300
    most: int = 50
    waiting: dict[int, float] = field(default_factory=dict)
    first: float | None = None
    last: float = 0.0

    def accept(self, event: Mapping, now: float) -> bool:
        """Creations and updates of the owner's activities."""
        if event.get("owner_id") != self.owner or event.get("object_type") != "activity" or event.get("aspect_type") not in ("create", "update"):
            return False
        self.waiting[int(event["object_id"])] = now
        self.first = now if self.first is None else self.first
        self.last = now
        return True

    def due(self, now: float) -> list[int]:
        """The ids to act on now, oldest first; the rest keeps waiting."""
        if not self.waiting or (now - self.last < self.quiet_s and now - (self.first or now) < self.longest_s and len(self.waiting) < self.most):
            return []
        out = sorted(self.waiting, key=lambda k: (self.waiting[k], k))[: self.most]
        for k in out:
            del self.waiting[k]
        self.first = min(self.waiting.values(), default=None)
        return out


def to_publish(bundles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Bundles that the receiver hasn't got in this very form."""
    return bundles.withColumn("sha256", F.sha2("bundle", 256)).join(ledger.select("activity_id", "sha256"), ["activity_id", "sha256"], "left_anti")


def acknowledged(published: DataFrame, replies: DataFrame, accepted: tuple[str, ...] = ("queued", "already_queued", "already_done", "before_cutover")) -> DataFrame:
    """What goes into the ledger: published rows whose reply is a known acknowledgement."""
    return published.join(replies.filter(F.col("status").isin(*accepted)), "activity_id").select("activity_id", "sha256", "status")


def gpx(points: DataFrame, key: str = "activity_id") -> DataFrame:
    """key and a GPX document of its points, by time; power has no place in it."""
    opt = lambda tag, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{tag}>"), F.col(c).cast("string"), F.lit(f"</{tag}>"))).otherwise("")
    ext = F.concat(opt("hr", "heartrate"), opt("cad", "cadence"), opt("atemp", "temp_c"))
    at = F.date_format(F.col("point_ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    point = F.concat(
        F.lit('<trkpt lat="'), F.col("lat").cast("string"), F.lit('" lon="'), F.col("lon").cast("string"), F.lit('">'), opt("ele", "ele_m"), F.lit("<time>"), at, F.lit("</time>"),
        F.when(ext != "", F.concat(F.lit("<extensions><TrackPointExtension>"), ext, F.lit("</TrackPointExtension></extensions>"))).otherwise(""), F.lit("</trkpt>"),
    )
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("point_ts", "point_idx", point.alias("x")))), lambda p: p["x"]), "")
    head = '<?xml version="1.0" encoding="UTF-8"?><gpx version="1.1" creator="' + escape("veloframe") + '" xmlns="http://www.topografix.com/GPX/1/1"><trk><trkseg>'
    return points.filter("lat is not null and lon is not null").groupBy(key).agg(F.concat(F.lit(head), ordered, F.lit("</trkseg></trk></gpx>")).alias("gpx"))


def local_text(c: Column) -> Column:
    """Wall time as 19 characters; other texts are NULL."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), F.substring(c, 1, 19))
