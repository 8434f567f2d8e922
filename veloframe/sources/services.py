"""Runs that fetch from services: resumable syncs, stream back-fill, daily fitness, waiting for a third party's texts.

Transports, fetchers and savers are injected. What a run has got is saved after each activity, so a run that stops goes on where it was.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from veloframe.sources.collect import Client, DailyLimit, Maintenance, Refused, pages

#: Fixed value: the exit code that marks a run as skipped.
SKIPPED = 99
#: Fixed value: types of the second service that have laps only in their details.
SWIMS = ("Swim", "OpenWaterSwim")


@dataclass
class State:
    """What was fetched, and when the latest of it began (epoch seconds)."""

    done: set[int] = field(default_factory=set)
    latest: int = 0


def _epoch(text: str) -> int:
    return int(dt.datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp())


def sync(client: Client, path: str, state: State, fetch: Callable[[Mapping], None], save: Callable[[State], None], since: int | None = None, everything: bool = False, refresh: bool = False, dry: bool = False) -> list[int]:
    """Ids of the activities that were fetched (``dry``: that would be), oldest first.

    Without a range the list begins at the latest known start. ``refresh`` fetches known ones again and needs a range. A refusal or the day's limit ends
    the run; what came before it is saved.
    """
    if refresh and since is None and not everything:
        raise ValueError("a refresh needs a range")
    after = 0 if everything else state.latest if since is None else since
    listed = sorted((a for page in pages(client, path, after) for a in page), key=lambda a: (a["start_date"], a["id"]))
    todo = [a for a in listed if refresh or a["id"] not in state.done]
    if dry:
        return [a["id"] for a in todo]
    got = []
    try:
        for a in todo:
            fetch(a)
            state.done.add(a["id"])
            state.latest = max(state.latest, _epoch(a["start_date"]))
            save(state)
            got.append(a["id"])
    except (DailyLimit, Refused):
        pass
    return got


def fetch_again(client: Client, path: str, ids: Iterable[int], state: State, fetch: Callable[[Mapping], None], save: Callable[[State], None]) -> None:
    """Named activities once more, known or not."""
    for i in ids:
        a = client.get(f"{path}/{i}")
        fetch(a)
        state.done.add(i)
        state.latest = max(state.latest, _epoch(a["start_date"]))
    save(state)


def back_fill(ids: Iterable[int], fetch: Callable[[int], object], record: Callable[[int, str], None]) -> bool:
    """Streams of ``ids``; each gets a ledger entry: done, empty, or missing (404). False if the day's limit ended it."""
    for i in ids:
        try:
            found = fetch(i)
        except DailyLimit:
            return False
        except Refused as e:
            if e.status != 404:
                raise
            record(i, "missing")
        else:
            record(i, "done" if found else "empty")
    return True


def second_service_document(client: Client, path: str, listed: Mapping) -> tuple[dict, list]:
    """A listed activity with its details, where it is a swim, and its streams: none where the service has none of them (404)."""
    whole = dict(listed)
    own = f"{path}/{listed['id']}"
    if listed.get("type") in SWIMS:
        detail = client.get(own, {"intervals": "true"})
        if not isinstance(detail, Mapping) or detail.get("id") != listed["id"]:
            raise ValueError(f"{own}: not this activity's details")
        whole |= detail
    if not listed.get("stream_types"):
        return whole, []
    try:
        streams = client.get(f"{own}/streams.json")
    except Refused as e:
        if e.status != 404:
            raise
        streams = []
    return whole, streams if isinstance(streams, list) else []


def exit_code(run: Callable[[], object]) -> int:
    """0; ``SKIPPED`` during the service's maintenance; 1 after any other refusal."""
    try:
        run()
    except Maintenance:
        return SKIPPED
    except (Refused, DailyLimit):
        return 1
    return 0


def replace_file(path: str | Path, text: str) -> None:
    """The file whole or as it was: readers never see a part, and nobody else can read it."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{os.getpid()}.part")
    with open(os.open(part, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o600), "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def daily_fitness(client: Client, path: str, today: dt.date, days: int = 400) -> list:
    """All days of the last ``days`` and tomorrow: past days change with their activities, so they are always fetched anew. No day at all is an error."""
    rows = client.get(path, {"oldest": str(today - dt.timedelta(days=days)), "newest": str(today + dt.timedelta(days=1))})
    if not isinstance(rows, list) or not rows:
        raise ValueError(f"{path}: no days")
    return rows


def ready(client: Client, path: str, ids: Iterable[int], waits: Callable[[Mapping], bool]) -> bool:
    """Whether none of ``ids`` still waits for a text that a third party writes later. What cannot be read is not waited for."""
    waiting = False
    for i in ids:
        try:
            document = client.get(f"{path}/{i}", {"include_all_efforts": "false"})
        except Refused:
            continue
        waiting |= waits(document)
    return not waiting


def waits_for_text(words: Iterable[str], types: Iterable[str], service: str | None = None) -> Callable[[Mapping], bool]:
    """A rule for ``ready``: an activity of ``types`` whose description has neither all of ``words`` nor the ``service``'s name. The same rule as ``gold.stg_service_notes``."""
    words, types = tuple(words), frozenset(types)

    def waits(document: Mapping) -> bool:
        text = document.get("description") or ""
        there = all(w in text for w in words) or bool(service and service.lower() in text.lower())
        return document.get("type") in types and not there

    return waits
