"""Reports over marts: sentences, Markdown tables, the overview, charts, pacing evidence as Markdown, HTML and JSON. Marts are aggregated before they are collected."""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Mapping, Sequence
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trend(recent: float, previous: float) -> str:
    """Against the four weeks before; within a tenth is alike."""
    if not previous:
        return "nothing in the four weeks before" if recent else ""
    change = 100 * (recent / previous - 1)
    return "like the four weeks before" if abs(change) < 10 else f"{change:+.0f} % on the four weeks before"


def status_sentence(status: DataFrame) -> str:
    """From ``mart_training_status``, three rows."""
    parts = []
    for r in sorted(status.collect(), key=lambda r: r.sport):
        if r.recent_n:
            longest = f", longest {r.recent_longest_km:.0f} km" if r.sport == "cycling" and (r.recent_longest_km or 0) >= 100 else ""
            note = trend(r.recent_km, r.previous_km)
            parts.append(f"{r.sport} {r.recent_n}x {r.recent_km:,.1f} km{f' ({note})' if note else ''}{longest}")
        elif r.days_since is not None:
            parts.append(f"no {r.sport} for {r.days_since} days")
    return f"Last four weeks: {'; '.join(parts)}." if parts else "No activity in the last four weeks."


def markdown_table(df: DataFrame, columns: Sequence[str], most: int = 50) -> str:
    """The first ``most`` rows as a Markdown table; a middle dot stands for NULL."""
    cell = lambda v: "·" if v is None else f"{v:,.1f}" if isinstance(v, float) else str(v)
    lines = [f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]
    lines += [f"| {' | '.join(cell(v) for v in row)} |" for row in df.select(*columns).limit(most).collect()]
    return "\n".join(lines)


def curve_svg(curve: DataFrame, width: int = 640, height: int = 320, label: str = "all") -> str:
    """The power curve over the logarithm of duration."""
    rows = sorted((r.duration_s, r.best_watts) for r in curve.filter(curve.window_label == label).select("duration_s", "best_watts").collect())
    if not rows:
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"/>'
    lo, hi, top = math.log(rows[0][0]), math.log(rows[-1][0]), max(w for _, w in rows)
    points = " ".join(f"{40 + (width - 60) * (math.log(s) - lo) / ((hi - lo) or 1):.1f},{height - 30 - (height - 60) * w / top:.1f}" for s, w in rows)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><polyline fill="none" stroke="currentColor" points="{points}"/></svg>'


def bars_svg(df: DataFrame, label: str, value: str, width: int = 640, height: int = 320, most: int = 60) -> str:
    """One bar a row, by ``label``; NULL has none. ``df`` is an aggregate of at most ``most`` rows: more are an error, not a cut."""
    rows = _few(df.select(label, value).orderBy(label), most)
    top = max((r[1] or 0 for r in rows), default=0) or 1
    wide = (width - 60) / max(1, len(rows))
    bars = []
    for i, (name, v) in enumerate(rows):
        tall = (height - 60) * (v or 0) / top
        bars.append(f'<rect x="{40 + i * wide:.1f}" y="{height - 30 - tall:.1f}" width="{wide * 0.8:.1f}" height="{tall:.1f}"><title>{escape(str(name))}: {(v or 0):,.1f}</title></rect>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" fill="currentColor">{"".join(bars)}</svg>'


def lines_svg(df: DataFrame, x: str, values: Sequence[str], width: int = 640, height: int = 320, most: int = 1500) -> str:
    """A line for each of ``values`` along ``x`` (numbers or dates); a NULL breaks its line."""
    rows = _few(df.select(x, *values).filter(f"{x} is not null").orderBy(x), most)
    at = [r[0].toordinal() if hasattr(r[0], "toordinal") else r[0] for r in rows]
    known = [v for r in rows for v in r[1:] if v is not None]
    if not known:
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"/>'
    lo, span, low, tall = at[0], (at[-1] - at[0]) or 1, min(known), (max(known) - min(known)) or 1
    lines = []
    for k in range(1, len(values) + 1):
        path, pen = [], "M"
        for p, r in zip(at, rows, strict=True):
            if r[k] is None:
                pen = "M"
                continue
            path.append(f"{pen}{40 + (width - 60) * (p - lo) / span:.1f},{height - 30 - (height - 60) * (r[k] - low) / tall:.1f}")
            pen = "L"
        lines.append(f'<path fill="none" stroke="currentColor" d="{" ".join(path)}"><title>{escape(values[k - 1])}</title></path>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}">{"".join(lines)}</svg>'


def _few(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows: aggregate first")
    return rows


def load_sentence(fitness: DataFrame) -> str:
    """Fitness, fatigue and form of the latest day, from ``mart_fitness_daily``."""
    r = fitness.orderBy(F.desc("fitness_date")).first()
    return "" if r is None or r.ctl is None or r.atl is None else f"Fitness {r.ctl:.0f}, fatigue {r.atl:.0f}, form {r.ctl - r.atl:+.0f} on {r.fitness_date}."


#: Sections of the overview: heading, and its tables (heading or "", mart, columns, order).
SECTIONS = (
    ("1. Totals by sport", (("", "mart_sport_totals", ("sport", "activities", "distance_km", "moving_h", "elev_m"), ("sport",)),)),
    ("2. Years", (("", "mart_yearly_summary", ("year", "sport", "activities", "distance_km", "moving_h", "elev_m"), ("-year", "sport")),)),
    ("3. Cycling", (
        ("Bikes", "mart_gear_usage", ("gear_label", "activities", "distance_km", "moving_h", "first_used", "last_used"), ("-distance_km", "gear_id")),
        ("Power curve", "mart_power_curve", ("window_label", "duration_label", "best_watts", "activity_date", "name"), ("window_label", "duration_s")),
        ("Threshold estimates", "mart_ftp_estimate", ("window_label", "by_20min", "cp", "w_prime", "method_spread"), ("window_label",)),
        ("Load", "mart_fitness_daily", ("fitness_date", "ctl", "atl", "form"), ("-fitness_date",)),
        ("Service", "mart_service_metrics", ("activity_date", "fitness", "fatigue", "form", "load", "implied_ftp"), ("-activity_date", "-activity_id")),
    )),
    ("4. Swimming", (("", "mart_swim_pace_monthly", ("month", "swims", "distance_m", "pace_label"), ("-month",)),)),
    ("5. Duplicates left out", (("", "duplicates", ("activity_date", "sport", "name", "distance_km", "duplicate_of_activity_id"), ("-activity_date", "activity_id")),)),
    ("6. Symptoms and fitting", (
        ("Knee by setup", "mart_fitting_epochs", ("epoch", "changes", "rides", "knee_rides", "knee_avg", "knee_max"), ("first_ride", "epoch")),
        ("Latest rides", "mart_symptom_ride", ("activity_date", "name", "distance_km", "symptoms", "knee_medial_l", "saddle"), ("-activity_date", "-activity_id")),
    )),
)


def overview(silver: DataFrame, marts: Mapping[str, DataFrame], ftp: DataFrame, as_of: dt.date, recent_days: int = 14, most: int = 40) -> str:
    """The Markdown overview, sections 0 to 6. A mart that is absent has no table; a table shows its first ``most`` rows."""
    n = silver.agg(F.count(F.lit(1)).alias("n"), F.min("activity_date").alias("a"), F.max("activity_date").alias("b"), F.count_if("is_duplicate").alias("d")).first()
    out = [f"# Overview, {as_of}", "", f"- Activities: {n.n} ({n.a} to {n.b})", f"- Duplicates left out: {n.d}", f"- Threshold power: {ftp.first().ftp:.0f} W", "", "## 0. Now", ""]
    if "mart_training_status" in marts:
        out += [status_sentence(marts["mart_training_status"]), ""]
    if "mart_fitness_daily" in marts:
        out += [load_sentence(marts["mart_fitness_daily"]), ""]
    if "mart_activity_feed" in marts:
        age = F.datediff(F.lit(as_of), "activity_date")
        feed = marts["mart_activity_feed"].filter(age.between(0, recent_days - 1) & F.col("sport").isin("cycling", "running", "swimming"))
        out += [markdown_table(feed.orderBy(F.desc("activity_date"), F.desc("activity_id")), ("activity_date", "sport", "name", "distance_km", "moving_min", "symptoms"), most), ""]
    known = {**marts, "duplicates": silver.filter("is_duplicate")}
    for title, tables in SECTIONS:
        out += [f"## {title}", ""]
        for heading, mart, columns, order in tables:
            if mart in known:
                by = [F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]
                out += [*([f"### {heading}", ""] if heading else []), markdown_table(known[mart].orderBy(*by), columns, most), ""]
    return "\n".join(out)


# Pacing evidence. No place leaves: windows come without their anchors.

#: What the evidence can say, and what to ask next, by status.
QUESTIONS = {
    "no_eligible_ride": "Is there an outdoor ride of three hours or more with power, places and cadence?",
    "no_comparable_segments": "Were the early hard stretches planned, or did the power rise by following others? Repeated routes make comparisons possible.",
    "observations_available": "Were the compared stretches ridden with a like purpose? What was unusual: food, wind, heat, rest?",
}
EXPERIMENT = "If the early effort was not meant, hold the power back there on the next ride of this kind, and compare late power, heart rate and feeling on the same stretch."
LIMITS = (
    "Observed power only: neither a limit of what was possible nor a cause of fatigue.", "Weather, food, purpose and the day's form are not held equal.",
    "Work in seconds without a record is unknown, so recorded work is a lower bound.", "The threshold sorts efforts; it was not measured that day.",
)


def pacing_evidence(metas: DataFrame, targets: DataFrame, compared: DataFrame, early: DataFrame, quality: DataFrame, ftp: float | None = None) -> dict:
    """Evidence about one target (``targets``: at most one row): its comparisons and early efforts, which are as many as a ride has windows at most."""
    one = targets.first()
    if one is None:
        status = "no_eligible_ride"
        return {"schema_version": 1, "ftp_anchor": ftp, "limitations": list(LIMITS), "target": None, "comparisons": [], "comparison_count": 0, "status": status, "next_question": QUESTIONS[status]}
    own = F.col("activity_id") == one.activity_id
    plain = lambda r: {k: v if isinstance(v, (int, float, str, bool, type(None))) else str(v) for k, v in r.asDict().items()}
    rows = compared.filter(own).orderBy("start_s").collect()
    pairs = [
        {"start_s": r.start_s, "end_s": r.end_s, "avg_watts": r.avg_watts, "reference_median_watts": r.reference_watts, "observed_change_pct": r.change_pct,
         "references": [{"activity_id": x.r_activity_id, "start_s": x.r_start_s, "avg_watts": x.r_avg_watts, "anchor_distance_sum_m": x.apart_m} for x in r.references]} for r in rows
    ]
    shown = [c for c in ("activity_id", "name", "activity_date", "start_utc", "moving_time", "gear_id", "is_indoor", "device_watts") if c in metas.columns]
    limits = [*LIMITS, *(() if one.gear_id else ("The bike is not known, so only the ride itself is compared.",))]
    status = "observations_available" if pairs else "no_comparable_segments"
    sound = quality.filter(own).first()
    out = {
        "schema_version": 1, "ftp_anchor": ftp, "limitations": limits, "target": plain(metas.filter(own).select(*shown).first()), "quality": plain(sound) if sound else {},
        "early_efforts": [plain(r) for r in early.filter(own).orderBy("start_s").collect()], "comparisons": pairs, "comparison_count": len(pairs), "status": status, "next_question": QUESTIONS[status],
    }
    return out | {"next_experiment": EXPERIMENT} if pairs else out


_HEADS = ("stretch", "power W", "earlier median W", "change %", "compared with")


def _clock(seconds: float) -> str:
    return f"{int(seconds) // 3600}:{int(seconds) // 60 % 60:02d}"


def _pacing_parts(data: Mapping) -> tuple[list[str], list[list[str]]]:
    """Lines about the target and its early efforts, and the rows of the comparisons."""
    t = data["target"]
    lines = [f"{t.get('name') or t['activity_id']}, {t.get('activity_date', '')}"] if t else []
    lines += [f"{_clock(e['start_s'])} to {_clock(e['end_s'])}: {e['avg_watts']:.0f} W on average, {e['above_s']} s above {data['ftp_anchor'] or 0:.0f} W" for e in data.get("early_efforts", [])]
    change = lambda c: "·" if c is None else f"{c:+.1f}"
    rows = [[f"{_clock(c['start_s'])} to {_clock(c['end_s'])}", f"{c['avg_watts']:.0f}", f"{c['reference_median_watts']:.0f}", change(c["observed_change_pct"]), f"{len(c['references'])} earlier"] for c in data["comparisons"]]
    return lines, rows


def pacing_json(data: Mapping) -> str:
    return json.dumps(data, ensure_ascii=False, sort_keys=True, allow_nan=False)


def pacing_markdown(data: Mapping) -> str:
    clean = lambda x: " ".join(str(x).replace("|", "/").split())
    lines, rows = _pacing_parts(data)
    out = ["### Pacing of a long ride", "", *[f"- {clean(x)}" for x in lines], ""]
    if rows:
        out += [f"| {' | '.join(_HEADS)} |", f"|{'---|' * len(_HEADS)}", *[f"| {' | '.join(map(clean, r))} |" for r in rows], ""]
    out += [f"Next: {data['next_question']}", *([data["next_experiment"]] if "next_experiment" in data else []), "", *[f"- {clean(x)}" for x in data["limitations"]], ""]
    return "\n".join(out)


def pacing_html(data: Mapping) -> str:
    items = lambda xs: f"<ul>{''.join(f'<li>{escape(str(x))}</li>' for x in xs)}</ul>" if xs else ""
    cells = lambda tag, xs: f"<tr>{''.join(f'<{tag}>{escape(x)}</{tag}>' for x in xs)}</tr>"
    lines, rows = _pacing_parts(data)
    table = f"<table>{cells('th', _HEADS)}{''.join(cells('td', r) for r in rows)}</table>" if rows else ""
    after = f"<p>{escape(data['next_experiment'])}</p>" if "next_experiment" in data else ""
    return f'<section class="pacing"><h2>Pacing of a long ride</h2>{items(lines)}{table}<p>{escape(data["next_question"])}</p>{after}{items(data["limitations"])}</section>'
