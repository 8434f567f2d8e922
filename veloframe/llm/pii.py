"""Operator 7: personal data by patterns and a skip-chain conditional random field.

Base spans are found by patterns (e-mail, IP address, payment card with Luhn's check, phone number). The field adds to them. Its
nodes are the stretches of a text that hold digits or '@', and e-mail addresses with a bracketed "at"; labels are the four kinds and 'none'. Neighbours within
``CHAIN_GAP`` code points are chained, and distant nodes with the same digits, the same last seven digits or the same spelling
share a skip potential, so one sure mention carries over to its repetitions in odd formats. All mentions of a key are tied to one of
them, a sure one if there is any, so evidence is one step away however often it is repeated. Base spans hold
their nodes' labels; damped loopy sum-product messages, passed until they stop changing, give the others' marginals, and what a kind holds with at least
``SURE`` is added. Weights come from pseudo-likelihood on a bounded sample of documents, labelled by the patterns
(about ``fit_docs`` documents with a digit or '@', picked by hash). The patterns can't label what they miss, so each sampled document is
read with its sure mentions written once more in odd formats (``odd``), which carry their labels, and nodes that share a key with a
sure mention but are not one themselves are left out: they are what the field is to judge, not examples of 'none'.

Cases: null counts as empty; offsets are code points; a span that the field adds is its node's; a text without digits and '@' costs one look at its bytes; documents
with no example to fit on get the base spans alone; repeated rows are judged one by one; input columns named like the results are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import bounded_sample, byte_column, extended, set_aside, steps

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
CHAIN_GAP, SURE, DAMPING, HELD = 40, 0.9, 0.5, 30.0
#: Messages stop when none changes by more than CHANGE; ROUNDS only guards against those that never settle.
CHANGE, ROUNDS = 1e-4, 400
#: Bytes of text whose graphs are solved together; a single longer text is a step of its own.
GRAPH_BYTES = 1 << 19
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # no match can begin inside digits
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]+)\s?(?:@|[\[({]\s?(?:at|@)\s?[\])}])\s?([A-Za-z0-9.-]+)", re.IGNORECASE)
_BRACKETED = re.compile(r"[\[({]\s?(?:at|@)\s?[\])}]", re.IGNORECASE)
_STRETCH = re.compile(r"[+(]?[0-9](?:[\x20().\-]{0,2}[0-9])*")
_HINT = np.zeros(256, bool)
_HINT[[*range(48, 58), 64]] = True

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, in time linear in the text: a local part must touch its '@', and none goes over another '@'."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    out = emails(text)
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


@dataclass
class Nodes:
    """Stretches of one text: places, features, base labels (-1: open) and edges."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    held: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


N_FEATURES = 20


def _addresses(text: str) -> list[tuple[int, int]]:
    """What stands around each '@', to the next white space, and addresses with a bracketed "at"."""
    spans, at, end = [], text.find("@"), 0
    while at >= 0:
        lo, hi = at, at + 1
        while lo > end and not text[lo - 1].isspace():
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        spans.append((lo, hi))
        end = hi
        at = text.find("@", hi)
    if not spans:  # only an address that is spelt out somewhere can vouch for another
        return spans
    for m in _BRACKETED.finditer(text):
        lo, hi = m.start(), m.end()
        lo -= lo > 0 and text[lo - 1] == " "
        hi += hi < len(text) and text[hi] == " "
        while lo > 0 and text[lo - 1] in LOCAL:
            lo -= 1
        while hi < len(text) and (text[hi].isascii() and text[hi].isalnum() or text[hi] in ".-"):
            hi += 1
        spans.append((lo, hi))
    spans.sort()
    apart: list[tuple[int, int]] = []
    for lo, hi in spans:
        if apart and lo < apart[-1][1]:
            apart[-1] = (apart[-1][0], max(hi, apart[-1][1]))
        else:
            apart.append((lo, hi))
    return apart


def nodes(text: str, base: list[Span]) -> Nodes:
    addresses = _addresses(text)
    spans = [(lo, hi, True) for lo, hi in addresses]
    taken = np.array(addresses) if addresses else np.zeros((0, 2), np.int64)
    for m in _STRETCH.finditer(text):
        if len(taken):
            i = np.searchsorted(taken[:, 0], m.end()) - 1
            if i >= 0 and taken[i, 1] > m.start():
                continue
        spans.append((*m.span(), False))
    spans.sort()
    features, keys, chain = np.zeros((len(spans), N_FEATURES)), [], []
    held, j = np.full(len(spans), -1), 0
    for i, (lo, hi, address) in enumerate(spans):
        x = text[lo:hi]
        parts = _DIGITS.findall(x)
        digits = "".join(parts)
        n = len(digits)
        left, right = text[lo - 1 : lo], text[hi : hi + 1]
        bucket = int(np.searchsorted([1, 4, 7, 9, 12, 16, 20], n, "right"))
        f = features[i]
        f[0], f[1 + bucket] = 1, 1
        f[9:] = [
            address, x.count(".") == 3 and len(parts) == 4, "." in x, x.startswith("+"), "(" in x, " " in x, "-" in x, left.isalpha() or left in "=\"'",
            right.isalpha(), 12 <= n <= 19 and luhn(digits), len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts),
        ]
        if i and lo - spans[i - 1][1] <= CHAIN_GAP:
            chain.append((i - 1, i))
        spelt = _ADDRESS.search(x) if address else None
        if address:
            keys.append([("w", f"{spelt[1]}@{spelt[2]}".lower().rstrip(".-"))] if spelt else [])
        else:
            keys.append([("d", digits)] * (n >= 6) + [("7", digits[-7:])] * (n >= 7))
        while j < len(base) and base[j][2] <= lo:
            j += 1
        k = j
        while k < len(base) and base[k][1] < hi:
            if base[k][2] > lo:
                held[i] = base[k][0]
                break
            k += 1
    hubs: dict[tuple[str, str], int] = {}
    for sure in (True, False):
        for i, own in enumerate(keys):
            if (held[i] >= 0) == sure:
                for key in own:
                    hubs.setdefault(key, i)
    skip = sorted({(min(i, h), max(i, h)) for i, own in enumerate(keys) for key in own if (h := hubs[key]) != i})
    return Nodes([(lo, hi) for lo, hi, _ in spans], features, held, chain, skip)


_APART = " and so on, as was said before, and so on, as was said before, and so on. "


def odd(text: str, base: list[Span]) -> tuple[str, list[Span]]:
    """The text with its sure mentions once more, each in a format that the patterns don't know, and where those stand. Formats take turns."""
    out, end, more, seen = [text], len(text), [], set()
    for turn, (kind, a, b) in enumerate(base):
        x = text[a:b]
        parts = _DIGITS.findall(x)
        digits = "".join(parts)
        if (kind, digits if kind else x) in seen:
            continue
        seen.add((kind, digits if kind else x))
        if kind == 0:
            name, _, domain = x.partition("@")
            made = f"{name} (at) {domain}" if turn % 2 else f"{name}[at]{domain}"
        elif kind == 1:
            made = "-".join(parts) if turn % 2 else " ".join(parts)
        elif kind == 2:
            groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
            made = ".".join(groups) if turn % 2 else "  ".join(groups)
        else:
            made = [digits, f"{digits[:-10]} ({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}".strip(), f"{digits[-10:-7]}.{digits[-7:-4]}.{digits[-4:]}"][turn % 3]
        out += [_APART, made]
        more.append((kind, end + len(_APART), end + len(_APART) + len(made)))
        end = more[-1][2]
    return "".join([*out, _APART]), more


def example(text: str) -> Nodes:
    """Nodes to fit on: labels in ``held``, -2 where there is none to learn from."""
    base = base_spans(text)
    text, more = odd(text, base)
    out = nodes(text, base)
    sure = out.held >= 0
    for i, (lo, hi) in enumerate(out.spans):
        for kind, a, b in more if out.held[i] < 0 else ():
            if a < hi and b > lo:
                out.held[i] = kind
    for a, b in out.skip:
        for i, other in ((a, b), (b, a)):
            if sure[other] and out.held[i] == -1:
                out.held[i] = -2
    return out


@dataclass
class Weights:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(found: list[Nodes], rounds: int = 300) -> Weights | None:
    """Pseudo-likelihood: every node (but those labelled -2) given its features and its neighbours' labels, by gradient ascent."""
    found = [x for x in found if x.spans]
    if not found:
        return None
    k = NONE + 1
    inputs, labels = [], []
    for x in found:
        y = np.where(x.held < 0, NONE, x.held)
        near = np.zeros((len(y), 2 * k))
        for at, edges in ((0, x.chain), (k, x.skip)):
            for a, b in edges:
                near[a, at + y[b]] += x.held[b] > -2
                near[b, at + y[a]] += x.held[a] > -2
        known = x.held > -2
        inputs.append(np.hstack([x.features, near])[known])
        labels.append(y[known])
    inputs, labels = np.vstack(inputs), np.concatenate(labels)
    target = np.eye(k)[labels]
    weights, speed = np.zeros((inputs.shape[1], k)), np.zeros((inputs.shape[1], k))
    for _ in range(rounds):
        p = _softmax(inputs @ weights)
        step = inputs.T @ (target - p) / len(labels) - 1e-4 * weights
        speed = 0.9 * speed + step
        weights += 0.5 * speed
    a, s = weights[N_FEATURES : N_FEATURES + k], weights[N_FEATURES + k :]
    return Weights(weights[:N_FEATURES], (a + a.T) / 2, (s + s.T) / 2)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def marginals(found: list[Nodes], weights: Weights) -> list[np.ndarray]:
    """Loopy sum-product over all documents at once; their graphs don't touch."""
    k, sizes = NONE + 1, [len(x.spans) for x in found]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    held = np.concatenate([x.held for x in found])
    unary = np.vstack([x.features for x in found]) @ weights.unary
    unary[held >= 0, held[held >= 0]] += HELD
    edges = [(a + o, b + o, t) for x, o in zip(found, offsets.tolist(), strict=False) for t, own in ((0, x.chain), (1, x.skip)) for a, b in own]
    if edges:
        a, b, t = np.array(edges).T
        source, to = np.concatenate([a, b]), np.concatenate([b, a])
        potential = np.stack([weights.chain, weights.skip])[np.concatenate([t, t])]
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), k))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, to, message)
            out = (belief[source] - message[back])[:, :, None] + potential
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            new = DAMPING * message + (1 - DAMPING) * new
            still = np.abs(new - message).max() < CHANGE
            message = new
            if still:
                break
        np.add.at(unary, to, message)
    return np.split(_softmax(unary), offsets[1:-1])


def hinted(batch: pa.RecordBatch) -> np.ndarray:
    """Rows with a digit or an '@'."""
    data, offsets = byte_column(batch.column("text"))
    out = np.zeros(batch.num_rows, bool)
    for lo, hi in steps(offsets):
        places = np.flatnonzero(_HINT[data[offsets[lo] : offsets[hi]]]) + offsets[lo]
        out[lo:hi] = np.diff(np.searchsorted(places, offsets[lo : hi + 1])) > 0
    return np.flatnonzero(out)


def learned(docs: DataFrame, fit_docs: int = 2000) -> Weights | None:
    sample = bounded_sample(docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]")), ["doc_id", "text"], fit_docs)
    return fit([example(r.text) for r in sample])


def find_personal_data(docs: DataFrame, weights: Weights | None = None, fit_docs: int = 2000) -> DataFrame:
    """``docs`` (doc_id, text and others) with base_spans and all_spans: kind, start, end in code points, by start, then kind."""
    weights = weights or learned(docs, fit_docs)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        base: list[list[Span]] = [[]] * batch.num_rows
        every: list[list[Span]] = [[]] * batch.num_rows
        rows, (_, offsets) = hinted(batch), byte_column(batch.column("text"))
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets)[rows])])
        for lo, hi in steps(ends, GRAPH_BYTES):
            own = rows[lo:hi].tolist()
            texts = batch.column("text").take(pa.array(own)).to_pylist()
            found = []
            for i, text in zip(own, texts, strict=True):
                base[i] = every[i] = base_spans(text)
                found.append(nodes(text, base[i]))
            if not weights or not any(x.spans for x in found):
                continue
            for i, x, p in zip(own, found, marginals(found, weights), strict=True):
                best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
                more = [(int(best[j]), *x.spans[j]) for j in np.flatnonzero((best != NONE) & (x.held < 0)) if p[j, best[j]] >= SURE]
                if more:
                    every[i] = sorted(base[i] + more, key=lambda s: (s[1], s[0], s[2]))
        return [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in row] for row in table], kind) for table in (base, every)]

    span = "array<struct<kind:string,start:long,end:long>>"
    return extended(docs, f"base_spans {span}, all_spans {span}", compute)


def redact(docs: DataFrame, weights: Weights | None = None, fit_docs: int = 2000) -> DataFrame:
    """``docs`` with its own columns; each span in the text becomes its kind in brackets, overlapping spans the first's."""
    own, back = set_aside(docs, "doc_id", "text")
    found = find_personal_data(own, weights, fit_docs)
    cut = F.expr(
        "aggregate(all_spans, named_struct('at', 0L, 'out', ''),"
        " (a, s) -> if(s.start < a.at, named_struct('at', greatest(a.at, s.end), 'out', a.out),"
        " named_struct('at', s.end, 'out', concat(a.out, substring(text, cast(a.at + 1 as int), cast(s.start - a.at as int)), '[', upper(s.kind), ']'))),"
        " a -> concat(a.out, substring(text, cast(a.at + 1 as int), length(text))))"
    )
    return back(found.withColumn("text", F.when(F.size("all_spans") > 0, cut).otherwise(F.col("text"))))


def digests(found: DataFrame) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base_spans, s -> s.kind = '{k}')) as long) as n_{k}") for k in KINDS]
    joined = {c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",") for c in ("base_spans", "all_spans")}
    return found.select("doc_id", *counts, F.sha2(joined["base_spans"], 256).alias("base_sha256"), joined["all_spans"].alias("spans"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
