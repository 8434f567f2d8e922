"""Operator 6: language identification by interpolated Kneser-Ney character models.

Texts become lower-cased letters (composed, with their marks) with single spaces between words. All training documents are counted: one shuffle sums the
4-grams of each language, and every lower order follows from them (continuation counts). Each language's model is a set of sorted
arrays of packed n-grams. A text gets the language of least cross-entropy per character. How sure that is comes
from all training documents, which the executors score once more: a temperature for the posterior, the
spread of the right language's cross-entropy by length, and how many spreads off a text has to be to be rejected as
written in none of the languages: their top hundredth, carried on as an exponential tail to a share of ``false_rejects`` of texts in known languages. No count is left out. If there are more than ``max_grams`` 4-grams, models come in parts of about that many, by the
last character but one: all orders above the first that a 4-gram asks for stand in the same part, and what parts share (discounts and the first order)
is small. Parts are broadcast one by one and a worker holds one at a time; only the 4-grams of a single last character but one are never parted.

Cases: a null text or one without letters is 'und' with score 0 and rejected; without training documents so is everything; ties go to the
language that sorts first; repeated rows are judged (and counted) one by one; input columns named like the results are replaced.
"""

from __future__ import annotations

import gc
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import STEP_BYTES, byte_column, extended, release, set_aside, staged, steps

ORDER = 4
_SPACE = 32
#: Least spread in nats a character: passages in another language alone do not get a text rejected.
FLOOR = 0.15


def _letters(made: list = []) -> list[np.ndarray]:  # noqa: B006  one pair of tables for each process
    """Which code points are letters, and which are letters or marks on them."""
    if not made:
        made.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
        made.append(made[0] | np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000))
    return made


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams, one for each character kept (three empty places stand before a text), and how many each text has; 0 without letters."""
    lowered = [unicodedata.normalize("NFC", (x or "").lower()) for x in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(x) for x in lowered])
    letter, inside = (table[points] for table in _letters())
    code = np.where(inside, np.where(points > 0xFFFF, 0xE000 + points % 0x1900, points), _SPACE).astype(np.uint64)
    same = np.zeros(len(row), bool)
    same[1:] = row[1:] == row[:-1]
    keep = np.ones(len(row), bool)
    keep[1:] = ~((code[1:] == _SPACE) & (code[:-1] == _SPACE) & same[1:])
    keep &= np.bincount(row[letter], minlength=len(texts))[row] > 0
    code, row = code[keep], row[keep]
    counts = np.bincount(row, minlength=len(texts))
    line = np.zeros(len(code) + 3 * len(texts), np.uint64)
    at = np.arange(len(code)) + 3 * (row + 1)
    line[at] = code
    packed = np.zeros(len(code), np.uint64)
    for k in range(ORDER):
        packed |= line[at - k] << np.uint64(16 * k)
    return packed, counts


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _level(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted n-grams with counts, and their sorted contexts with sums and numbers of followers; numbers in as few bytes as hold them."""
    context, first, followers = np.unique(keys >> np.uint64(16), return_index=True, return_counts=True)
    total = np.add.reduceat(counts, first) if len(keys) else counts
    return keys, _narrow(counts), context, _narrow(total), _narrow(followers)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x


def _rare(counts: np.ndarray) -> tuple[int, int]:
    return int((counts == 1).sum()), int((counts == 2).sum())


class Common:
    """What the parts of a language share: the discounts of all orders and the first order."""

    def __init__(self, parts: list[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]):
        keys, place = np.unique(np.concatenate([k for _, k, _ in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, _, c in parts]), len(keys)).astype(np.int64)
        rare = [tuple(map(sum, zip(*own, strict=True))) for own in zip(*(r for r, _, _ in parts), strict=True)] + [_rare(counts)]
        self.discounts = [min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5 for ones, twos in rare]
        self.level = _level(keys, counts)
        self.base = 1.0 / (len(keys) + 1000)


class Model:
    """One language, or its part with certain last characters but one: the orders above the first, and what the part adds to ``Common``."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        self.levels, rare = [], []
        for n in range(ORDER, 1, -1):
            rare.append(_rare(counts))
            self.levels.append(_level(keys, counts))
            keys, counts = np.unique(keys & np.uint64((1 << (16 * (n - 1))) - 1), return_counts=True)
        self.adds = rare, keys, counts

    def probability(self, keys: np.ndarray, level: int = 0, common: Common | None = None) -> np.ndarray:
        """Interpolated: each order's discounted share, and the next lower order's probability for the rest."""
        common = common or Common([self.adds])
        if level == ORDER:
            return np.full(len(keys), common.base)
        n = ORDER - level
        low = self.probability(keys & np.uint64((1 << (16 * (n - 1))) - 1), level + 1, common)
        grams_, counts, context, total, followers = self.levels[level] if n > 1 else common.level
        discount = common.discounts[level]
        at, there = _find(context, keys >> np.uint64(16))
        if not len(context):
            return low
        own, seen = _find(grams_, keys)
        share = np.where(seen, np.maximum(counts[own] - discount, 0), 0) / total[at]
        return np.where(there, share + discount * followers[at] / total[at] * low, low)


@dataclass
class Identifier:
    names: list[str]
    #: Each part has a model for each name; it begins at one of ``starts``, codes of the last character but one.
    parts: list[Broadcast]
    starts: np.ndarray
    commons: list[Common]
    temperature: float = 10.0
    mean: np.ndarray | None = None
    spread: tuple[float, float] = (1.0, 0.1)
    reject_at: float = 8.0  # until calibrated

    def unload(self) -> None:
        """Take the models from the executors; whatever asks again gets them again."""
        for part in self.parts:
            part.unpersist()

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a character under each language, and characters."""
        packed, counts = grams(texts)
        out = np.zeros((len(texts), len(self.names)))
        if len(packed):
            keys, place = np.unique(packed, return_inverse=True)
            row = np.repeat(np.arange(len(texts)), counts)
            part = np.searchsorted(self.starts, keys >> np.uint64(16) & np.uint64(0xFFFF), "right") - 1
            nats = np.zeros((len(self.names), len(keys)))
            for k in np.unique(part).tolist():
                own = part == k
                for i, (model, common) in enumerate(zip(self.parts[k].value, self.commons, strict=True)):
                    nats[i, own] = -np.log(model.probability(keys[own], 0, common))
                if len(self.parts) > 1 and self.parts[k]._path:  # what has a file can be read again
                    self.parts[k].__dict__.pop("_value", None)
            for i in range(len(self.names)):
                out[:, i] = np.bincount(row, nats[i][place], len(texts))
        return out / np.maximum(counts, 1)[:, None], counts

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, counts = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        posterior = 1 / np.exp(-self.temperature * (entropy - least[:, None])).sum(axis=1)
        mean = self.mean if self.mean is not None else np.zeros(len(self.names))
        a, b = self.spread
        off = (least - mean[best]) / np.sqrt(a / np.maximum(counts, 1) + b)
        score = posterior / (1 + np.exp(np.clip(off - self.reject_at, -50, 50)))
        empty = counts == 0
        return [("und" if e else self.names[i]) for i, e in zip(best, empty, strict=True)], np.where(empty, 0, score), empty | (off > self.reject_at)


def _batched(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    _, offsets = byte_column(column)
    for lo, hi in steps(offsets, 2 * STEP_BYTES):
        yield lo, column.slice(lo, hi - lo).to_pylist()


def learned(training: DataFrame, max_grams: int = 4_000_000, false_rejects: float = 1e-6) -> Identifier:
    """Models from ``training`` (doc_id, text, lang; rows without lang don't count), in parts of about ``max_grams`` 4-grams."""
    training = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            which, names = names.indices.to_numpy(), names.dictionary.to_pylist()
            found: dict[str, list] = {name: [] for name in names}
            for lo, texts in _batched(batch.column("text")):
                packed, counts = grams(texts)
                own = np.repeat(which[lo : lo + len(texts)], counts)
                for i, name in enumerate(names):
                    found[name].append(np.unique(packed[own == i], return_counts=True))
            for name, parts in found.items():
                keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(place, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    counts = training.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    names = sorted(r.lang for r in counts.select("lang").distinct().collect())
    before = F.shiftright("gram", 16).bitwiseAND(F.lit(0xFFFF))
    starts, held = [0], 0
    for code, n in sorted(counts.groupBy(before.alias("c")).count().collect()):
        if held and held + n > max_grams:
            starts.append(code)
            held = 0
        held += n
    place = F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1 if names else F.lit(0)
    parts, adds = [], []
    for first, end in zip(starts, [*starts[1:], 1 << 16], strict=True) if names else ():
        table = counts.filter((before >= first) & (before < end)).select(place.cast("short").alias("lang"), "gram", "n").toArrow()
        lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
        models = [Model(gram[lang == i].view(np.uint64), n[lang == i]) for i in range(len(names))]
        parts.append(training.sparkSession.sparkContext.broadcast(models))
        adds.append([m.adds for m in models])
    counts.unpersist()
    out = Identifier(names, parts, np.array(starts, np.uint64), [Common(list(own)) for own in zip(*adds, strict=True)])
    if names:
        gc.collect()
        pa.default_memory_pool().release_unused()
        _calibrate(out, training, false_rejects)
    return out


#: Temperatures that calibration chooses from.
_TEMPERATURES = [2.0**k for k in range(-1, 9)]


def _at(values: DataFrame, rank: int, lo: float, hi: float, n: int, held: int) -> float:
    """The value of a rank among those of column ``v``: counts of 1,024 bins of the range, then of the bin that holds it, until few are left."""
    while n > held and lo < hi:
        bins = values.filter(F.col("v").between(lo, hi)).groupBy(F.least(F.floor((F.col("v") - lo) / (hi - lo) * 1024), F.lit(1023)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in sorted(bins.collect()):
            if rank < r.n:
                lo, hi, n = r.lo, r.hi, r.n
                break
            rank -= r.n
    return lo if lo == hi else float(np.partition(values.filter(F.col("v").between(lo, hi)).toArrow().column("v").to_numpy(), rank)[rank])


def exact_quantile(values: DataFrame, share: float, held: int = 50_000) -> float:
    """The quantile of column ``v`` over all rows, between two ranks as numpy has it; at most ``held`` values are on the driver at a time."""
    r = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n")).first()
    if r.n <= held:
        return float(np.quantile(values.toArrow().column("v").to_numpy(), share))
    place = share * (r.n - 1)
    low = _at(values, int(place), r.lo, r.hi, r.n, held)
    return low if place == int(place) else low + (place - int(place)) * (_at(values, int(place) + 1, r.lo, r.hi, r.n, held) - low)


def _calibrate(model: Identifier, training: DataFrame, false_rejects: float) -> None:
    """Temperature, means, spread and threshold from all of ``training`` (text, lang): the executors score it, and figures are sums and quantiles over the scores."""
    names = model.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lo, texts in _batched(batch.column("text")):
                entropy, counts = model.entropies(texts)
                truth = np.array([names.index(x) for x in langs.slice(lo, len(texts)).to_pylist()])
                use = counts > 0
                entropy, counts, truth = entropy[use], counts[use], truth[use]
                if not len(truth):
                    continue
                each = np.arange(len(truth))
                off = entropy - entropy.min(axis=1, keepdims=True)
                losses = [float((np.log(np.exp(-t * off).sum(axis=1)) + t * off[each, truth]).sum()) for t in _TEMPERATURES]
                first = [losses] + [None] * (len(truth) - 1)  # a step's sums stand in its first row
                yield pa.RecordBatch.from_arrays([pa.array(truth), pa.array(counts.astype(np.int64)), pa.array(entropy[each, truth]), pa.array(first, pa.list_(pa.float64()))], ["truth", "n", "own", "losses"])

    scores = staged(training.select("text", "lang").mapInArrow(score, "truth long, n long, own double, losses array<double>"), "calibration")
    exact = lambda c: F.sum(c.cast("decimal(28, 12)"))  # noqa: E731  the same in whatever order rows are added
    own = {r.truth: r for r in scores.groupBy("truth").agg(exact(F.col("own") * F.col("n")).alias("nats"), F.sum("n").alias("n"), exact(F.col("own")).alias("own"), F.count(F.lit(1)).alias("rows")).collect()}
    if own:
        losses = scores.agg(*[F.sum(F.col("losses")[i]).alias(f"t{i}") for i in range(len(_TEMPERATURES))]).first()
        model.temperature = min(zip(losses, _TEMPERATURES, strict=True))[1]
        other = float(sum(r.own for r in own.values())) / sum(r.rows for r in own.values())
        model.mean = np.array([float(own[i].nats) / own[i].n if i in own else other for i in range(len(names))])
        apart = F.col("own") - F.element_at(F.array(*map(F.lit, model.mean.tolist())), (F.col("truth") + 1).cast("int"))
        middle = exact_quantile(scores.select(F.col("n").cast("double").alias("v")), 0.5)
        b = max(FLOOR**2, exact_quantile(scores.filter(F.col("n") >= middle).select((apart * apart).alias("v")), 0.5))
        a = max(0.05, exact_quantile(scores.select((F.greatest(apart * apart - b, F.lit(0.0)) * F.col("n")).alias("v")), 0.5))
        model.spread = (a, b)
        off = scores.select((apart / F.sqrt(a / F.col("n") + b)).alias("v"))
        high = exact_quantile(off, 0.99)
        tail = off.filter(F.col("v") >= high).agg(exact(F.col("v") - high).alias("sum"), F.count(F.lit(1)).alias("n")).first()
        model.reject_at = max(3.0, high + float(tail["sum"]) / tail.n * float(np.log(0.01 / false_rejects)))
    release(training.sparkSession, scores)


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """``docs`` (text and others) with lang_pred, score (0 to 1) and lang_rejected."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        names, scores, rejected = [], [np.zeros(0)], [np.zeros(0, bool)]
        for _, texts in _batched(batch.column("text")):
            a, b, c = model.judged(texts)
            names += a
            scores.append(b)
            rejected.append(c)
        return [pa.array(names, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(rejected))]

    return extended(docs, "lang_pred string, score double, lang_rejected boolean", compute)


def keep_identified(docs: DataFrame, model: Identifier) -> DataFrame:
    """``docs`` (text, lang and others) with its own columns, without the texts that are rejected; a null lang becomes the one found."""
    own, back = set_aside(docs, "text", "lang")
    return back(identify(own, model).filter(~F.col("lang_rejected")).withColumn("lang", F.coalesce("lang", "lang_pred")))


def held_out() -> Column:
    """Documents that are never learned from: crc32 of doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learned(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
