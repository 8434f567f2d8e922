"""Operator 8: licence notices and SPDX expressions.

Texts become their words (A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`) with one space between, and one Aho-Corasick automaton
finds all phrases in a single pass. Where the tag's phrase occurs, the expression behind the tag is read from the text, a shunting-yard
parser puts it in postfix order (``with`` binds before ``and``, ``and`` before ``or``), and its value is how much it
asks of a user: the least of alternatives, the most of joint terms. ``score`` is the highest value found.
An expression reaches, at any length, to the first token that cannot follow, the next tag or the end of its line; a malformed one to the latter two.

Cases: a null or empty text has no words, labels '' and score 0; a malformed expression gives the labels of its known
identifiers and no value; repeated rows are judged one by one; input columns named like the results are replaced.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from veloframe.llm.common import byte_column, extended

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit",
    "apache license": "apache", "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "eclipse public license": "epl", "isc license": "isc",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0", "gnu general public license version 3": "gpl-3.0",
    "creative commons": "cc", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "public domain": "public-domain", "proprietary and confidential": "proprietary",
}
TAG = "spdx license identifier"
#: What a licence family asks of a user, 0 (nothing) to 1 (no use).
ASKS = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "apache": 0.2,
    "cc-by": 0.2, "cc": 0.3, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8,
    "cc-by-nd": 0.8, "cc-by-nc": 0.9, "reserved": 1.0, "proprietary": 1.0,
}
_TAGGED = re.compile(r"spdx-license-identifier\s*:[ \t]*")
_LINE = re.compile(r"[^\r\n]*")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
_RANK = {"or": 1, "and": 2, "with": 3}
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def asks(label: str) -> float | None:
    """The value of a licence identifier, by its longest known family."""
    known = [f for f in ASKS if label == f or label.startswith(f + "-")]
    return ASKS[max(known, key=len)] if known else None


def parsed(expression: str) -> tuple[list[str] | None, int]:
    """Shunting yard, and where the expression ends: before the first token that cannot follow. A malformed one gives None and all its length."""
    out, stack, operand, end = [], [], False, 0
    for m in _TOKEN.finditer(expression):
        t = m[0]
        if t == "(":
            if operand:
                break
            stack.append(t)
        elif t == ")":
            if not operand:
                return None, len(expression)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif t in _RANK:
            if not operand:
                return None, len(expression)
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = False
        else:
            if operand:
                break
            out.append(t)
            operand = True
        end = m.end()
    if not operand or "(" in stack:
        return None, len(expression)
    return out + stack[::-1], end


def postfix(expression: str) -> list[str] | None:
    """Postfix order; None if the expression is malformed."""
    return parsed(expression)[0]


def tagged_lines(text: str) -> list[str]:
    """What stands behind each tag, to the next tag or the end of the line."""
    tags = list(_TAGGED.finditer(text))
    ends = [m.start() for m in tags[1:]] + [len(text)]
    lines = [_LINE.match(text, m.end(), end)[0] for m, end in zip(tags, ends, strict=True)]
    return [x for x in lines if x]


def evaluated(order: list[str]) -> float | None:
    """``or`` takes the least of its sides, ``and`` the most, ``with`` (an exception) eases its licence by a half; unknown sides don't count."""
    stack: list[float | None] = []
    for t in order:
        if t not in _RANK:
            stack.append(asks(t))
            continue
        b, a = stack.pop(), stack.pop()
        if t == "with":
            stack.append(None if a is None else a / 2)
        else:
            both = [x for x in (a, b) if x is not None]
            stack.append((min if t == "or" else max)(both) if both else None)
    return stack[0]


def _finder() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, TAG: ""}:
        out.add_word(f" {phrase} ", phrase)
    out.make_automaton()
    return out


def find_licences(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with n_words, matches (phrase, label, base, first word, ascending), expressions (as written,
    A-Z lower-cased), labels (distinct, sorted) and score."""
    names = ("phrase", "label", "base", "word")
    kind = pa.list_(pa.struct([("phrase", pa.string()), ("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64())]))

    def compute(batch: pa.RecordBatch, kept: list = []) -> list[pa.Array]:  # noqa: B006  one automaton for each process
        if not kept:
            kept.append(_finder())
        data, offsets = byte_column(batch.column("text"))
        counts, matches, expressions, labels, scores = [], [], [], [], []
        for i in range(batch.num_rows):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            words = raw.translate(_TO_WORDS).split()
            line = f" {b' '.join(words).decode('latin-1')} "
            counts.append(len(words))
            own, tagged, seen, at = [], False, 0, 0
            for end, phrase in kept[0].iter(line):
                start = end - len(phrase) - 1
                if start >= at:
                    seen += line.count(" ", at, start)
                    at = start
                word = seen if start == at else seen - line.count(" ", start, at)
                if phrase == TAG:
                    tagged = True
                else:
                    own.append((phrase, BASE.get(phrase) or NOTICES[phrase], phrase in BASE, word))
            found = {m[1] for m in own}
            values = [v for v in map(asks, found) if v is not None]
            texts = []
            for x in tagged_lines(raw.decode("utf-8", "replace").translate(_ASCII_LOWER)) if tagged else ():
                order, stop = parsed(x)
                texts.append(x[:stop].strip())
                if order:
                    found |= {t for t in order if t not in _RANK and asks(t) is not None}
                    values += [v for v in [evaluated(order)] if v is not None]
                else:
                    found |= {t[0] for t in _TOKEN.finditer(x) if asks(t[0]) is not None}
            matches.append([dict(zip(names, m, strict=True)) for m in sorted(own, key=lambda m: (m[3], m[0]))])
            expressions.append(texts)
            labels.append(sorted(found))
            scores.append(max(values, default=0.0))
        return [pa.array(counts, pa.int64()), pa.array(matches, kind), pa.array(expressions, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string())), pa.array(np.array(scores, float))]

    return extended(docs, "n_words long, matches array<struct<phrase:string,label:string,base:boolean,word:long>>, expressions array<string>, labels array<string>, score double", compute)


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def digests(found: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    base = F.filter("matches", lambda m: m["base"])
    return found.withColumn("_b", base).select(
        "doc_id", "n_words", F.size("_b").cast("long").alias("n_base"),
        F.array_min(F.transform("_b", lambda m: m["word"])).alias("first_word"), F.array_max(F.transform("_b", lambda m: m["word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_b", lambda m: m["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_licences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


