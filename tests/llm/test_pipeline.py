"""The pipeline's stages, one after the other, against brute force on a small table with every awkward case."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_texts import PLAIN, brute_pii, brute_similar, lower
from veloframe.llm.common import staged
from veloframe.llm.pii import KINDS
from veloframe.llm.tokens import Encoder, default_vocabulary

OWN = ["score", "n_words", "all_spans", "key", "own_columns", "lang_pred", "hit_spans"]


def text(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def table():
    rng = random.Random(21)
    letters = {"aa": "abcdeghi", "bb": "mnoprstuw"}
    rows = [[i, text(rng, letters[lang], rng.randint(40, 80)), lang if i % 17 else None] for i in range(180) for lang in [rng.choice(["aa", "bb"])]]
    item = " ".join(rows[7][1].split()[10:26])
    edited = rows[5][1].split()
    edited[20] = "hhh"
    rows += [
        [200, rows[3][1], "aa"], [201, " ".join(edited), "aa"], [202, f"{item.upper()} {text(rng, letters['aa'], 6)}", "aa"], [203, text(rng, "жзийклмнопр", 60), None], [204, None, "aa"], [205, "", "aa"],
        [206, "12 34 !!", "bb"], [207, f"{text(rng, letters['bb'], 30)} mort@snop.worst.prt nor +1 (386) 555-3733 {text(rng, letters['bb'], 20)}", "bb"], [208, f"{text(rng, letters['aa'], 50)}, {item}; {text(rng, letters['aa'], 9)}", "aa"],
        [9, rows[9][1], rows[9][2]], [None, text(rng, letters["aa"], 50), "aa"], [210, text(rng, letters["bb"], 9000), "bb"],
    ]
    return [tuple(r) for r in rows], [("q1", item), ("q2", None), ("q3", text(rng, letters["aa"], 12))]


def without_passages(x, items):
    """The text without the words of ten consecutive ones of an item, or None where it goes whole."""
    windows = {tuple(w[k : k + 10]) for _, i in items for w in [PLAIN.findall(lower(i))] for k in range(len(w) - 9)}
    raw = (x or "").encode()
    words = list(PLAIN.finditer(lower(x)))
    hit = [False] * len(words)
    for k in range(len(words) - 9):
        if tuple(m[0] for m in words[k : k + 10]) in windows:
            hit[k : k + 10] = [True] * 10
    if sum(hit) > 0.5 * len(words):
        return None
    out, at, k = b"", 0, 0
    while k < len(words):
        if hit[k]:
            end = k
            while end + 1 < len(words) and hit[end + 1]:
                end += 1
            out += raw[at : words[k].start()]
            at = words[end].end()
            k = end
        k += 1
    return (out + raw[at:]).decode()


def redacted(x):
    out, at = "", 0
    for kind, a, b in brute_pii(x):
        if a >= at:
            out += f"{x[at:a]}[{KINDS[kind].upper()}]"
        at = max(at, b)
    return out + x[at:]


def test_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    rows, items = table()
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in OWN})
    columns = docs.columns
    stages = dict(pipeline.STAGES)

    def step(name, given):
        out = staged(stages[name](spark, given, str(tmp_path)), name)
        if name != "packing":
            assert out.columns == columns
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in out.collect() for c in OWN)
        return out

    docs = step("language_id", docs)
    kept = [(d, x) for d, x, _ in rows if d not in (203, 204, 205, 206)]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(kept)
    right = {d: lang for d, _, lang in rows if lang}
    assert all(r.lang == right.get(r.doc_id, r.lang) and r.lang in ("aa", "bb") for r in docs.collect())

    docs = step("near_duplicates", docs)
    stay = {d for d, _, c in brute_similar(kept) if d == c}
    assert {200, 201} & stay == set() and {3, 5, 9, 207} <= stay
    kept = list({(d, x) for d, x in kept if d in stay or d is None})
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(kept)

    docs = step("decontamination", docs)
    clean = [(d, y) for d, x in kept if (y := without_passages(x, items)) is not None]
    assert {d for d, _ in kept} - {d for d, _ in clean} == {202} and dict(clean)[208] != dict(kept)[208] and dict(clean)[7] != dict(kept)[7]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(clean)

    docs = step("personal_data", docs)
    clean = [(d, redacted(x)) for d, x in clean]
    assert "[EMAIL] nor [PHONE]" in dict(clean)[207]
    assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(clean)

    library = Encoder(default_vocabulary())
    pieces = defaultdict(list)
    for s in step("packing", docs).collect():
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == s.n_tokens <= 2048 and s.doc_ids == [p.doc_id for p in s.pieces]
        for p in s.pieces:
            pieces[p.doc_id].append((p.start, zlib.crc32(ids[p.offset : p.offset + p.length].tobytes()), p.length))
    want = {}
    for d, x in clean:
        ids = np.append(np.frombuffer(library.whole([x])[0], library.kind), 1).astype("<u4")
        want[d] = [(k, zlib.crc32(ids[k : k + 2048].tobytes()), len(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    assert {d: sorted(x) for d, x in pieces.items()} == want and len(want[210]) > 1


def test_empty_table(spark, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == 0
