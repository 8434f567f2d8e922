"""Operators 4 to 9 against brute force on the small table, and on an empty one."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veloframe.llm import decontamination, jaccard, languages, licences, pii, substrings

PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def table(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_substrings(repeated, empty):
    given = [(r.doc_id, (r.text or "").encode().split()) for r in repeated.collect()]
    first = {}
    for d, w in given:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, 1 << 62), (1 << 62) - 1 if d is None else d)
    want = Counter()
    for d, w in given:
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < ((1 << 62) - 1 if d is None else d):
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[d, len(w), len(gone), sha(kept), kept.decode()] += 1
    assert sum(n * c for (_, _, n, _, _), c in want.items()) > 300
    assert table(substrings.remove_repeats(repeated), "doc_id", "n_words", "n_removed", "kept_sha256", "kept") == want
    assert substrings.remove_repeats(empty).count() == 0


def test_first_documents():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sequences = [rng.integers(0, 3, rng.integers(3, 12)).astype("<u4") for _ in range(8)]
        ids = rng.integers(0, 5, 8)
        first = {}
        for s, d in zip(sequences, ids, strict=True):
            for k in range(len(s) - 2):
                first[tuple(s[k : k + 3])] = min(first.get(tuple(s[k : k + 3]), 99), int(d))
        want = [first[tuple(s[k : k + 3])] for s in sequences for k in range(len(s) - 2)]
        assert substrings.first_documents(sequences, ids, 3).tolist() == want


def brute_benchmark(texts, items, window):
    windows = defaultdict(set)
    for i, x in items:
        w = PLAIN.findall(lower(x))
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else ():
            windows[tuple(w[k : k + n])].add(i)
    sizes = {len(k) for k in windows}
    out = []
    for x in texts:
        w, hit, found = PLAIN.findall(lower(x)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("short", [0, 1, 4])
@pytest.mark.parametrize("shard_words", [1_000_000, 40])
def test_benchmark(spark, docs, empty, short, shard_words):
    rows = docs.collect()
    texts = [r.text for r in rows]
    long = [t for t in texts if t and len(t.split()) > 30][:4]
    items = [(str(i), " ".join(t.split()[5:25]).upper()) for i, t in enumerate(long)] + [("e", ""), ("n", None), ("dup", " ".join(long[0].split()[5:25]))]
    if short:
        items.append(("s", " ".join(long[1].split()[30 : 30 + short])))
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.digests(decontamination.find_benchmark(docs, benchmark, shard_words=shard_words))
    want = Counter((r.doc_id, n, hit, len(found), sha(",".join(found)), hit > 0) for r, (n, hit, found) in zip(rows, brute_benchmark(texts, [(i or "", x) for i, x in items], 10), strict=True))
    assert table(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    if shard_words == 40 and short == 4:
        clean = decontamination.decontaminate(docs, benchmark, max_coverage=0.9)
        assert clean.columns == docs.columns
        assert decontamination.digests(decontamination.find_benchmark(clean.filter("doc_id is not null"), benchmark)).filter("contaminated").count() == 0
        assert decontamination.find_benchmark(docs, benchmark.limit(0)).filter("size(hit_spans) > 0").count() == 0
        assert decontamination.find_benchmark(empty, benchmark).count() == 0


def brute_pii(x):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_personal_data_patterns():
    rng = random.Random(2)
    parts = ["a", "@", "b.c", "1", "12", "000", ".", "+", " ", "-", "(", ")", "4111 1111 1111 1111", "1.2.3.4", "x@y.z", "é", "@@", "+1 (386) 555-3733", "256.1.1.1"]
    for _ in range(8000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(x) == brute_pii(x), x


def test_personal_data(docs, empty):
    got = pii.digests(pii.find_personal_data(docs)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        base = brute_pii(texts[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == sha(joined) and set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    one = next(t for t in clean.values() if t and t.startswith("Mail"))
    assert one == "Mail [EMAIL] or [PHONE], card [CARD], host [IP] and 300.1.1.1"
    assert pii.find_personal_data(empty).count() == 0


def planted(n, seed, twin):
    """Texts with a sure mention each, far from it a number that means nothing and, with ``twin``, the mention once more in an odd format."""
    rng = random.Random(seed)
    words = "the river and old house stand by green field where nobody went".split()
    filler = lambda k: " ".join(rng.choice(words) for _ in range(k))
    out = []
    for i in range(n):
        a, b = rng.randint(200, 999), rng.randint(1000, 9999)
        sure, other = [
            (f"+1 ({a}) 555-{b}", f"1-{a}-555-{b}"), (f"joe.{a}@mail{b}.example.com", f"joe.{a} (at) mail{b}.example.com"),
            (f"10.{a % 256}.{b % 256}.7", f"10-{a % 256}-{b % 256}-7"), ("4111 1111 1111 1111", "4111.1111.1111.1111"),
        ][i % 4]
        noise = f"order {rng.randint(10**15, 10**16 - 1)} of {rng.randint(1990, 2030)}"
        out.append((i, f"{filler(30)} {sure} {filler(25)} {noise} {filler(25)} {other if twin else ''} {filler(10)}", sure, other))
    return out


def test_field_adds_repeated_mentions(spark):
    """As learned from texts that only the patterns label: odd repetitions are added, and nothing else."""
    train = [(i, x) for i, x, _, _ in planted(400, 1, False)]
    weights = pii.learned(spark.createDataFrame(train, "doc_id long, text string"))
    test = planted(200, 2, True)
    rows = pii.find_personal_data(spark.createDataFrame([(i, x) for i, x, _, _ in test], "doc_id long, text string"), weights).collect()
    got = {r.doc_id: r for r in rows}
    found = wrong = 0
    for i, x, _, other in test:
        base = {(s.kind, s.start, s.end) for s in got[i].base_spans}
        more = [s for s in got[i].all_spans if (s.kind, s.start, s.end) not in base]
        hit = [s for s in more if x[s.start : s.end] == other and s.kind == got[i].base_spans[0].kind]
        found += len(hit)
        wrong += len(more) - len(hit)
    assert found >= 0.9 * len(test) and wrong <= 0.01 * len(test), (found, wrong)


def test_many_repetitions_agree():
    weights = pii.fit([pii.example(x) for _, x, _, _ in planted(200, 3, False)])
    x = "call +1 (999) 555-2222 now" + ", and then once more one has to call 1-999-555-2222 now" * 50
    n = pii.nodes(x, pii.base_spans(x))
    p = pii.marginals([n], weights)[0]
    assert len(p) == 51 and (p.argmax(axis=1) == 3).all() and p[:, 3].min() >= pii.SURE


def test_messages_are_exact_on_trees():
    """Marginals against the sum over all labellings."""
    import itertools

    rng = np.random.default_rng(0)
    for _ in range(10):
        n, k = 5, pii.NONE + 1
        features, held = rng.normal(size=(n, pii.N_FEATURES)), np.full(n, -1)
        held[0] = 3
        edges = [(int(rng.integers(0, i)), i) for i in range(1, n)]
        graph = pii.Nodes([(i, i + 1) for i in range(n)], features, held, edges[::2], edges[1::2])
        pair = rng.normal(size=(2, k, k))
        weights = pii.Weights(0.3 * rng.normal(size=(pii.N_FEATURES, k)), *(pair + pair.transpose(0, 2, 1)) / 2)
        want, unary = np.zeros((n, k)), features @ weights.unary
        unary[0, 3] += pii.HELD
        for y in itertools.product(range(k), repeat=n):
            score = sum(unary[i, y[i]] for i in range(n)) + sum(weights.chain[y[a], y[b]] for a, b in graph.chain) + sum(weights.skip[y[a], y[b]] for a, b in graph.skip)
            want[range(n), y] += np.exp(score - 30)
        assert pii.marginals([graph], weights)[0] == pytest.approx(want / want.sum(axis=1, keepdims=True), abs=2e-3)


def test_nodes_have_no_reach():
    """Long stretches round an '@', and more base spans over one node than a few."""
    x = "a" * 2000 + "@" + "b" * 2000 + ".com"
    assert pii.nodes(x, pii.base_spans(x)).spans == [(0, len(x))]
    x = ",".join(f"a{i}@b.cc" for i in range(9)) + " 12345"
    assert pii.nodes(x, pii.base_spans(x)).held.tolist() == [0, -1]


def test_licences(docs, empty):
    got = {r.doc_id: r for r in licences.digests(licences.find_licences(docs)).collect()}
    for r in docs.collect():
        w, starts, labels = PLAIN.findall(lower(r.text)), [], set()
        for phrase, label in licences.BASE.items():
            q = phrase.encode().split()
            for k in range(len(w) - len(q) + 1):
                if w[k : k + len(q)] == q:
                    starts.append(k)
                    labels.add(label)
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert 0 <= g.score <= 1 and labels <= set(g.labels.split(","))
    assert any(g.labels == "apache-2.0,gpl,gpl-2.0,mit" for g in got.values())
    assert licences.find_licences(empty).count() == 0


def test_overlapping_notices(spark):
    docs = spark.createDataFrame([(1, "cc by cc BY, general public\nlicense general public license cc by"), (2, "xcc by"), (3, "all rights reserved " * 3)], "doc_id long, text string")
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word) for r in licences.digests(licences.find_licences(docs)).collect()}
    assert got == {1: (5, 0, 10), 2: (0, None, None), 3: (3, 0, 6)}


def test_expressions():
    value = lambda x: licences.evaluated(licences.postfix(x))
    assert licences.postfix("mit or gpl-2.0 and bsd") == ["mit", "gpl-2.0", "bsd", "and", "or"]
    assert licences.postfix("(mit or gpl-2.0) and bsd") == ["mit", "gpl-2.0", "or", "bsd", "and"]
    assert value("mit or gpl-2.0") == 0.1 and value("mit and gpl-2.0-only") == 0.7 and value("gpl-2.0 with classpath-exception-2.0") == 0.35
    assert licences.postfix("(mit or") is None and licences.postfix("and mit") is None and value("nothing-known") is None


def test_long_expressions(spark):
    long = "(" + " AND ".join(f"LicenseRef-vendored-component-{i}" for i in range(40)) + " AND GPL-2.0-only) OR Proprietary"
    assert len(long) > 1000
    tag = "SPDX-License-Identifier: "
    docs = spark.createDataFrame([(1, f"/* {tag}{long}\nISC"), (2, f"{tag}MIT */ {'x ' * 300}{tag}GPL-3.0 {tag}"), (3, f"{tag}MIT {tag}BSD"), (4, f"{tag}(MIT OR {'x OR ' * 200}AGPL-3.0")], "doc_id long, text string")
    got = {r.doc_id: (r.expressions, r.labels, r.score) for r in licences.find_licences(docs).collect()}
    assert got[1] == ([long.lower()], ["gpl-2.0-only", "proprietary"], 0.7)
    assert got[2] == (["mit", "gpl-3.0"], ["gpl-3.0", "mit"], 0.7) and got[3] == (["mit", "bsd"], ["bsd", "mit"], 0.1)
    assert got[4][1:] == (["agpl-3.0", "mit"], 0.0)


def brute_similar(rows, percent=75):
    sets = []
    for _, text in rows:
        w = lower(text).split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), 1 << 62), d)
    return Counter((d, len(s), d if not s else least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def test_similar(repeated, empty):
    rows = [(r.doc_id, r.text) for r in repeated.collect()]
    want = brute_similar(rows)
    assert table(jaccard.similar_documents(repeated), "doc_id", "n_shingles", "component_id") == want
    kept = jaccard.drop_similar(repeated)
    assert kept.columns == repeated.columns
    left = Counter(r.doc_id for r in kept.collect())
    assert {d for d in left if d is not None} == {d for d, _, c in want if d is not None and d == c}
    empties = {d for d, n, _ in want if not n}
    assert all(n == 1 for d, n in left.items() if d not in empties) and all(left[d] == sum(n for (k, m, _), n in want.items() if k == d and not m) for d in empties)
    assert jaccard.similar_documents(empty).count() == 0 and jaccard.drop_similar(empty).count() == 0


def test_rows_go_one_by_one(spark):
    """A doc_id that several rows have does not take a clean row with it, nor keep a copy."""
    a, b = "a long way to the house by the river", "nothing that any other row has at all"
    rows = [(3, a, "x"), (7, a, "y"), (7, b, "z"), (None, a, "n"), (3, a, "w"), (9, None, "e"), (9, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = Counter((r.doc_id, r.text) for r in jaccard.drop_similar(docs).collect())
    assert got == {(3, a): 1, (7, b): 1, (9, None): 2}


@pytest.mark.parametrize("size", [10**7, 10**9, 2**40])
def test_any_size_finds_all(spark, repeated, monkeypatch, size):
    """Many ranges and blocks, dealt in one step and in two."""
    from veloframe.llm import exchange

    monkeypatch.setattr(exchange, "text_bytes", lambda docs: size)
    if size == 10**9:
        monkeypatch.setattr(exchange, "FAN", 8)
    rows = [(r.doc_id, r.text) for r in repeated.collect()]
    found = jaccard.shared_shingles(repeated, 5, 75)
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for _, t in rows for w in [lower(t).split()]]
    every = Counter(x for s in sets for x in s)
    want = Counter((d, len(s), sum(every[x] > 1 for x in s) if s and sum(every[x] > 1 for x in s) >= -(-75 * len(s) // 100) else None) for (d, _), s in zip(rows, sets, strict=True))
    assert Counter((r.doc_id, r.n, None if r.shared is None else len(r.shared) // 8) for r in found.collect()) == want


def test_packed_rows():
    from veloframe.llm import exchange

    rng = np.random.default_rng(3)
    for top, n in ((2**32 - 1, 3000), (40, 3000), (2**20, 1), (3, 0)):
        given = [rng.integers(0, top, n, dtype=np.uint32) for _ in range(3)]
        given = [np.append(x, x[: n // 2]) for x in given]
        counts = Counter(zip(*(x.tolist() for x in given), strict=True))
        want = sorted(x for x, c in counts.items() for _ in range(min(c, 2)))
        made = exchange.ordered(*given)
        assert list(zip(*(x.tolist() for x in made), strict=True)) == want
        rows = exchange.packed_rows(*made, 4)
        assert rows.column("place").to_pylist() == sorted({x[0] >> 4 for x in want})
        assert list(zip(*(x.tolist() for x in exchange.unpacked(rows.column("raw").to_pylist())), strict=True)) == want


@pytest.mark.parametrize("block", [None, 4])
def test_all_links_are_found(spark, repeated, monkeypatch, block):
    """Every class asks: links between two neighbours of a hub count too, whatever the blocks."""
    if block:
        for name in ("BLOCK", "SMALL"):
            monkeypatch.setattr(jaccard, name, block)
    rows = [(r.doc_id, lower(r.text).split()) for r in repeated.collect()]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for _, w in rows]
    similar = lambda a, b: bool(a & b) and 100 * len(a & b) >= 75 * len(a | b)
    want = Counter((d, sum(similar(a, b) for j, b in enumerate(sets) if j != i)) for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True)))
    assert max(n for _, n in want) > 10
    assert table(jaccard.similar_documents(repeated), "doc_id", "n_links") == want


def test_cluster_of_two_asks_the_lists():
    import pyarrow as pa

    sets = [list(range(20)), list(range(1, 21)), list(range(2, 22))]
    table = {"class": [5, 6, 7], "n": [20, 20, 20], "rows": [1, 2, 4], "half": [0, 0, 0], "p": [0, 0, 0], "q": [0, 0, 0], "across": [False] * 3, "h": sets}
    got = jaccard._links_in_block(pa.table(table), 75)
    lone = {**table, "q": [1, 1, 1]}
    assert jaccard._links_in_block(pa.table(lone), 75).num_rows == 0  # the other block is empty
    assert {(r["a"], r["n"]) for r in got.to_pylist() if r["b"] is None} == {(5, 6), (6, 5), (7, 3)}
    assert len([r for r in got.to_pylist() if r["b"] is not None]) == 2
    halves = jaccard._links_in_block(pa.table({**table, "across": [True] * 3, "half": [0, 1, 1]}), 75)
    assert {(r["a"], r["n"]) for r in halves.to_pylist() if r["b"] is None} == {(5, 6), (6, 1), (7, 1)}


@pytest.mark.parametrize("shared", [0.93, 0.5])
def test_divide_skip(shared):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 10**6, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) < shared], rng.integers(0, 10**6, rng.integers(0, 8))])) for _ in range(80)] + [np.unique(rng.integers(0, 10**6, k)) for k in range(1, 5)]
    sizes = np.array([len(s) for s in sets])
    lists = jaccard.Lists(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes, 75)
    n = 0
    for s in sets:
        want = [j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))]
        assert sorted(lists.search(s, len(s)).tolist()) == want
        n += len(want)
    assert len(sets) <= n < len(sets) ** 2
    for least in (1, 3, 20):
        at = rng.permutation(len(lists.keys))[:40]
        counts = Counter(m for i in at for m in lists.own[lists.begin[i] : lists.end[i]].tolist())
        members, found = lists._merged(at, least)
        assert dict(zip(members, found, strict=True)) == {m: c for m, c in counts.items() if c >= least}


def test_languages(spark, empty):
    rng = random.Random(9)
    kinds = {"aa": "aaabbcd ee", "bb": "xyyzzzw qq", "cc": "mnoppprs tt"}
    rows = [(i, "".join(rng.choice(kinds[k]) for _ in range(rng.randint(5, 300))), k) for i in range(300) for k in [rng.choice("abc") * 2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.learned(docs.filter(~languages.held_out()))
    held = languages.identify(docs.filter(languages.held_out()), model).collect()
    assert len(held) > 60 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and sum(r.lang_rejected for r in held) <= 2
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "жжж ддд ллл " * 30), (5, "aaa")], "doc_id long, text string")
    got = {r.doc_id: r for r in languages.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [got[i].score for i in (1, 2, 3)] == [0.0] * 3
    assert all(got[i].lang_rejected for i in (1, 2, 3, 4)) and got[5].lang_pred == "aa" and 0 <= got[4].score <= got[5].score <= 1
    nothing = languages.learned(empty)
    assert [r.lang_pred for r in languages.identify(odd, nothing).collect()] == ["und"] * 5 and languages.identify(empty, model).count() == 0


def test_kneser_ney_sums_to_one():
    packed, _ = languages.grams(["abcab abd", "bca"])
    keys, counts = np.unique(packed, return_counts=True)
    model = languages.Model(keys, counts)
    context = keys[3] >> np.uint64(16) << np.uint64(16)
    letters = np.arange(1, 1 << 16, dtype=np.uint64)
    p = model.probability(context | letters)
    seen = np.unique(keys & np.uint64(0xFFFF))
    # Unseen characters share a thousand places.
    assert p[seen.astype(int) - 1].sum() + 1000 * p[np.uint64(9999) - 1] == pytest.approx(1, abs=1e-9)


def test_language_models_in_parts_keep_all_counts(spark):
    """A language of few documents beside a large one, and more 4-grams than one part takes."""
    rng = random.Random(8)
    texts = [("aa", "".join(rng.choice("abcdefg ") for _ in range(400))) for _ in range(60)] + [("zz", "".join(rng.choice("vwxyz ") for _ in range(60))) for _ in range(2)]
    docs = spark.createDataFrame([(i, x, lang) for i, (lang, x) in enumerate(texts)], "doc_id long, text string, lang string")
    model = languages.learned(docs, max_grams=200)
    asked = [x for _, x in texts] + ["vwx abc 中文", "zzzz", ""]
    packed, counts = languages.grams(asked)
    row = np.repeat(np.arange(len(asked)), counts)
    for i, lang in enumerate(["aa", "zz"]):
        keys, n = np.unique(languages.grams([x for own, x in texts if own == lang])[0], return_counts=True)
        assert len(keys) > 40
        want = np.bincount(row, -np.log(languages.Model(keys, n).probability(packed)), len(asked)) / np.maximum(counts, 1)
        assert model.entropies(asked)[0][:, i] == pytest.approx(want, abs=1e-9)
    one = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(docs, languages.learned(docs)).collect()}
    assert {r.doc_id: (r.lang_pred, pytest.approx(r.score, abs=1e-9)) for r in languages.identify(docs, model).collect()} == one


def test_held_out_column(spark):
    import zlib

    got = spark.range(50).select(F.col("id").alias("doc_id")).select("doc_id", languages.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_quantiles_are_exact(spark):
    import numpy as np

    values = np.concatenate([np.random.default_rng(1).standard_cauchy(3000) ** 3, np.full(500, 0.25), [0.0, -0.0]])
    table = spark.createDataFrame([(float(x),) for x in values], "v double")
    for share in (0.0, 0.5, 0.99, 1.0):
        assert languages.exact_quantile(table, share, held=20) == pytest.approx(np.quantile(values, share), rel=1e-12)


def test_language_thresholds_come_from_all_documents(spark, sf):
    """Against the same figures over all training documents at once, more than any sample had."""
    import numpy as np

    own = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    docs = own.filter("lang is not null and text is not null").crossJoin(spark.range(15).withColumnRenamed("id", "k")).select("doc_id", F.concat(F.substring("text", 1, 40), F.lit(" "), F.substring("text", F.col("k").cast("int") * 7, F.lit(60))).alias("text"), "lang")
    rows = docs.collect()
    assert len(rows) > 2000
    model = languages.learned(docs)
    entropy, counts = model.entropies([r.text for r in rows])
    truth = np.array([model.names.index(r.lang) for r in rows])[counts > 0]
    entropy, counts = entropy[counts > 0], counts[counts > 0]
    right = entropy[np.arange(len(truth)), truth]
    mean = np.array([np.average(right[truth == i], weights=counts[truth == i]) for i in range(len(model.names))])
    assert model.mean == pytest.approx(mean, abs=1e-9)
    square = (right - mean[truth]) ** 2
    b = max(languages.FLOOR**2, np.median(square[counts >= np.median(counts)]))
    a = max(0.05, np.median((square - b).clip(0) * counts))
    off = (right - mean[truth]) / np.sqrt(a / counts + b)
    high = np.quantile(off, 0.99)
    assert model.spread == pytest.approx((a, b), rel=1e-6)
    assert model.reject_at == pytest.approx(max(3.0, high + (off[off >= high] - high).mean() * np.log(0.01 / 1e-6)), rel=1e-6)
