"""Operators 1 to 3: exact round trips, and gapless plans."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from veloframe.llm import packing, rans, ring, token_files
from veloframe.llm.tokens import Encoder, default_vocabulary


@pytest.fixture(scope="module")
def library():
    return Encoder(default_vocabulary())


def ids_of(library, text):
    return np.frombuffer(library.whole([text or ""])[0], library.kind)


def test_pieces_are_the_librarys(library):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "b's", "'", "12", "é", "!!", "\x1c", "中", " ", "<|endoftext|>", "x,", "x."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    assert library.encode(texts) == library.whole(texts)
    assert library.encode([None, ""]) == [b"", b""]


def test_letters_go_to_the_model_without_the_splitter(library, monkeypatch):
    """Each part of letters, marks and line ends is what the library makes of it, and the library's splitter gets none of them."""
    rng = random.Random(5)
    letters = ["ab", "Qu", "é", "ß", "中", "ж", "ñ", "\u01c5", "\U00010400", "s", "re"]
    word = lambda: "".join(rng.choices(letters, k=rng.randint(1, 5)))
    part = lambda: "\n".join(word() + "".join(rng.choices(",.;:!?)]#&", k=rng.choice((0, 0, 1, 3)))) for _ in range(rng.choice((1, 1, 1, 2, 3))))
    texts = [" ".join(part() for _ in range(rng.randint(1, 40))) for _ in range(300)] + [None, "", "it's", "a\n\nb c", "a 1\nb", "a \nb", "a\n b", "x\ny's z's"]
    fresh, given = Encoder(default_vocabulary()), []
    want = library.whole([x or "" for x in texts])
    asked = Encoder.parts
    monkeypatch.setattr(Encoder, "parts", lambda self, new: given.extend(new) or asked(self, new))
    assert fresh.encode(texts) == want and fresh.encode(texts[::-1]) == want[::-1]
    assert set(given) <= {"z's", "1\nb", "\nb"}
    column = pa.array(texts).slice(3, 302)
    ids, at = fresh.encode_column(column, 7)
    assert [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)] == [x + np.array([7], fresh.kind).tobytes() for x in want[3:305]]
    assert [x.tolist() for x in fresh.encode_column(pa.array([], pa.string()), 7)] == [[], [0]]
    assert fresh.encode_column(pa.array([None, ""], pa.string()), 7)[0].tolist() == [7, 7]


def test_coder_round_trip():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 200_000), 50_000)
    table = rans.Table(np.bincount(ids, minlength=50_257))
    assert int(table.f.sum()) == 1 << rans.SCALE and (table.f[np.unique(ids)] > 0).all()
    blocks = [ids[:1], ids[:31], ids[:32], ids[:33], ids[:8192], ids[:8193], ids[5:40_000], ids[:rans.BLOCK]]
    raw = rans.encode(blocks, table)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, rans.decode(raw, table), strict=True))
    with pytest.raises(ValueError, match="checksum"):
        rans.decode([raw[6][:-4] + bytes(4)], table)
    one = rans.Table(np.array([0, 0, 5]))
    assert rans.decode(rans.encode([np.full(100, 2)], one), one)[0].tolist() == [2] * 100


def test_joined_checksums():
    a, b, c = b"abc", b"", bytes(range(256)) * 9
    assert rans.crc_joined([(zlib.crc32(x), len(x)) for x in (a, b, c)]) == zlib.crc32(a + b + c)


def test_checksums_are_joined_without_new_matrices(monkeypatch):
    rans.crc_joined([(1, 1 << 20), (1, 1 << 20)])
    calls, times = [], rans._times
    monkeypatch.setattr(rans, "_times", lambda m, v: calls.append(v) or times(m, v))
    raw = bytes(range(250)) * 4000
    assert rans.crc_joined([(zlib.crc32(raw), len(raw)), (zlib.crc32(raw[:999]), 999), (zlib.crc32(raw[5:]), len(raw) - 5)]) == zlib.crc32(raw + raw[:999] + raw[5:])
    assert len(calls) <= 2 * 24


def test_token_files(spark, repeated, empty, library):
    files = token_files.write_tokens(repeated)
    got = token_files.digests(token_files.read_tokens(spark, files)).orderBy("start").collect()
    order = sorted(((r.doc_id, r.text) for r in repeated.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in order]
    at = 0
    by_id = defaultdict(Counter)
    for r in got:
        assert r.start == at
        at += r.n_tokens
        by_id[r.doc_id][r.n_tokens, r.ids_crc32] += 1
    want = defaultdict(Counter)
    for d, text in order:
        ids = np.append(ids_of(library, text), 2).astype("<u4")
        want[d][len(ids), zlib.crc32(ids.tobytes())] += 1
    assert by_id == want
    assert token_files.read_tokens(spark, token_files.write_tokens(empty)).count() == 0


def test_packing(repeated, empty, library):
    sequences = packing.pack_documents(repeated, capacity=256, group_pieces=64).collect()
    texts = defaultdict(list)
    for r in repeated.collect():
        texts[r.doc_id].append(np.append(ids_of(library, r.text), 1))
    pieces = defaultdict(list)
    for s in sequences:
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == s.n_tokens == sum(p.length for p in s.pieces) <= 256
        at = 0
        for p in s.pieces:
            assert p.offset == at
            pieces[p.doc_id].append((p.start, tuple(ids[at : at + p.length])))
            at += p.length
    assert {d: sorted(x) for d, x in pieces.items()} == {d: sorted((k, tuple(x[k : k + 256])) for x in own for k in range(0, len(x), 256)) for d, own in texts.items()}
    assert len({s.sequence_id for s in sequences}) == len(sequences)
    assert sum(256 - s.n_tokens for s in sequences) < 0.1 * 256 * len(sequences)
    assert packing.pack_documents(empty).count() == 0
    given = packing.pack_documents(repeated, capacity=256, group_pieces=64)
    made = Counter(tuple(r) for r in packing.digests(given).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    want = Counter((d, k, len(x[k : k + 256]), zlib.crc32(x[k : k + 256].astype("<u4").tobytes()), len(x)) for d, own in texts.items() for x in own for k in range(0, len(x), 256))
    assert made == want
    places = {(r.sequence_id, r.offset) for r in packing.digests(given).collect()}
    assert len(places) == sum(want.values())


def test_groups_do_not_depend_on_the_order(spark):
    """A task that gets its rows in another order deals the same pieces to the same groups, copies too."""
    rows = [(i % 40 if i % 3 else None, f"text {i % 50} " * (i % 9)) for i in range(400)]
    deal = lambda x: Counter((r.group, r.doc_id, r.start, r.ids) for r in spark.createDataFrame(x, "doc_id long, text string").coalesce(1).mapInArrow(lambda b: packing.cut(b, default_vocabulary(), 1, 16, 7, 11), "group long, doc_id long, start long, length long, doc_tokens long, ids binary").collect())
    one = deal(rows)
    assert one == deal(rows[::-1]) and len({g for g, *_ in one}) == 7


def test_first_fit_decreasing():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 200):
        lengths = rng.integers(1, 101, n)
        free, want = [], np.zeros(n, int)
        for i in np.argsort(-lengths, kind="stable"):
            k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
            if k == len(free):
                free.append(100)
            free[k] -= lengths[i]
            want[i] = k
        assert packing.first_fit_decreasing(lengths, 100).tolist() == want.tolist()


def test_ring(spark, repeated, empty, tmp_path):
    got = ring.shard_documents(repeated, 5, 16).collect()
    counts, slots = Counter(r.shard for r in got), defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert max(counts.values()) - min(counts.values()) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, 8 + len((r.text or "").encode()), zlib.crc32((r.text or "").encode())) for r in repeated.collect())
    assert ring.shard_documents(empty).count() == 0
    ring.write_shards(repeated, str(tmp_path / "s"), 5, 16)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == repeated.count() and Counter(r.shard for r in back.collect()) == counts


def test_one_hot_text_is_dealt_out(spark):
    hot = spark.range(900).selectExpr("id doc_id", "if(id % 3 = 0, cast(id as string), 'the same') text").repartition(4)
    assert sorted(Counter(r.shard for r in ring.shard_documents(hot, 7, 8).collect()).values()) == [128, 128, 128, 129, 129, 129, 129]


def test_few_rows_move_when_a_shard_comes():
    """Most rows stay where they are."""
    rng = np.random.default_rng(2)
    at = np.sort(rng.integers(-(2**63), 2**63 - 1, 20_000))
    places = []
    for shards in (10, 11):
        points, owner = ring.points(shards, 128)
        owner = np.append(owner, owner[0])
        loads = np.bincount(np.searchsorted(points, at, "left"), minlength=len(owner))
        plan = np.array(ring.deal(loads, owner, shards))
        places.append(plan[np.searchsorted(plan[:, 0], np.arange(len(at)), "right") - 1, 2])
    assert (places[0] != places[1]).mean() < 0.35
