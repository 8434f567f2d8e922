"""Static range asymmetric numeral system over interleaved lanes, vectorised across blocks.

One frequency table serves all blocks. A block holds ``LANES`` interleaved coders of 64-bit state that
emit 32-bit words; step t codes symbols t*LANES .. t*LANES+LANES-1. Every ``EVERY`` steps the block keeps a
checkpoint (all lane states and the place in the words), so that each part of it can be decoded alone.

Payload of a block, little-endian: magic ``VRN1``, symbols u32, steps u32, lanes u16, scale bits u16, checkpoints
u32, words u32, crc32 of the ids as u32 values; then per checkpoint crc32 of its ids, then word offsets u32,
then states u64 (checkpoint by lane), then the words u32.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES, EVERY, SCALE = 32, 256, 20
BLOCK = 32_768
LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIHHIII")


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2**SCALE; whatever occurs keeps at least 1."""
    total, seen = int(counts.sum()), np.flatnonzero(counts)
    if len(seen) > 1 << (SCALE - 1):
        raise ValueError(f"{len(seen)} distinct ids are too many for a scale of 2**{SCALE}")
    out = np.zeros(len(counts), np.int64)
    if total == 0:
        return out
    out[seen] = np.maximum(1, (counts[seen].astype(np.float64) * (1 << SCALE) / total).astype(np.int64))
    over = int(out.sum()) - (1 << SCALE)
    for i in seen[np.argsort(-out[seen], kind="stable")]:
        if over <= 0:
            break
        take = min(over, int(out[i]) // 2)
        out[i] -= take
        over -= take
    if over < 0:
        out[seen[np.argmax(out[seen])]] -= over
    return out


class Table:
    """Frequencies, cumulative frequencies and, for decoding, the symbol of each slot."""

    def __init__(self, counts: np.ndarray):
        self.f = quantised(counts).astype(np.uint64)
        self.c = np.concatenate([[0], np.cumsum(self.f)[:-1]]).astype(np.uint64)
        self.pad = int(np.argmax(self.f))
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.f), dtype=np.uint32), self.f.astype(np.int64))
        return self._slots


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """A payload for each block of ids, none empty."""
    n = len(blocks)
    steps = -(-max(map(len, blocks)) // LANES)
    ids = np.full((n, steps * LANES), table.pad, np.int64)
    for i, x in enumerate(blocks):
        ids[i, : len(x)] = x
    own_steps = np.array([-(-len(x) // LANES) for x in blocks])
    lane = ids.reshape(n, steps, LANES)
    state = np.full((n, LANES), LOW, np.uint64)
    words, out = np.zeros((steps, n, LANES), np.uint32), np.zeros((steps, n, LANES), bool)
    points = -(-steps // EVERY)
    states = np.zeros((points, n, LANES), np.uint64)
    shift = np.uint64(63 - SCALE)
    for t in range(steps - 1, -1, -1):
        s = lane[:, t]
        f = table.f[s]
        full = state >= (f << shift)
        words[t], out[t] = state.astype(np.uint32), full
        now = np.where(full, state >> np.uint64(32), state)
        q = now // f
        now = (q << np.uint64(SCALE)) + (now - q * f) + table.c[s]
        live = t < own_steps
        state = now if live.all() else np.where(live[:, None], now, state)
        if not live.all():
            out[t, ~live] = False
        if t % EVERY == 0:
            states[t // EVERY] = state
    payloads = []
    for i, x in enumerate(blocks):
        k = -(-own_steps[i] // EVERY)
        mask = out[: own_steps[i], i]
        emitted = words[: own_steps[i], i][mask]
        at = np.concatenate([[0], np.cumsum(mask.sum(axis=1))])[np.arange(k) * EVERY]
        sums = [crc(x[j * EVERY * LANES : (j + 1) * EVERY * LANES]) for j in range(k)]
        payloads.append(
            _HEAD.pack(b"VRN1", len(x), own_steps[i], LANES, SCALE, k, len(emitted), crc(x))
            + np.array(sums, "<u4").tobytes() + at.astype("<u4").tobytes() + states[:k, i].astype("<u8").tobytes() + emitted.astype("<u4").tobytes()
        )
    return payloads


def decode(payloads: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each payload. Every checkpoint's part is decoded by itself, all of them side by side."""
    parts, heads = [], []  # (steps, block, first step, states, words, place)
    offset, streams = 0, []
    for b, raw in enumerate(payloads):
        magic, n, steps, lanes, scale, k, n_words, check = _HEAD.unpack_from(raw)
        if magic != b"VRN1" or lanes != LANES or scale != SCALE:
            raise ValueError("not a block of this format")
        at = _HEAD.size
        sums = np.frombuffer(raw, "<u4", k, at)
        places = np.frombuffer(raw, "<u4", k, at + 4 * k)
        states = np.frombuffer(raw, "<u8", k * LANES, at + 8 * k).reshape(k, LANES)
        streams.append(np.frombuffer(raw, "<u4", n_words, at + 8 * k + 8 * k * LANES))
        heads.append((n, steps, check, sums))
        parts += [(min(EVERY, steps - j * EVERY), b, j, states[j], offset + int(places[j])) for j in range(k)]
        offset += n_words
    words = np.concatenate([*streams, np.zeros(LANES, np.uint32)]).astype(np.uint64)
    out = [np.zeros(steps * LANES, np.uint32) for _, steps, _, _ in heads]
    low = np.uint64((1 << SCALE) - 1)
    for length in {p[0] for p in parts}:
        own = [p for p in parts if p[0] == length]
        state, place = np.array([p[3] for p in own], np.uint64), np.array([p[4] for p in own])
        got = np.zeros((length, len(own), LANES), np.uint32)
        for t in range(length):
            slot = state & low
            s = table.slots[slot.astype(np.int64)]
            got[t] = s
            state = table.f[s] * (state >> np.uint64(SCALE)) + slot - table.c[s]
            empty = state < LOW
            ahead = np.cumsum(empty, axis=1)
            read = words[np.minimum(place[:, None] + ahead - 1, len(words) - 1)]
            state = np.where(empty, (state << np.uint64(32)) | read, state)
            place = place + ahead[:, -1]
        for i, (_, b, j, _, _) in enumerate(own):
            out[b][j * EVERY * LANES : (j * EVERY + length) * LANES] = got[:, i].ravel()
    for b, (n, _, check, sums) in enumerate(heads):
        out[b] = out[b][:n]
        if crc(out[b]) != check:
            bad = [j for j, x in enumerate(sums) if crc(out[b][j * EVERY * LANES : (j + 1) * EVERY * LANES]) != x]
            raise ValueError(f"checksum of block {b} differs, in checkpoints {bad}")
    return out


def crc_joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of joined byte strings from (crc32, bytes) of each."""
    total = 0
    for check, n in parts:
        total = _crc_shift(total, n) ^ check
    return total


def _times(mat: list[int], vec: int) -> int:
    out, i = 0, 0
    while vec:
        if vec & 1:
            out ^= mat[i]
        vec >>= 1
        i += 1
    return out


#: GF(2) matrices that carry a crc32 over 2**k zero bits, each the square of the one before; made once for each process.
_ZEROS = [[0xEDB88320, *(1 << i for i in range(31))]]


def _crc_shift(value: int, n: int) -> int:
    """crc32 ``value`` carried over n zero bytes."""
    bits, k = 8 * n, 0
    while bits and value:
        if k == len(_ZEROS):
            _ZEROS.append([_times(_ZEROS[-1], x) for x in _ZEROS[-1]])
        if bits & 1:
            value = _times(_ZEROS[k], value)
        bits >>= 1
        k += 1
    return value
