"""Byte-level BPE token ids by the ``tokenizers`` library, with remembered pieces.

A byte-level BPE splits a text before it merges, and no merge crosses a split. A space that a word
follows always begins a piece, so a text cut before such spaces can be encoded part by part. Each
worker remembers the ids of the parts it has met (at most ``REMEMBERED``, later ones are encoded each time),
and gives new ones to the library, many in one call. A part of letters alone is one piece, so it goes to the
library's model without the splitter; letters with marks and line ends between them are put together from such pieces. Arrow finds the distinct parts of a step; only these are looked up. Texts in
which a space stands between white space or ends a run of it are given to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose parts are looked up together; a single longer text is a step of its own.
STEP_BYTES = 1 << 21
#: Parts that a worker remembers; each takes some 200 bytes.
REMEMBERED = 1_200_000

_RUN = re.compile(r"\s (\s|\Z)")
_EDGE = re.compile(r"\A\s|\s\Z|\A\Z")
#: Behind letters these make one piece of their own, however many there are.
_MARKS = ",.;:!?)]\"%*$#&"


def _byte_letters() -> dict[int, str]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones are themselves, others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_letters()


def _spelt(x: str) -> str:
    return x if x.isascii() else x.encode().decode("latin-1").translate(_BYTES)


def _run(text: str) -> bool:
    """Whether a space may stand inside or at the end of a run of white space."""
    if text.isascii():
        return text[-1] == " " or "  " in text or any(f"{c} " in text for c in "\n\t\r\v\f")
    return _RUN.search(text) is not None


class Encoder:
    """Texts to little-endian ids of ``width`` bytes. Special tokens' strings in a text are ordinary text."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.model = Tokenizer(self.library.model)  # the same model without a splitter
        self.library.encode_special_tokens = True
        self.size = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.spaced = np.zeros(self.size, bool)
        self.spaced[[i for x, i in self.library.get_vocab().items() if x.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}  # letters with no space before them
        self.line_end = self.whole(["\n"])[0]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, new: list[str]) -> dict[str, bytes]:
        """Ids of parts of letters alone, each with the space before it."""
        if self.library.normalizer is not None:
            return self.parts(new)
        return self._cut(new, self.model.encode_batch_fast([[f"\u0120{_spelt(x)}" for x in new]], is_pretokenized=True, add_special_tokens=False)[0].ids)

    def unspaced(self, new: list[str]) -> dict[str, bytes]:
        """Ids of letters with no space before them."""
        if self.library.normalizer is not None:
            return dict(zip(new, self.whole(new), strict=True))
        # A line end's token stands before each; letters have none.
        line_end = self.model.token_to_id("\u010a")
        spelt = [y for x in new for y in ("\u010a", _spelt(x))]
        made = np.array(self.model.encode_batch_fast([spelt], is_pretokenized=True, add_special_tokens=False)[0].ids, self.kind)
        width, raw = self.kind.itemsize, made.tobytes()
        cuts = np.append(np.flatnonzero(made == line_end), len(made)) * width
        return {x: raw[a + width : b] for x, a, b in zip(new, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}

    def _cut(self, parts: list[str], ids: list[int]) -> dict[str, bytes]:
        """The ids of joined parts by part. The only spaces are those before the parts, so a part begins where a token does that begins with one."""
        made = np.array(ids, self.kind)
        cuts = np.append(np.flatnonzero(self.spaced[made]), len(made)) * self.kind.itemsize
        raw = made.tobytes()
        return {x: raw[a:b] for x, a, b in zip(parts, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}

    def parts(self, new: list[str]) -> dict[str, bytes]:
        """Ids of parts, each with the space before it."""
        plain = [x for x in new if not _EDGE.search(x)]
        odd = [x for x in new if _EDGE.search(x)]
        out = dict(zip(odd, self.whole([f" {x}" for x in odd]), strict=True))
        if plain:
            out.update(self._cut(plain, self.library.encode_batch_fast([f" {' '.join(plain)}"], add_special_tokens=False)[0].ids))
        return out

    def _marks(self, new: set[str]) -> None:
        order = sorted(new - self.marks.keys())
        self.marks.update(zip(order, self.whole(order), strict=True))

    def _firsts(self, new: set[str]) -> dict[str, bytes]:
        """Ids of letters with no space before them, those that are remembered and others."""
        missing = sorted(new - self.starts.keys())
        got = self.unspaced(missing) if missing else {}
        out = {x: self.starts[x] for x in new if x in self.starts} | got
        if len(self.known) + len(self.starts) + len(got) <= REMEMBERED:
            self.starts.update({x: y for x, y in got.items() if len(x) <= 64})  # no whole text of letters
        return out

    def _resolved(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not known: letters with marks behind them, and lines of such, from their pieces, others from the library."""
        known, heads, lines, new, words, firsts = self.known, {}, {}, [], set(), set()
        for x in missing:
            if x.isalpha():
                words.add(x)
                continue
            if "\n" not in x:
                head = x.rstrip(_MARKS)
                if head.isalpha():
                    heads[x] = head
                    if head not in known:
                        words.add(head)
                else:
                    new.append(x)
                continue
            rows = [(y.rstrip(_MARKS), y) for y in x.split("\n")]
            if all([h.isalpha() for h, _ in rows]):
                lines[x] = rows
                if rows[0][0] not in known:
                    words.add(rows[0][0])
                firsts.update([h for h, _ in rows[1:]])
            else:
                new.append(x)
        got = (self.words(sorted(words)) if words else {}) | (self.parts(sorted(new)) if new else {})
        marks = self.marks
        self._marks({x[len(h) :] for x, h in heads.items()} | {y[len(h) :] for rows in lines.values() for h, y in rows})
        start = self._firsts(firsts) if firsts else {}
        out = dict(got)
        for x, h in heads.items():
            out[x] = (known.get(h) or got[h]) + marks[x[len(h) :]]
        if len(known) + len(self.starts) + len(out) <= REMEMBERED // 3:
            known.update(out)
        elif len(known) + len(self.starts) + len(got) <= REMEMBERED:
            known.update(got)
        for x, rows in lines.items():
            out[x] = self.line_end.join([(start[h] if i else known.get(h) or got[h]) + marks[y[len(h) :]] for i, (h, y) in enumerate(rows)])
        return out

    def _heads(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without a space."""
        start = self._firsts({x for x in texts if x.isalpha()})
        others = [x for x in texts if x not in start]
        start.update(zip(others, self.whole(others), strict=True))
        return [start[x] for x in texts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        ids, at = self.encode_column(pa.array(texts, pa.large_string()))
        raw, at = ids.tobytes(), (at * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode_column(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin, with where the last one's end. ``end_id`` is put behind each text."""
        texts = column.to_pylist()
        cut, odd = [], []
        for i, text in enumerate(texts):
            if text:
                (odd if _run(text) else cut).append(i)
        split = pc.split_pattern(column if len(cut) == len(texts) else column.take(pa.array(cut, pa.int64())), " ")
        coded = split.flatten().dictionary_encode()
        parts, of = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        per_text = split.value_lengths().to_numpy().astype(np.int64)
        of[np.cumsum(per_text) - per_text] = len(parts) + np.arange(len(cut))  # no space before a text's first part
        ids = list(map(self.known.get, parts))
        unknown = [i for i in np.flatnonzero(np.bincount(of, minlength=len(parts))[: len(parts)]).tolist() if ids[i] is None]
        new = self._resolved({parts[i] for i in unknown}) if unknown else {}
        for i in unknown:
            ids[i] = new[parts[i]]
        pool = [x or b"" for x in ids] + self._heads([texts[i].partition(" ")[0] for i in cut]) + self.whole([texts[i] for i in odd])
        pool.append(b"" if end_id is None else np.array([end_id], self.kind).tobytes())
        # What each text consists of: its parts or itself, then the end.
        n = np.ones(len(texts), np.int64)
        n[cut] += per_text
        n[odd] += 1
        after = np.cumsum(n)
        which = np.full(int(n.sum()), len(pool) - 1)
        inside = np.zeros(len(texts), bool)
        inside[cut] = True
        inside = np.repeat(inside, n)
        inside[after - 1] = False
        which[inside] = of
        which[(after - n)[odd]] = len(parts) + len(cut) + np.arange(len(odd))
        lengths = np.fromiter(map(len, pool), np.int64, len(pool)) // self.kind.itemsize
        count = lengths[which]
        at = np.append(0, np.cumsum(count))
        place = np.repeat((np.cumsum(lengths) - lengths)[which] - at[:-1], count)
        place += np.arange(at[-1])
        return np.frombuffer(b"".join(pool), self.kind)[place], at[np.append(0, after)]


def encoder(vocabulary: str, made: dict = {}) -> Encoder:  # noqa: B006  one for each process
    if vocabulary not in made:
        made[vocabulary] = Encoder(vocabulary)
    return made[vocabulary]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
