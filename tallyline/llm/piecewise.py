"""Ids of whole texts by a public tokenizer, each distinct piece of text encoded once.

A text is cut only where the tokenizer's own pre-tokens begin, so that the ids of the pieces, one after the other, are
the ids of the text. The pieces of natural text repeat; a worker keeps the ids of those that it has met, up to a fixed
number of pieces.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import filterfalse, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers at most; about 200 bytes each. Those not met for half as many others are forgotten.
REMEMBERED = 2_000_000
#: First bytes of characters that are surely not white space: ASCII signs, and lead bytes of blocks without white space.
SOLID = rb"[\x21-\x7e\xc3-\xdf\xe0\xe4-\xf4]"
STARTS = re.compile(rb"(?=[ \n]" + SOLID + rb")")
IRREGULAR = {b""} | {bytes([b]) for b in range(256) if not re.match(SOLID, bytes([b]))}
#: Signs that may end a word; runs of them are pre-tokens of their own. Byte-level models write a space as another sign.
CLOSING, SPACE = b"!,.:;?", "\u0120"
#: Parts whose ids are gathered at a time; runs of closing signs that are remembered.
GATHERED, MOST_CLOSINGS = 1 << 18, 10_000
#: Before a text's first part; a text that holds it is cut another way.
HEAD = b"\x00"
#: Stands for such a text: no regular part is empty.
IRREGULAR_PART = b""
#: ASCII white space as spaces.
TO_SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))


class PiecewiseEncoder:
    """spaces_kept: True for byte-level models, whose pre-tokens keep one space before a word; False for models that drop
    white space. Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str, spaces_kept: bool, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.closings = self.tokenizer.model, {}
        self.spaces_kept, self.remembered = spaces_kept, remembered
        #: The pieces met since the last time that half of what is remembered was full, and those from before.
        self.known: dict[bytes, bytes | None] = {}
        self.earlier: dict[bytes, bytes | None] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit integers; null is empty.

        Arrow cuts all texts at once and numbers the distinct parts, so that a part is looked up once, however often it is
        there; the ids are then gathered by these numbers."""
        if not texts:
            return []
        if len(self.known) > self.remembered // 2:
            self.known, self.earlier = {}, self.known
        data = [(t or "").encode() for t in texts]
        lines = [self._line(d) for d in data]
        parts = pc.split_pattern(pa.array([b" ".join(lines)], pa.large_binary()), " ").values.dictionary_encode()
        _, places, raw = parts.dictionary.buffers()
        raw, places = raw.to_pybytes(), np.frombuffer(places, np.int64, len(parts.dictionary) + 1).tolist()
        distinct = [raw[a:b] for a, b in pairwise(places)]
        new = list(filterfalse(self.known.__contains__, distinct))
        self._learn(list(filterfalse(self.earlier.__contains__, new)))
        self.known.update((p, self.earlier[p]) for p in new if p not in self.known)
        found = list(map(self.known.__getitem__, distinct))
        unsure = np.fromiter((f is None for f in found), bool, len(found)) if None in found else None
        if unsure is not None:
            found = [f or b"" for f in found]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins, number = np.cumsum(sizes) - sizes, parts.indices.to_numpy()
        gathered = []
        for at in range(0, len(number), GATHERED):
            some = number[at : at + GATHERED]
            n = sizes[some]
            ends = np.cumsum(n)
            gathered.append(ids[np.repeat(begins[some] - ends + n, n) + np.arange(ends[-1])].tobytes())
        all_ids, last = b"".join(gathered), np.cumsum([line.count(b" ") + 1 for line in lines])
        stops = (4 * np.cumsum(sizes[number])[last - 1]).tolist()
        out = [all_ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        if unsure is not None:  # a part's start is not surely a pre-token's start
            for i in np.unique(np.searchsorted(last, np.flatnonzero(unsure[number]), "right")).tolist():
                out[i] = b"".join(self._ids([p for p in STARTS.split(data[i]) if p]))
        return out

    def _line(self, data: bytes) -> bytes:
        """The text's parts with a space between each. Where spaces are kept, a part stands for itself after a space, or for itself
        if it starts with a line feed or with the mark HEAD of a text's first part."""
        if not self.spaces_kept:
            return data.translate(TO_SPACES)
        if HEAD in data:
            return IRREGULAR_PART
        return (HEAD + data).replace(b"\n", b" \n")

    def _learn(self, new: list[bytes]) -> None:
        """Words of ASCII letters, with closing signs or without, are pre-tokens as they are: the library's model alone cuts
        them. All else goes through the whole library."""
        known, closings, tokenize, rest = self.known, self.closings, self.model.tokenize, []
        if not self.spaces_kept:
            known[b""] = b""  # between two white spaces
            new = [p for p in new if p]
        for part in new:
            if self.spaces_kept and not _regular(part):
                known[part] = None
                continue
            word = part.rstrip(CLOSING)
            if not word.isalpha():  # of bytes: ASCII letters only
                rest.append(part)
                continue
            ids = array("I", [t.id for t in tokenize(SPACE + word.decode() if self.spaces_kept else word.lower().decode())]).tobytes()
            if len(word) < len(part):
                closing = part[len(word) :]
                if closing not in closings:
                    if len(closings) == MOST_CLOSINGS:
                        closings.clear()
                    closings[closing] = self._ids([closing])[0]
                ids += closings[closing]
            known[part] = ids
        spelled = [p if p[:1] == b"\n" else b" " + p if p[:1] != HEAD else p[1:] for p in rest] if self.spaces_kept else rest
        known.update(zip(rest, self._ids(spelled), strict=True))

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]


def _regular(part: bytes) -> bool:
    if part[:1] in (HEAD, b"\n"):
        return part[1:2] not in IRREGULAR or part == HEAD
    return part[:1] not in IRREGULAR


@cache
def encoder(path: str, spaces_kept: bool, remembered: int = REMEMBERED) -> PiecewiseEncoder:
    """One for each worker."""
    return PiecewiseEncoder(path, spaces_kept, remembered)
