"""Token ids of public vocabularies, by the tokenizers library, once per distinct piece of text.

Both vocabularies cut a text before a space that a character other than white space follows, whatever stands
around it, so a text is the concatenation of its pieces between such spaces. Pieces repeat; each worker keeps
the ids of short ones in a table of bounded size and encodes new ones together, as one text that is split again
by the offsets the library reports. The ids are those of the library on the whole text (tests compare them).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of any of the libraries involved.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 ᠎ -​    　﻿"
_CUT = re.compile(f" (?=[^{SPACES}])")
_ODD = re.compile(f"[{SPACES}][{SPACES}]")
_INNER = re.compile(f"[{SPACES}]")
#: ASCII marks that neither pattern joins to a letter before them.
CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
KEPT_PIECES, KEPT_LENGTH, TOGETHER = 1_200_000, 48, 400
_WORKERS: dict[str, PieceEncoder] = {}


def pieces(text: str) -> list[str]:
    """The text cut before each space or line break that stands alone; a space itself is left out, a break is kept."""
    return _CUT.split(text) if _ODD.search(text) else text.replace("\n", " \n").split(" ")


class Pieces:
    """Encodes texts by their pieces; ids are little-endian unsigned 32-bit bytes."""

    limit = KEPT_PIECES

    def __init__(self):
        self.kept: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def alone(self, text: str) -> bytes:
        """Ids of a text as a whole."""
        raise NotImplementedError

    def together(self, found: list[str]) -> list[bytes]:
        """Ids of pieces without inner white space, each with its space before."""
        return [self.alone(" " + p) for p in found]

    def starts(self, found: list[str]) -> list[bytes]:
        """Ids of pieces that begin a line or text."""
        return [self.alone(p) for p in found]

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Add pieces to the table; what is not kept there is returned.

        A line break before a word and marks after it are matches of their own in either vocabulary's pattern, so
        only the word between is new text.
        """
        kept, stems, marked, words, plain, lines, rest = self.kept, set(), [], [], [], [], {}
        for p in new:
            if len(p) <= KEPT_LENGTH and p.isalpha():
                plain.append(p)
                continue
            word = p.rstrip(CLOSING)
            if word is not p and len(p) <= KEPT_LENGTH and word.isalpha() and word.lower().isalpha():
                marked.append(p)
                words.append(word)
                if word not in kept:
                    stems.add(word)
            elif len(p) <= KEPT_LENGTH and (p.isalnum() or not _INNER.search(p)):
                plain.append(p)
            elif p[0] == "\n" and len(p) <= KEPT_LENGTH and not _INNER.search(p, 1):
                lines.append(p)
            else:
                rest[p] = self.alone(p if p[0] == "\n" else " " + p)
        plain = [*stems.union(plain)]
        kept.update(zip(plain, self.together(plain), strict=True))
        for p, word in zip(marked, words, strict=True):
            kept[p] = kept[word] + self._tail(p[len(word) :])
        if lines:
            for p, ids in zip(lines, self.starts([p[1:] for p in lines]), strict=True):
                kept[p] = self._tail("\n") + ids
        return rest

    def _tail(self, text: str) -> bytes:
        if text not in self.tails:
            self.tails[text] = self.alone(text)
        return self.tails[text]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; None counts as empty."""
        if len(self.kept) > self.limit:
            self.kept.clear()
            self.tails.clear()
        odd = [i for i, t in enumerate(texts) if t and _ODD.search(t)]
        if not odd:
            return self._encode_cut(even_pieces(texts))
        out: list[bytes] = [b""] * len(texts)
        even = sorted(set(range(len(texts))).difference(odd))
        groups = (
            (even, even_pieces([texts[i] for i in even])),
            (odd, pa.array([pieces(texts[i]) for i in odd], pa.large_list(pa.large_string()))),
        )
        for places, cut in groups:
            for i, ids in zip(places, self._encode_cut(cut), strict=True):
                out[i] = ids
        return out

    def _encode_cut(self, cut: pa.ListArray | pa.LargeListArray) -> list[bytes]:
        """Ids of texts that are cut into pieces: each distinct piece is looked up once, the rest is array work."""
        n = len(cut)
        if not n:
            return []
        coded, edge = cut.values.dictionary_encode(), cut.offsets.to_numpy().astype(np.int64)
        codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = [names[k] for k in codes[edge[:-1]].tolist()]
        codes[edge[:-1]] = len(names) + np.arange(n)
        inner = np.zeros(len(names) + n, bool)
        inner[codes] = True
        used = [p for p, x in zip(names, inner.tolist()) if x]
        # The start of a text is like the start of a line.
        lines = ["\n" + p if p and not _INNER.search(p) else "" for p in first]
        kept = self.kept
        if "" not in kept:
            kept[""] = self.alone(" ")  # a space at the end
        blobs = list(map(kept.get, used))
        missing = [i for i, ids in enumerate(blobs) if ids is None]
        new = {used[i] for i in missing}
        new.update(p for p in lines if p not in kept)
        rest = self._learn(new)

        def known(p: str) -> bytes:
            return rest[p] if p in rest else kept[p]

        skip = len(self._tail("\n"))
        for i in missing:
            p = used[i]
            blobs[i] = kept[p] if not rest or p not in rest else rest[p]
        for p, line in zip(first, lines, strict=True):
            blobs.append(known(line)[skip:] if line else self.alone(p) if p else b"")
        return gathered(blobs, (np.cumsum(inner) - 1)[codes], edge)


def even_pieces(texts: list[str | None]) -> pa.LargeListArray:
    """``pieces`` of texts in which no white space follows other white space."""
    column = pa.array([t or "" for t in texts], pa.large_string())
    return pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")


def gathered(blobs: list[bytes], codes: np.ndarray, edge: np.ndarray) -> list[bytes]:
    """For each run [edge[i], edge[i + 1]) of codes, the blobs they name, one after another."""
    flat = pa.array(blobs, pa.large_binary()).take(pa.array(codes))
    _, ends, data = flat.buffers()
    at = np.frombuffer(ends, np.int64, len(codes) + 1)[edge].tolist()
    raw = memoryview(data) if data is not None else b""
    return [bytes(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


class PieceEncoder(Pieces):
    """Pieces by the tokenizers library."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        names = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(names.values(), default=-1) + 1, bool)
        self.opens[[i for name, i in names.items() if name.startswith("Ġ")]] = True
        probe = self.tokenizer.encode(" a b", add_special_tokens=False).ids
        self.keeps_spaces = self.opens[probe].sum() == 2
        self.closes = np.zeros(len(self.opens), bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def starts(self, found: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(found, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def together(self, found: list[str]) -> list[bytes]:
        if self.keeps_spaces:
            return [ids for part in self._parts(found) for ids in self._by_marks(part, self.opens, 0)]
        # A word of ASCII letters is one match of the pattern, so an id that ends a word ends it.
        easy = [p.isascii() and p.isalpha() for p in found]
        words = iter([ids for part in self._parts([p for p, x in zip(found, easy, strict=True) if x])
                      for ids in self._by_marks(part, self.closes, 1)])
        others = iter([ids for part in self._parts([p for p, x in zip(found, easy, strict=True) if not x])
                       for ids in self._by_offsets(part)])
        return [next(words if x else others) for x in easy]

    @staticmethod
    def _parts(found: list[str]) -> Iterator[list[str]]:
        return (found[i : i + TOGETHER] for i in range(0, len(found), TOGETHER))

    def _by_marks(self, part: list[str], marks: np.ndarray, after: int) -> list[bytes]:
        """Ids of each piece, cut before (after=0) or behind (1) marked ids; by offsets where that does not add up."""
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(marks[ids]) + after
        if len(at) != len(part):
            return self._by_offsets(part)
        return self._cut(ids, at.tolist() if after else [*at[1:].tolist(), len(ids)])

    def _by_offsets(self, part: list[str]) -> list[bytes]:
        e = self.tokenizer.encode(" " + " ".join(part), add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        at = np.fromiter((a for a, _ in e.offsets), np.int64, len(ids))
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in part), np.int64, len(part)))
        return self._cut(ids, np.searchsorted(at, ends).tolist())

    @staticmethod
    def _cut(ids: np.ndarray, stops: list[int]) -> list[bytes]:
        raw, start, out = ids.tobytes(), 0, []
        for stop in stops:
            out.append(raw[4 * start : 4 * stop])
            start = stop
        return out


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _WORKERS:
        _WORKERS[path] = PieceEncoder(path)
    return _WORKERS[path]
