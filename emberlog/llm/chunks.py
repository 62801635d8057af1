"""Cuts a text into chunks that byte-level BPE encodes independently of each other.

The pre-tokenising pattern of the byte-level vocabularies takes words, numbers and other signs, each with at most one
space before it, and runs of white space. No match starts inside `` ?\\S+`` and ends outside it, so the ids of a text are
those of its chunks in turn, and chunks repeat: their ids are kept in a bounded table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Characters that Python's ``\s`` and other libraries' ``\s`` take differently; a text with one is encoded whole.
ODD = "\x1c\x1d\x1e\x1f\u180e\u200b\u2060\ufeff"
#: A comma or stop that isn't a piece of its own.
JOINED = re.compile(r"[,.](?<=[\W_][,.])[ \n]")
#: Stand in a plain text for a comma and a stop before a space and before its first word; no such text has them of its own.
COMMA, STOP, FIRST = "\x1c", "\x1d", "\x1e"
#: White space that no plain text has: other characters than space and newline, and two together.
SPACES = (*(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"), "  ", " \n", "\n ", "\n\n")


def plain_line(text: str) -> str | None:
    """Chunks of a text whose white space is single spaces and newlines, joined by spaces without those before them; None for others.

    A newline stands together with what follows. A comma or stop after a letter or digit is a piece by itself, so it
    stands alone, and a word has one entry in the table with and without it. The first word, which has no space before
    it, is marked.
    """
    if text[:1] in ("", " ", "\n") or text[-1] in " \n" or any(x in text for x in SPACES):
        return None
    lined = text.replace("\n", " \n")
    if not JOINED.search(text):
        lined = lined.replace(", ", f" {COMMA} ").replace(". ", f" {STOP} ")
    return FIRST + lined


class ChunkEncoder:
    """encode(texts): the ids of each text as little-endian unsigned 32-bit integers.

    whole: gives the ids of strings, each by itself; it gets those of a batch that aren't known yet, together.
    most: entries that are kept; then the table starts anew, which bounds memory and changes no result.
    special: strings that the library takes out of a text before it cuts it; a text with one is encoded whole.
    """

    def __init__(self, whole: Callable[[list[str]], list[bytes]], most: int = 900_000, special: tuple[str, ...] = ()):
        self.whole, self.most, self.special = whole, most, special
        self.odd = (*ODD, *sorted({x[0] for x in special}))  # texts without any of these characters are cut
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}  # chunks without the space before them; a newline stands together with what follows

    def encode(self, texts: list[str]) -> list[bytes]:
        plain: dict[int, str] = {}
        other: dict[int, list[str]] = {}
        odd = []
        for k, text in enumerate(texts):
            if not text:
                continue
            if any(c in text for c in self.odd) and (any(c in text for c in ODD) or any(x in text for x in self.special)):
                odd.append(k)
            elif (line := plain_line(text)) is None:
                other[k] = CHUNK.findall(text)
            else:
                plain[k] = line
        pieces = list(set().union(*other.values()))
        ids = dict(zip(pieces, self._known(self.chunks, pieces, self.whole), strict=True))
        out = [b""] * len(texts)
        for k, x in zip(odd, self.whole([texts[k] for k in odd]), strict=True):
            out[k] = x
        for k, x in other.items():
            out[k] = b"".join(map(ids.__getitem__, x))
        for k, x in zip(plain, self._plain(list(plain.values())), strict=True):
            out[k] = x
        return out

    def forget(self) -> None:
        """Empties the tables."""
        self.chunks.clear()
        self.words.clear()

    def _plain(self, lines: list[str]) -> list[bytes]:
        """Ids of plain lines. Arrow numbers their words, so that each different one is looked up once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not lines:
            return []
        cut = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        numbered = cut.flatten().dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = np.empty(len(words), object)
        ids[:] = self._known(self.words, words, self._spaced)
        at, ends = numbered.indices.to_numpy(), cut.offsets.to_numpy().tolist()
        return [b"".join(ids[at[lo:hi]].tolist()) for lo, hi in zip(ends, ends[1:], strict=False)]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of the words of a plain line, with the space or newline before them."""
        line = self.whole(["\n"])[0]
        signs = {COMMA: ",", STOP: "."}
        ids = self.whole([x[1:] if x[:1] in ("\n", FIRST) else signs.get(x) or " " + x for x in words])
        return [line + y if x[:1] == "\n" else y for x, y in zip(words, ids, strict=True)]

    def _known(self, known: dict[str, bytes], wanted: list[str], of: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of different strings; those that the table doesn't have are added to it."""
        ids = [*map(known.get, wanted)]
        new = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(new, of([wanted[k] for k in new]), strict=True):
            ids[k] = x
        if len(known) + len(new) > self.most:
            known.clear()
            new = range(min(len(wanted), self.most))
        known.update((wanted[k], ids[k]) for k in new)
        return ids
