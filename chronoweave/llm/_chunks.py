"""Ids of texts through a bounded cache of their chunks.

A chunk begins with a space or line break that stands between two characters other than white space, and runs to the next such
place. The tokenizers used here never join characters across that place, so a chunk has the same ids wherever it stands. Prose
repeats its chunks; each is encoded once for as long as it stays in the cache. Longer runs of white space stay inside a chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Chunks in one of the cache's two generations.
GENERATION = 250_000
#: Longer chunks are not kept.
LONGEST = 64

#: White space other than the space and the line feed.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def split(text: str) -> list[str]:
    """The text's chunks, each but the first without its leading space (a leading line break stays)."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _ODD.search(text):
        return _CUT.split(text)
    return text.replace("\n", " \n").split(" ")


class ChunkCache:
    """``encode(chunks)`` gives the bytes of each chunk's ids; ``ids`` joins those of a text's chunks.

    prefix: what is put before the text.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], prefix: str = "") -> None:
        self.encode, self.prefix = encode, prefix
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        parts = split(self.prefix + text)
        found = list(map(self.now.get, parts))
        found[0] = None
        if miss := [i for i, f in enumerate(found) if f is None and i]:
            new = []
            for i in miss:
                found[i] = self.old.get(parts[i])
                if found[i] is None:
                    new.append(i)
            for i, ids in zip(new, self.encode([parts[i] if parts[i][:1] == "\n" else " " + parts[i] for i in new])) if new else ():
                found[i] = ids
            if len(self.now) >= GENERATION:
                self.old, self.now = self.now, {}
            for i in miss:
                if len(parts[i]) <= LONGEST:
                    self.now[parts[i]] = found[i]
        found[0] = self.encode([parts[0]])[0] if parts[0] else b""
        return b"".join(found)
