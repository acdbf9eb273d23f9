"""Subword ids of whole texts, by a public byte-level BPE vocabulary.

The vocabulary file and the split pattern are parameters.  A text is cut where
a single space stands between two other characters: the pattern always begins
a new piece there, so the parts can be encoded apart, and a bounded cache
gives the ids of the parts that came before.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

#: Parts in the cache, about 200 bytes each; it starts anew when full.
CACHE_PARTS = 300_000
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s | \s")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Subwords:
    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): i
            for piece, i in self.whole.get_vocab(with_added_tokens=True).items()
            if piece not in special
        }
        # Encodes a lone part several times faster than the other library; ids are equal.
        self.part = tiktoken.Encoding(
            "parts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.cache: dict[str, bytes] = {}
        probe = "Probe: it's 12 words,\n\n  with  gaps é中\U0001f600 \t."
        if self(probe) != self._by_library(probe):
            raise ValueError(f"{path} does not split by the given pattern")

    def _by_library(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers in this machine's (little-endian) order."""
        if not text:
            return b""
        if self.special.search(text):
            return self._by_library(text)
        parts = _SAFE.split(text) if _ODD.search(text) else text.split(" ")
        cache = self.cache
        if len(cache) > CACHE_PARTS:
            cache.clear()
        out = [array("I", self.part(parts[0])).tobytes(), *map(cache.get, parts[1:])]
        for i, ids in enumerate(out):
            if ids is None:
                part = parts[i]
                out[i] = cache[part] = array("I", self.part(" " + part)).tobytes()
        return b"".join(out)


@lru_cache(maxsize=2)
def subwords(path: str, pattern: str) -> Subwords:
    """One per Python worker and vocabulary."""
    return Subwords(path, pattern)
