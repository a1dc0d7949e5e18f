"""Byte-level BPE ids of whole texts, equal to the library's, through bounded per-worker caches.

Where every space and line feed stands alone between two non-spaces, a text splits before them into
chunks whose ids do not depend on each other: the pre-tokenizer always starts a new pre-token there, and a
lone line feed is one of its own. So a chunk's ids can be kept and reused. Any other text, and any chunk
with characters outside the plain Latin ranges, goes to the library as it is.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from tokenizers import Tokenizer

#: Every character that any reading of Unicode counts as white space, but the space itself.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[!-~ \n{_LETTERS}]+")
#: The pre-token pattern of the vocabulary, its classes written out for the plain ranges.
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \n{_LETTERS}0-9]+|\s+(?!\S)|\s+")
#: Longer chunks are encoded but not kept, so that a cache entry has a size bound.
LONGEST = 48


def _byte_letters() -> str:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in own else chr(next(rest)) for b in range(256))


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. ``capacity`` bounds the entries of each cache."""

    def __init__(self, path: str, capacity: int = 700_000):
        self.library = Tokenizer.from_file(path)
        self.capacity = capacity
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self._model = self.library.model
        self._map = dict(enumerate(_byte_letters()))
        self._bytes = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        self._pre: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def chunk(self, text: str) -> bytes:
        """Ids of one chunk, by its pre-tokens where its characters are plain."""
        plain = text.isascii() and text.isprintable()
        if not plain and not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.whole(text)
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._piece(text)
        kept, out = self._pre, []
        for x in _PRE_TOKEN.findall(text):
            ids = kept.get(x)
            if ids is None:
                ids = self._piece(x)
                if len(x) <= LONGEST:
                    if len(kept) >= self.capacity:
                        kept.clear()
                    kept[x] = ids
            out.append(ids)
        return b"".join(out)

    def _piece(self, pre_token: str) -> bytes:
        mapped = pre_token.encode().decode("latin-1").translate(self._map)
        return b"".join([self._bytes[t.id] for t in self._model.tokenize(mapped)])


def _lone(text: str) -> bool:
    """Whether all spaces and line feeds stand alone between non-spaces."""
    if "  " in text or text[0] in " \n" or text[-1] in " \n":
        return False
    return not any(c in text and (f" {c}" in text or f"{c} " in text or f"\n{c}" in text or f"{c}\n" in text) for c in _SPACES)


class Chunks(dict):
    """chunk -> what ``make`` gives of its ids; the first tier is never dropped.

    A chunk is the text after a space, or a line feed and the text after it.
    """

    def __init__(self, encoder: Encoder, make, first: dict | None = None):
        super().__init__(first or {})
        self.encoder, self.make, self.first = encoder, make, first or {}
        self.line_feed = encoder.whole("\n")

    def __missing__(self, chunk: str):
        ids = self.line_feed + self.encoder.chunk(chunk[1:]) if chunk[0] == "\n" else self.encoder.chunk(f" {chunk}")
        value = self.make(ids)
        if len(chunk) <= LONGEST:
            if len(self) >= self.encoder.capacity + len(self.first):
                self.clear()
                self.update(self.first)
            self[chunk] = value
        return value

    def split(self, text: str):
        """(value of the first chunk, iterator over the others' values), or None if the text must go whole."""
        if not _lone(text):
            return None
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.make(self.encoder.chunk(first)), map(self.__getitem__, rest)


def token_chunks(path: str, capacity: int) -> tuple[Encoder, Chunks]:
    """An encoder and its chunks of ids."""
    encoder = Encoder(path, capacity)
    return encoder, Chunks(encoder, bytes)


@functools.lru_cache(maxsize=1)
def worker_chunks(path: str, capacity: int) -> tuple[Encoder, Chunks]:
    """The same, kept by a worker from one task to its next."""
    return token_chunks(path, capacity)
