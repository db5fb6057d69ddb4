"""Token ids of whole texts through the tokenizers library, one cache per worker.

``word_bpe_49k.json`` drops white space before it looks for words, so a text's
ids are the ids of its white-space-separated chunks in order. Chunks repeat
far more often than texts do: each Python worker keeps the ids of the chunks
it has seen in a dictionary bounded by entries, and only unseen chunks reach
the library's normalizer, pre-tokenizer and model.
"""

from __future__ import annotations

import json
import string
from functools import lru_cache

import numpy as np

#: Chunks one worker remembers; the cache is emptied when full (about 200 bytes each).
CACHE_ENTRIES = 900_000
#: Longer chunks are encoded each time they occur.
CACHE_CHUNK_BYTES = 64

# Fixed value: the normaliser steps under which chunks can be encoded apart.
_SPLITTABLE_NORMALIZER = ["NFC", "Replace", "Lowercase"]

_PUNCTUATION = string.punctuation.encode()


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from
    U+0100 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def drops_white_space(config: dict) -> bool:
    """Whether a tokenizer's ids of a text are those of its white-space chunks.

    True for files whose pre-tokenizer keeps only matches of patterns that
    hold no white space, whose normaliser maps white space to white space,
    and whose added tokens hold none.
    """
    normalizer = config.get("normalizer") or {}
    steps = [s.get("type") for s in normalizer.get("normalizers", [])]
    pre = config.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [{}])[0]
    return (
        steps == _SPLITTABLE_NORMALIZER
        and first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and r"[^\s\p{L}\p{N}]+" in first.get("pattern", {}).get("Regex", "")
        and config.get("post_processor") is None
        and all(not any(c.isspace() for c in t["content"]) and not t["normalized"] for t in config["added_tokens"])
    )


class ChunkEncoder(dict):
    """Maps a chunk's UTF-8 bytes to its ids as little-endian uint32 bytes."""

    def __init__(self, path: str, limit: int = CACHE_ENTRIES):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_chunk = drops_white_space(config)
        self.special = [t["content"].encode() for t in config["added_tokens"]]
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.limit = limit

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self._ids(chunk)
        if len(chunk) <= CACHE_CHUNK_BYTES:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = ids
        return ids

    def _ids(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters: one word
            low = chunk.lower()
            return self._word(low.decode()) if low == chunk else self[low]
        if any(s in chunk for s in self.special):
            return self._whole(chunk.decode())
        core = chunk.strip(_PUNCTUATION)
        if core and len(core) < len(chunk):
            at = chunk.index(core)
            # Punctuation beside a letter is a word of its own, but for an apostrophe before one ('s, 't).
            low = core.decode().lower()
            if low[0].isalpha() and low[-1].isalpha() and chunk[at - 1 : at] != b"'":
                before, after = chunk[:at], chunk[at + len(core) :]
                return (self[before] if before else b"") + self[core] + (self[after] if after else b"")
        text = chunk.decode()
        if text.isalpha() and max(text) < "\u0100":  # Latin-1 letters: one word, in normal form already
            return self._word("".join([self.symbols[b] for b in text.lower().encode()]))
        text = self.tokenizer.normalizer.normalize_str(text)
        return b"".join(self._word(w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def _word(self, word: str) -> bytes:
        """Ids of one word in byte symbols."""
        return np.array([t.id for t in self.model.tokenize(word)], dtype="<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """The whole text's ids as little-endian uint32 bytes; null counts as empty."""
        if not text:
            return b""
        if not self.by_chunk:
            return self._whole(text)
        return b"".join(map(self.__getitem__, text.encode().split()))  # bytes.split: ASCII white space only


@lru_cache(maxsize=1)
def encoder(path: str, limit: int = CACHE_ENTRIES) -> ChunkEncoder:
    """This worker's encoder of a tokenizer file; only the last one used is kept, with its cache."""
    return ChunkEncoder(path, limit)
