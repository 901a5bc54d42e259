"""Token ids of whole texts, through a cache of word pieces.

Most of a corpus is a small set of words, so ids are looked up per blank-separated piece. A new piece
is cut into words, digits and signs as the tokenizer's own pre-tokenizer cuts it, and its model is asked
once for each new one of those. That equals tokenizing the whole text because the pre-tokenizer never
joins across white space; texts with characters for which its normaliser does more than ASCII and Latin
lower-casing go to the tokenizer whole.
"""
from __future__ import annotations

import array
import os
import re

import regex

CACHE_ENTRIES = 200_000
CACHE_CHARS = 40  # longer pieces are rare, and are cut anew each time
#: Anything beyond printable ASCII, the usual blanks and the Latin blocks, or the start of a special token.
UNUSUAL = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0ɐ-\U0010ffff]|<\\|")
#: Fixed value: how the vocabulary's file cuts words.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class WordTokens:
    """Ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._pieces: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array.array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            mapped = part if part.isascii() else self._bytes.pre_tokenize_str(part)[0][0]
            found = array.array("I", [t.id for t in self._tokenizer.model.tokenize(mapped)]).tobytes()
            if len(part) <= CACHE_CHARS:
                if len(self._parts) >= CACHE_ENTRIES:
                    self._parts.clear()
                self._parts[part] = found
        return found

    def _piece(self, w: str) -> bytes:
        if w.isascii() and w.isalpha():
            return array.array("I", [t.id for t in self._tokenizer.model.tokenize(w)]).tobytes()
        return b"".join([self._part(p) for p in PARTS.findall(w)])

    def ids(self, text: str) -> bytes:
        if UNUSUAL.search(text):
            return self.whole(text)
        pieces, out = self._pieces, []
        for w in text.lower().split():
            found = pieces.get(w)
            if found is None:
                found = self._piece(w)
                if len(w) <= CACHE_CHARS:
                    if len(pieces) >= CACHE_ENTRIES:
                        pieces.clear()
                    pieces[w] = found
            out.append(found)
        return b"".join(out)
