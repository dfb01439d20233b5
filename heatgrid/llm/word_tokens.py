"""Token ids of texts by a word BPE whose pre-tokens never span a space.

Such a tokenizer (NFC, white space, lower case, then runs of letters, single
digits and runs of other characters) gives a text the ids of its
space-separated parts, one after another, so the parts' ids are kept between
texts. Lower case first, and a space before a full stop or comma between a
letter and white space, change no pre-token but make the parts fewer. A part of
letters alone is one pre-token, which goes to the model directly.
"""

from __future__ import annotations

import os
import re
from array import array
from unicodedata import is_normalized

KEPT = 400_000              # parts whose ids a worker keeps, twice: those used lately and those before
_STOP = re.compile(r"(?<=[a-zß-öø-ÿ])([.,])(?=[ \n])")
#: Their lower case depends on the neighbours, or has several characters.
_NOT_LOWERED = ("Σ", "İ", "<|")


class WordTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.encoder = Tokenizer.from_file(path)
        self.model = self.encoder.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        out = []
        for text in texts:
            if is_normalized("NFC", text) and not any(x in text for x in _NOT_LOWERED):
                text = _STOP.sub(r" \1", text.lower())
            parts = text.replace("\n", " ").split(" ")
            ids = list(map(self.parts.get, parts))
            if None in ids:
                ids = [self._learn(p) if x is None else x for p, x in zip(parts, ids)]
            out.append(b"".join(ids))
        return out

    def _learn(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.before.get(part)
            if ids is None:
                ids = self._encode(part)
            if len(self.parts) > KEPT:
                self.before, self.parts = self.parts, {"": b""}
            self.parts[part] = ids
        return ids

    def _encode(self, part: str) -> bytes:
        if part.isalpha() and part == part.lower():
            if part.isascii():
                return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()
            if is_normalized("NFC", part):
                word = self.bytes.pre_tokenize_str(part)[0][0]
                return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.encoder.encode(part, add_special_tokens=False).ids).tobytes()
