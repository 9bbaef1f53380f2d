"""Token ids by a public tokenizer, with the ids of repeated words remembered.

The word tokenizer never joins text across a blank or line break, so a text's ids are the ids
of its blank-separated chunks in a row. Each chunk is encoded once while the memory holds it.
Tokenizers of other kinds, and texts with special-token strings, are encoded whole.
"""

from __future__ import annotations

import gc
import json
import os
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

from tablehaul.llm.common import worker_model

#: Chunks remembered at once in a Python worker; beyond that the memory starts anew.
MEMORY = 450_000
#: ASCII signs: one behind letters never joins them.
SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
UTF8 = ("utf-8", "surrogatepass")
#: Chunks of this many bytes or more are not remembered.
LONG = 64
#: Words encoded in one call of the tokenizer.
CALL = 50


class Encoder:
    """Ids of texts under one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.special = [t["content"].lower() for t in settings["added_tokens"]]
        self.by_chunk = settings["model"].get("end_of_word_suffix") == "</w>"
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunks(self, text: str) -> list[bytes] | None:
        """Chunks between ASCII blanks and line breaks, A-Z in lower case as the tokenizer has
        it; None when the text has to be encoded whole. A special-token string in capitals is
        ordinary text, but its chunk in lower case would not be."""
        if not self.by_chunk:
            return None
        if "<|" in text:
            lower = text.lower()
            if any(s in lower for s in self.special):
                return None
        return text.encode(*UTF8).lower().split()

    def _learn(self, words: set[bytes]) -> None:
        """Add chunks to the memory: those of ASCII letters straight from the model, since the
        tokenizer's other steps leave them as they are, other words many to a call, and the
        rest one by one."""
        known, model = self.known, self.tokenizer.model
        others = []
        for c in words:
            if c.isalpha():
                known[c] = _pack([t.id for t in model.tokenize(c.decode())])
            else:
                others.append(c.decode(*UTF8))
        plain = [t for t in others if t.isalpha()]
        single = [t for t in others if not t.isalpha()]
        calls = [plain[i:i + CALL] for i in range(0, len(plain), CALL)]
        encodings = self.tokenizer.encode_batch_fast(
            [" ".join(c) for c in calls], add_special_tokens=False
        )
        for call, encoding in zip(calls, encodings):
            place = encoding.word_ids
            if not place or place[-1] != len(call) - 1:
                single += call  # a word that the tokenizer cuts
                continue
            own: list[list[int]] = [[] for _ in call]
            for i, p in zip(encoding.ids, place):
                own[p].append(i)
            known.update(
                (t.encode(*UTF8), _pack(o)) for t, o in zip(call, own)
            )
        for t in single:
            known[t.encode(*UTF8)] = _pack(self.whole(t))

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and the lists are long
        try:
            return self._packed(texts)
        finally:
            if collecting:
                gc.enable()

    def _packed(self, texts: list[str]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        chunks = set().union(*(c for c in split if c is not None))
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        missing = chunks.difference(known)
        # Signs behind letters are a piece of their own; such pairs are put together for the
        # texts at hand and not remembered.
        pairs, words, signs = [], [], []
        for c in missing:
            word = c.rstrip(SIGNS)
            if word and word != c and (word.isalpha() or _letters(word.decode(*UTF8))):
                pairs.append(c)
                words.append(word)
                signs.append(c[len(word):])
        new = missing.difference(pairs)
        new.update(words, signs)
        new.difference_update(known)
        self._learn(new)
        for c, word, sign in zip(pairs, words, signs):
            known[c] = known[word] + known[sign]
        out = [
            _pack(self.whole(text)) if own is None else b"".join(map(known.__getitem__, own))
            for text, own in zip(texts, split)
        ]
        for c in pairs:
            del known[c]
        for c in new:
            if len(c) >= LONG:
                del known[c]
        return out

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed([text])[0], "<u4")


def _letters(word: str) -> bool:
    """Whether the tokenizer's normal form of a word has letters only. Some letters become a
    letter and a mark there, and a mark does join the signs that follow."""
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def bundles(texts: Iterable[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Texts in lists of about so many characters, so that a list fits in memory."""
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text)
        if size >= chars:
            yield own
            own, size = [], 0
    if own:
        yield own


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file in a Python worker."""
    return worker_model(("encoder", path), lambda: Encoder(path))
