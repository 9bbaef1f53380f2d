"""Token ids under a byte-level tokenizer, with the ids of repeated words remembered.

Such a tokenizer cuts a text into words before it encodes, and always in front of a single blank
that stands before another character. A text's ids are thus the ids of its chunks between single
blanks in a row. Chunks of plain letters, numerals and signs are cut further where the
tokenizer's own pattern does; every word is encoded by the tokenizer's model once while the
memory holds it. Chunks with anything else, such as apostrophes, runs of white space or other
scripts, are encoded by the whole tokenizer.

``WordMemory`` does so chunk by chunk. ``ByteEncoder`` marks the places where any such tokenizer
cuts in the bytes of many texts at once, and only the distinct units between them that are new
are seen one by one.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablehaul.llm.common import worker_model

#: Words remembered at once in a Python worker, those behind a blank and the others each; beyond
#: that the memory starts anew.
MEMORY = 400_000
#: Words of this many characters or more are not remembered.
LONG = 64
#: Units remembered at once by a ``ByteEncoder``, in arrays of some 20 bytes each.
UNITS = 1_000_000
#: Ids put in their places at a time.
BLOCK = 1 << 18

# Letters since the first editions of Unicode, in which all libraries agree.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = r"!-&(-/:-@\[-`{-~"
#: What the tokenizer's pattern cuts in a known way: no apostrophe, no white space but single
#: line breaks inside.
PLAIN = re.compile(rf"[{_LETTERS}0-9{_SIGNS}]+(?:\n[{_LETTERS}0-9{_SIGNS}]+)*\n?")
WORD = re.compile(rf"[{_LETTERS}]+|[0-9]+|\n|[{_SIGNS}]+")
#: A word that the model encodes by itself, behind a blank or nothing.
ALONE = re.compile(rf"( ?)({WORD.pattern})")

# Kinds of bytes, for the places where the tokenizer's pattern cuts: letters, numerals, signs,
# blanks, other white space of ASCII, apostrophes, first bytes of characters that are no white
# space, and all others, beside which nothing is known.
_OTHER, _LETTER, _NUMERAL, _SIGN, _BLANK, _SPACE, _APOSTROPHE, _FIRST = range(8)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[0xC3:0xE1] = kinds[0xE4:0xF5] = _FIRST  # E1 to E3 begin some kinds of white space
    kinds[0x21:0x7F] = _SIGN
    for kind, those in (
        (_LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (_NUMERAL, b"0123456789"),
        (_BLANK, b" "), (_SPACE, b"\t\n\r"), (_APOSTROPHE, b"'"),
    ):
        kinds[list(those)] = kind
    return kinds


def _cuts() -> np.ndarray:
    """Cuts by the kinds of two bytes in a row, 8 x first + second: 1 in front of the first, 2 of the second.

    White space is cut off what precedes it, and the last of it in front of anything else, which
    takes a blank along but nothing else. Letters, numerals and signs are cut off each other.
    """
    cuts = np.zeros((8, 8), np.uint8)
    words, spaces = [_LETTER, _NUMERAL, _SIGN], [_BLANK, _SPACE]
    cuts[np.ix_([*words, _APOSTROPHE], spaces)] = 2
    cuts[np.ix_(words, words)] = 2
    cuts[words, words] = 0
    cuts[_BLANK, [*words, _APOSTROPHE, _FIRST]] = 1
    cuts[_SPACE, [*words, _APOSTROPHE, _FIRST]] = 3
    return cuts.ravel()


_KINDS, _CUTS = _byte_kinds(), _cuts()


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the units begin that the tokenizer encodes by themselves, in the UTF-8 bytes of texts.

    ``starts``: where the texts begin; each begins a unit. A place is a cut whatever stands before
    or behind the two bytes that show it.
    """
    kinds = _KINDS[data]
    at = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))  # _LETTERS of two bytes
    lead, last = data[at], data[at + 1]
    at = at[((lead < 0xC9) | (last < 0x90)) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))]
    kinds[at] = kinds[at + 1] = _LETTER
    seen = _CUTS[(kinds[:-1] << 3) | kinds[1:]]
    starts = starts[starts < len(data)]
    seen[starts[starts > 0] - 1] = 0  # the two belong to different texts
    cut = np.zeros(len(data), bool)
    cut[:-1] = seen & 1
    cut[1:] |= seen > 1
    cut[starts] = True
    return np.flatnonzero(cut)


def blank_chunks(text: str) -> list[str]:
    """Chunks of a text between single blanks, without the blank in front of each.

    Only a blank between two characters that are no blanks, the second no white space at all,
    parts two chunks; other blanks stay inside a chunk.
    """
    out: list[str] = []
    joined = True  # whether the next part belongs to the chunk before
    for i, part in enumerate(text.split(" ")):
        if i and (joined or not part or part[0].isspace()):
            out[-1] += f" {part}"
        else:
            out.append(part)
        joined = not part
    return out


def _byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for
    themselves, the others are counted up from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class WordMemory:
    """What is known of the words of texts, as packed numbers, each word encoded once.

    ``by_chunk``: texts may be cut at single blanks, and ``by_word``: plain chunks at their words.
    Texts with one of the ``special`` strings are taken whole.
    """

    by_chunk = by_word = True
    special: list[str] = []

    def __init__(self):
        #: Numbers of words behind a blank, without it, and of other words.
        self.behind: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}

    def encoded_word(self, word: str, blank: str) -> bytes:
        """Numbers of one word of the tokenizer's pattern, behind a blank or nothing."""
        raise NotImplementedError

    def encoded(self, text: str) -> bytes:
        """Numbers of any text that can be taken by itself."""
        raise NotImplementedError

    def forget(self) -> None:
        """Begin anew where the memory is full."""
        for memory in (self.behind, self.others):
            if len(memory) > MEMORY:
                memory.clear()

    def word(self, word: str, blank: str) -> bytes:
        known = self.behind if blank else self.others
        found = known.get(word)
        if found is None:
            found = self.encoded_word(word, blank)
            if len(word) < LONG:
                known[word] = found
        return found

    def chunk(self, chunk: str, blank: str) -> bytes:
        """Numbers of a chunk behind a blank or nothing."""
        if not self.by_word or not PLAIN.fullmatch(chunk):
            return self.encoded(blank + chunk)
        first, *rest = WORD.findall(chunk)
        found = self.word(first, blank)
        return found + b"".join([self.word(w, "") for w in rest]) if rest else found

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Remember the words among new chunks, and return what is found of all others."""
        known, word, others, mixed = self.behind, self.encoded_word, {}, []
        ends = {s: self.word(s, "") for s in ".,;:!?"} if self.by_word else {}
        line = self.word("\n", "") if ends else b""

        def simple(part: str, blank: str) -> bytes | None:
            """A word of ASCII letters with a sign behind it or none, the commonest mixture."""
            end = ends.get(part[-1:], b"")
            start = part[:-1] if end else part
            return self.word(start, blank) + end if start.isalpha() and start.isascii() else None

        for c in chunks:
            if ends and c.isalpha() and c.isascii() and len(c) < LONG:
                known[c] = word(c, " ")
            else:
                mixed.append(c)
        for c in mixed:
            found = None
            if ends:
                first, cut, rest = c.partition("\n")
                found = simple(first, " ")
                if cut and found is not None:  # the end of one line and the beginning of the next
                    after = simple(rest, "")
                    found = None if after is None else found + line + after
            if found is None:
                found = self.chunk(c, " ")
            if c not in known:
                others[c] = found
        return others

    def packed(self, texts: list[str], behind: bool = False) -> list[bytes]:
        """The numbers of each text; ``behind``: of each text behind a blank."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and the lists are long
        try:
            return self._packed(texts, behind)
        finally:
            if collecting:
                gc.enable()

    def _packed(self, texts: list[str], behind: bool) -> list[bytes]:
        known = self.behind
        self.forget()
        split: list[list[str] | None] = []
        for t in texts:
            whole = not self.by_chunk or any(s in t for s in self.special)
            split.append(None if whole else t.split(" "))
        firsts = [own.pop(0) if own and not behind else "" for own in split]
        missing = set().union(*(own for own in split if own)).difference(known)
        odd = {c for c in missing if not c or c[0].isspace()}
        if odd or not behind and "" in firsts:
            for i, own in enumerate(split):
                if own is None or behind and odd.isdisjoint(own):
                    continue
                if behind:
                    split[i] = blank_chunks(texts[i])
                elif not firsts[i] or not odd.isdisjoint(own):
                    firsts[i], *split[i] = blank_chunks(texts[i])
            missing = set().union(*(own for own in split if own)).difference(known)
        passing = self.learn(missing)
        known.update(passing)
        out = []
        for text, first, own in zip(texts, firsts, split):
            if own is None:
                out.append(self.encoded(f" {text}" if behind else text))
            else:
                first = self.chunk(first, "") if first else b""
                out.append(first + b"".join(map(known.__getitem__, own)))
        for c in passing:
            del known[c]
        return out


class ByteEncoder(WordMemory):
    """Ids under one byte-level tokenizer file, packed as little-endian numbers.

    ``special_text``: special-token strings inside texts are ordinary text, not their ids.
    """

    def __init__(self, path: str, special_text: bool = False):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_text
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        before = settings["pre_tokenizer"] or {}
        self.by_chunk = (
            settings["normalizer"] is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space")
        )
        self.special = [] if special_text else [t["content"] for t in settings["added_tokens"]]
        most = max([*self.tokenizer.get_vocab().values(), 0])
        self.dtype = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.structs = [struct.Struct(f"<{n}{'H' if most < 1 << 16 else 'I'}") for n in range(LONG)]
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.table = str.maketrans({chr(b): c for b, c in enumerate(self.letters)})
        self._clear()

    def _clear(self) -> None:
        #: Units, and the ids of all of them in a row with the number of each.
        self.units = pa.array([], pa.large_binary())
        self.ids, self.sizes = np.empty(0, self.dtype), np.empty(0, np.int64)

    def forget(self) -> None:
        if len(self.units) > UNITS:
            self._clear()

    def pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.structs[n].pack(*ids) if n < LONG else np.array(ids, self.dtype).tobytes()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word_ids(self, word: str, blank: str) -> list[int]:
        if not (word.isalpha() and word.isascii()):
            word = word.encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.model.tokenize(self.letters[32] + word if blank else word)]

    def encoded_word(self, word: str, blank: str) -> bytes:
        return self.pack(self.word_ids(word, blank))

    def encoded(self, text: str) -> bytes:
        return self.pack(self.whole(text))

    def unit_ids(self, unit: str) -> list[int]:
        alone = ALONE.fullmatch(unit)
        return self.word_ids(alone[2], alone[1]) if alone else self.whole(unit)

    def learn_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Remember new ones among different units. Returned are the number of each, the ids of
        all numbers in a row, and how many ids each has; those of long units last."""
        number = pc.index_in(units, value_set=self.units).fill_null(-1).to_numpy().copy()
        new, held = np.flatnonzero(number < 0), len(self.units)
        long = pc.binary_length(units).to_numpy()[new] >= LONG
        new = np.concatenate([new[~long], new[long]])
        number[new] = held + np.arange(len(new))
        found = units.take(pa.array(new))
        own_ids, own_sizes = array("I"), array("q")
        for unit in found.cast(pa.large_string()).to_pylist():
            own = self.unit_ids(unit)
            own_ids.extend(own)
            own_sizes.append(len(own))
        ids = np.concatenate([self.ids, np.array(own_ids, self.dtype)])
        sizes = np.concatenate([self.sizes, np.array(own_sizes, np.int64)])
        held += len(new) - int(long.sum())
        self.units = pa.concat_arrays([self.units, found[:held - len(self.units)]])
        self.sizes = sizes[:held]
        self.ids = ids[:self.sizes.sum()]
        return number, ids, sizes

    def _packed(self, texts: list[str], behind: bool) -> list[bytes]:
        """As in ``WordMemory``, by units of all texts at once."""
        if behind:
            texts = [f" {t}" for t in texts]
        whole = [not self.by_chunk or any(s in t for s in self.special) for t in texts]
        data = [b"" if w else t.encode() for t, w in zip(texts, whole)]
        ends = np.cumsum([len(d) for d in data])
        data = np.frombuffer(b"".join(data), np.uint8)
        if not len(data):
            return [self.encoded(t) if w else b"" for t, w in zip(texts, whole)]
        self.forget()
        begin = unit_starts(data, np.concatenate([[0], ends[:-1]]))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data),
        ]).dictionary_encode()
        number, ids, sizes = self.learn_units(units.dictionary)
        unit = number[units.indices.to_numpy()]
        size, first = sizes[unit], (np.cumsum(sizes) - sizes)[unit]
        last = np.cumsum(size)
        # Some ids at a time, as their places take more memory than they do.
        steps = np.searchsorted(last, np.arange(0, last[-1], BLOCK)).tolist()
        out = np.concatenate([
            _gathered(ids, first[a:b], size[a:b]) for a, b in zip(steps, [*steps[1:], len(size)])
        ])
        # Ids before the end of each text: those of all units that begin before it.
        cuts = np.append(0, last)[np.searchsorted(begin, np.append(0, ends))].tolist()
        return [
            self.encoded(t) if w else out[a:b].tobytes() for t, w, a, b in zip(texts, whole, cuts, cuts[1:])
        ]


def _gathered(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids that begin at each of ``first``, so many of each, in a row."""
    last = np.cumsum(size)
    return ids[np.arange(last[-1] if len(last) else 0) + np.repeat(first - last + size, size)]


def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of a tokenizer file in a Python worker."""
    return worker_model(("byte encoder", path), lambda: ByteEncoder(path))
