"""Language identification by cross-parsing with one suffix automaton per language.

A text is parsed greedily: each phrase is the longest string from the current position that
occurs in the language's sample. The fewer phrases a language needs, the closer the text is to
it (the cross-entropy estimate of Ziv and Merhav): ``phrases * log2(sample) / characters``.
The language with the least value wins.

The samples are the only part that is bounded: ``LANGUAGE_CHARS`` normalised characters for each
of the ``MOST_LABELS`` most frequent labels, from at most ``SAMPLE_ROWS`` distinct texts in the
order of their digests; a warning tells how many labels were left out. Short texts are taken
whole and leave their share to longer ones, of which pieces spread from the beginning to the end
are taken.

Every text is parsed whole. Blocks of ``BLOCK`` characters advance in step as if a phrase began
with each; then the phrase that was open at the end of a block goes on into the next one until it
meets a phrase end that both ways share, from which on they agree. So the phrases are those of a
plain parse from the first character to the last, however long the text is.

A letter is what ``str.isalpha`` calls one (Unicode's categories of letters).
"""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import worker_model

SAMPLE_ROWS = 100
LANGUAGE_CHARS = 40_000
#: Labels that are learned, the most frequent ones; misspelt ones are rare.
MOST_LABELS = 200
#: Characters of one piece of a longer text, about.
PIECE = 200
#: Codes that have a column in the table of transitions, and the most cells of that table. Both
#: only decide about speed: codes beyond them are looked up in sorted keys.
COMMON = 48
TABLE_CELLS = 16_000_000
BLOCK = 1024
#: Characters parsed together, and the most of one text taken at a time, for four languages.
BUNDLE = 2_000_000
UNDETERMINED = "und"

_OTHERS = re.compile(r"[\W\d_]+")


def speaks(text: str | None) -> bool:
    """Whether a text has a letter."""
    return bool(text) and any(map(str.isalpha, text))


class Alphabet:
    """Codes of characters: 0 for all but letters, one each for the letters of the lower-cased
    samples, the most used ones first, and the last code for letters that no sample has."""

    def __init__(self, samples: list[str]):
        seen = Counter()
        for text in samples:
            seen.update(text.lower())
        letters = sorted((c for c in seen if c.isalpha()), key=lambda c: (-seen[c], c))
        self.size = len(letters) + 2
        points = np.arange(0x110000)
        alpha = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
        self.codes = np.where(alpha, self.size - 1, 0).astype(np.min_scalar_type(self.size - 1))
        for code, c in enumerate(letters, 1):
            self.codes[ord(c)] = code

    def encode(self, text: str, lower: bool = False) -> np.ndarray:
        """Codes of the text in lower case; a run of other characters is one 0."""
        text = text if lower else text.lower()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.codes[points]
        if len(codes) > 1:
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
            codes = codes[keep]
        return codes


def suffix_automaton(codes: list[int]) -> tuple[int, np.ndarray]:
    """Number of states of the suffix automaton, and its transitions as rows of state, code and
    next state, sorted.

    State 0 is the initial one. There are at most two states and three transitions per
    character, however many codes there are.
    """
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        current = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = current
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                copy = len(steps)
                steps.append(dict(steps[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[current] = copy
        last = current
    rows = [(state, c, to) for state, row in enumerate(steps) for c, to in sorted(row.items())]
    return len(steps), np.array(rows, np.int64).reshape(-1, 3)


class _Blocks(NamedTuple):
    """Blocks of texts, and what is known of their phrases, by language."""

    codes: np.ndarray
    start: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    #: Place of a block in order of size, and where a step begins among the marks of beginnings.
    rank: np.ndarray
    row: np.ndarray
    begun: np.ndarray
    state: np.ndarray
    found: np.ndarray


class CrossParser:
    """Phrase counts of texts against the sample of each language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.alphabet = Alphabet([samples[x] for x in self.languages])
        transitions, roots, self.bits, at = [], [], [], 0
        for x in self.languages:
            codes = self.alphabet.encode(samples[x])[:LANGUAGE_CHARS]
            states, own = suffix_automaton(codes.tolist())
            transitions.append(own + (at, 0, at))
            roots.append(at)
            at += states
            self.bits.append(math.log2(len(codes) + 2))
        # A character that the sample lacks is a phrase of its own: it leads to a state without
        # any transition, the last one.
        self.roots, self.nowhere = np.array(roots, np.int32)[:, None], at
        state, code, to = np.concatenate([*transitions, np.empty((0, 3), np.int64)]).T
        # The most used codes have a table of states by codes, all others sorted keys.
        self.common = max(1, min(COMMON, self.alphabet.size, TABLE_CELLS // (at + 1)))
        often = code < self.common
        table = np.full((at + 1, self.common), -1, np.int32)
        table[state[often], code[often]] = to[often]
        self.steps = table.ravel()
        self.keys = state[~often] * self.alphabet.size + code[~often]
        self.targets = to[~often].astype(np.int32)
        # Where a new phrase goes with its first character.
        first = table[self.roots[:, 0]]
        self.first = np.where(first < 0, self.nowhere, first).astype(np.int32)

    def _seldom(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Next states by codes that the table leaves out; -1 where none is."""
        if not len(self.keys):
            return np.full(np.broadcast_shapes(states.shape, codes.shape), -1, np.int32)
        wanted = states.astype(np.int64) * self.alphabet.size + codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], np.int32(-1))

    def _step(self, states: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Next states, -1 where a phrase ends; ``first`` is where the next one begins."""
        near = np.minimum(codes, self.common - 1)
        to = self.steps[states * self.common + near]
        seldom = codes >= self.common
        if seldom.any():
            if states.ndim == 2:
                at = np.flatnonzero(seldom)
                to[:, at] = self._seldom(states[:, at], codes[at])
            else:
                to[seldom] = self._seldom(states[seldom], codes[seldom])
        return to

    def _begin(self, codes: np.ndarray, language: np.ndarray | None = None) -> np.ndarray:
        """Where phrases lie after their first character: for all languages, or for one a code."""
        near = np.minimum(codes, self.common - 1)
        first = self.first[:, near] if language is None else self.first[language, near]
        at = np.flatnonzero(codes >= self.common)
        if len(at):
            roots = self.roots if language is None else self.roots[language[at], 0]
            alone = self._seldom(roots, codes[at])
            first[..., at] = np.where(alone < 0, self.nowhere, alone)
        return first

    def phrases(
        self, pieces: list[np.ndarray], entered: dict[int, np.ndarray] | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Languages by pieces: phrases that begin in each piece, and the states at its end.

        ``entered`` has the states with which a piece goes on from text before it; other pieces
        begin a phrase with their first character.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        counts = np.zeros((len(self.languages), len(pieces)), np.int64)
        ends = np.zeros((len(self.languages), len(pieces)), np.int32)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(pieces)), blocks)
        n = len(owner)
        for i, states in (entered or {}).items():
            ends[:, i] = states
        if not n:
            return counts, ends
        codes = np.concatenate(pieces).astype(np.int32)
        inside = np.arange(n) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = (np.cumsum(lengths) - lengths)[owner] + inside * BLOCK
        size = np.minimum(BLOCK, lengths[owner] - inside * BLOCK)
        # Blocks stand in order of size, so those that are still open are always the first ones.
        order = np.argsort(-size, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        active = np.searchsorted(-size[order], -np.arange(1, int(size.max()) + 1), side="right")
        row = np.cumsum(active) - active
        first_at = start[order]
        # All blocks as if a phrase began with each; ``begun`` marks the beginnings, step by step.
        begun = np.empty((len(self.roots), len(codes)), bool)
        state = np.empty((len(self.roots), n), np.int32)
        found = np.ones((len(self.roots), n), np.int64)
        for j, k in enumerate(active):
            c = codes[first_at[:k] + j]
            first = self._begin(c)
            if j == 0:
                state[:] = first
                begun[:, :k] = True
                continue
            to = self._step(state[:, :k], c, first)
            ended = to < 0
            begun[:, row[j]:row[j] + k] = ended
            found[:, :k] += ended
            state[:, :k] = np.where(ended, first, to)
        # Blocks that a phrase reaches into, by language, with the state in which it does.
        follows = np.flatnonzero(inside > 0)
        language = np.repeat(np.arange(len(self.roots)), len(follows))
        block = np.tile(follows, len(self.roots))
        entering = state[language, rank[block - 1]]
        for i, states in (entered or {}).items():
            if lengths[i]:
                head = int(np.searchsorted(owner, i))
                language = np.concatenate([language, np.arange(len(self.roots))])
                block = np.concatenate([block, np.full(len(self.roots), head)])
                entering = np.concatenate([entering, states])
        texts = _Blocks(codes, start, size, owner, rank, row, begun, state, found)
        while len(block):
            language, block, entering = self._go_on(texts, language, block, entering)
        for i in range(len(counts)):
            counts[i] = np.bincount(owner[order], weights=found[i], minlength=len(pieces))
        last = np.flatnonzero(np.diff(owner, append=-1))
        ends[:, owner[last]] = state[:, rank[last]]
        return counts, ends

    def _go_on(self, own: _Blocks, language: np.ndarray, block: np.ndarray, entering: np.ndarray) -> tuple:
        """Carry open phrases into their blocks, and correct what is known of these, until both
        ways begin a phrase at the same character. Those that never do change the block's last
        state; they are returned for the block behind it, where there is one of the same text."""
        beyond = []
        now = entering
        for j in range(len(own.row)):
            if not len(block):
                break
            c = own.codes[own.start[block] + j]
            first = self._begin(c, language)
            to = self._step(now, c, first)
            ended = to < 0
            at, place = own.row[j] + own.rank[block], own.rank[block]
            before = own.begun[language, at]
            own.begun[language, at] = ended
            own.found[language, place] += ended.astype(np.int64) - before
            now = np.where(ended, first, to)
            agreed = ended & before
            over = ~agreed & (own.size[block] == j + 1)
            if over.any():
                changed = over & (own.state[language, place] != now)
                own.state[language[changed], place[changed]] = now[changed]
                behind = np.minimum(block + 1, len(own.owner) - 1)
                on = changed & (behind > block) & (own.owner[behind] == own.owner[block])
                beyond.append((language[on], behind[on], now[on]))
            left = ~agreed & ~over
            language, block, now = language[left], block[left], now[left]
        if not beyond:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*beyond))

    def identify(self, texts) -> tuple[list[str], list[float]]:
        """The language and score of each text, in bundles of bounded size."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        totals = np.zeros((len(self.languages), len(texts)))
        sizes = np.zeros(len(texts))
        bundle = max(BLOCK, BUNDLE * 4 // max(4, len(self.languages)))
        pieces, owners, waiting = [], [], 0

        def flush():
            nonlocal pieces, owners, waiting
            if pieces:
                np.add.at(totals.T, owners, self.phrases(pieces)[0].T)
            pieces, owners, waiting = [], [], 0

        speaking = []
        for i, text in enumerate(texts):
            if not speaks(text):
                continue
            speaking.append(i)
            if len(text) > bundle:
                totals[:, i], sizes[i] = self._long(text.lower(), bundle)
                continue
            codes = self.alphabet.encode(text)
            pieces.append(codes)
            owners.append(i)
            sizes[i] = len(codes)
            waiting += len(codes)
            if waiting >= bundle:
                flush()
        flush()
        entropy = totals * np.array(self.bits)[:, None] / np.maximum(sizes, 1)
        for i in speaking:
            order = np.argsort(entropy[:, i], kind="stable")
            best = entropy[order[0], i]
            second = entropy[order[1], i] if len(order) > 1 else math.inf
            names[i] = self.languages[order[0]]
            scores[i] = 1.0 if math.isinf(second) else float(second / (best + second))
        return names, scores

    def _long(self, lower: str, most: int) -> tuple[np.ndarray, int]:
        """Phrases and size of one long text, of which a part is in memory as codes at a time."""
        total, size, states, last = np.zeros(len(self.languages)), 0, None, -1
        for at in range(0, len(lower), most):
            codes = self.alphabet.encode(lower[at:at + most], lower=True)
            if last == 0 and len(codes) and codes[0] == 0:
                codes = codes[1:]  # one run of other characters
            if not len(codes):
                continue
            last = int(codes[-1])
            own, states = self.phrases([codes], None if states is None else {0: states})
            total, size, states = total + own[:, 0], size + len(codes), states[:, 0]
        return total, size


def spread(text: str, size: int) -> str:
    """At most ``size`` characters of a text: all, or pieces at even distances, both ends included."""
    if len(text) <= size:
        return text
    n = max(1, size // PIECE)
    piece = (size + 1) // n - 1  # a blank between pieces
    if n == 1 or piece < 1:
        at = (len(text) - size) // 2
        return text[at:at + size]
    starts = (i * (len(text) - piece) // (n - 1) for i in range(n))
    return " ".join(text[a:a + piece] for a in starts)


def filled(texts: list[str], size: int) -> str:
    """A sample of about ``size`` characters from all texts: what a short one leaves of an equal
    share goes to the longer ones. Never more; less only if the texts hold less."""
    shares, rest = {}, size
    for left, i in zip(range(len(texts), 0, -1), sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        shares[i] = min(len(texts[i]), max(0, rest // left - 1))
        rest -= shares[i] + 1
    return " ".join(spread(t, shares[i]) for i, t in enumerate(texts) if shares[i])


def learned_labels(labelled: DataFrame, text_col: str, lang_col: str, most: int) -> list[tuple]:
    """The most frequent labels of rows with a letter, ties by name, and about how many distinct
    texts each has; the rest is told by a warning."""
    speaking = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counted = speaking.groupBy(F.col(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(text_col)).alias("texts")
    )
    chosen = counted.orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    if len(chosen) > most:
        rest = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        kept = sum(r["n"] for r in chosen[:most])
        warnings.warn(
            f"{rest[0] - most} rare labels with {rest[1] - kept} rows are not learned", stacklevel=2
        )
    return [(r["lang"], r["texts"]) for r in chosen[:most]]


def samples_of(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", most_labels: int = MOST_LABELS,
) -> dict[str, str]:
    """A bounded sample of text per language, the same for the same rows.

    Only rows with a language and a letter count, and equal texts of a language count once. Of a
    language with very many texts only those whose digest lies below a threshold are looked at,
    chosen so that about three times ``SAMPLE_ROWS`` do (and raised until enough do), so no task
    gets the digests of a language together. The driver gets ``LANGUAGE_CHARS`` characters for
    each of at most ``most_labels`` languages.
    """
    sizes = dict(learned_labels(labelled, text_col, lang_col, most_labels))
    rows = labelled.filter(F.col(lang_col).isin(list(sizes)) & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h")
    )

    @F.pandas_udf("string")
    def shortened(own: pd.Series) -> pd.Series:
        return own.map(lambda t: spread(_OTHERS.sub(" ", t), LANGUAGE_CHARS))

    def sample(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("h")[:SAMPLE_ROWS]
        return pd.DataFrame({
            "lang": own["lang"][:1], "n": [len(own)], "t": [filled(list(own["t"]), LANGUAGE_CHARS)],
        })

    out: dict[str, str] = {}
    share = {x: min(1.0, 3 * SAMPLE_ROWS / max(1, n)) for x, n in sizes.items()}
    while share:
        # Digests are uniform over 64 bits; a share of 1 takes all.
        below = F.lit(False)
        for x, part in share.items():
            near = F.lit(True) if part >= 1 else F.col("h") < F.lit(int((part - 0.5) * 2**64))
            below = below | ((F.col("lang") == x) & near)
        texts = rows.filter(below).groupBy("lang", "h").agg(F.first("t").alias("t"))
        short = texts.select("lang", "h", shortened("t").alias("t"))
        found = short.groupBy("lang").applyInPandas(sample, "lang string, n long, t string").collect()
        done = {r["lang"]: r["t"] for r in found if r["n"] >= SAMPLE_ROWS or share[r["lang"]] >= 1}
        out |= done
        share = {x: min(1.0, 16 * p) for x, p in share.items() if x not in done and p < 1}
    return dict(sorted(out.items()))


def has_letter(text: Column) -> Column:
    """Whether a language is told for a text once there are samples; false for NULL."""

    @F.pandas_udf("boolean")
    def told(texts: pd.Series) -> pd.Series:
        return pd.Series([speaks(t) for t in texts], dtype=bool)

    return told(text)


def identified(text: Column, samples: dict[str, str]) -> Column:
    """Struct of ``lang`` and ``score`` for a text column.

    The score is the runner-up's share of the entropies of the best two (1 with one language).
    NULL, and texts without a letter, are ``und`` with score 0; so is all text when there are
    no samples. Texts of any length are parsed whole; an empty table gives no row.
    """
    if not samples:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    key = tuple(sorted(samples.items()))

    @F.pandas_udf("lang string, score double")
    def parse(texts: pd.Series) -> pd.DataFrame:
        parser = worker_model(("languages", key), lambda: CrossParser(samples))
        lang, score = parser.identify(list(texts))
        return pd.DataFrame({"lang": lang, "score": score})

    return parse(text)
