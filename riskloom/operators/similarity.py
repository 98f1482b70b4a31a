"""Weighted similarity of two names and the best match of a name in a block of candidates.

The score is the published "weighted ratio" over indel similarity, 0 to 100: the plain ratio; for strings of similar
length the ratio of their sorted words and of their word sets; for strings of different length the ratio of the
shorter one to its best window in the longer one, and of their words likewise. It is called with one bounded block
of names and one bounded block of candidates per group; Spark forms, distributes and reduces the blocks.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache
from typing import NamedTuple

import numpy as np

# --- fixed values: weights and length limits of the published score --------------------------------------------------
WORD_WEIGHT = 0.95
SIMILAR_LENGTH = 1.5
PARTIAL_WEIGHT = 0.9
LONG_LENGTH = 8.0
LONG_WEIGHT = 0.6


@lru_cache(maxsize=65536)
def _positions(text: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, char in enumerate(text):
        masks[char] |= 1 << i
    return dict(masks)


def common_length(masks: dict[str, int], length: int, other: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the string ``masks`` was made from."""
    full = (1 << length) - 1
    state = full
    for char in other:
        hit = state & masks.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return length - state.bit_count()


def _share(common: float, total: int) -> float:
    return 200.0 * common / total if total else 100.0


def ratio(a: str, b: str) -> float:
    return _share(common_length(_positions(a), len(a), b), len(a) + len(b))


def _best_window(short: str, long: str) -> float:
    masks, width, best = _positions(short), len(short), 0.0
    spans = [(0, i) for i in range(1, width)]
    spans += [(i, i + width) for i in range(len(long) - width + 1)]
    spans += [(i, len(long)) for i in range(len(long) - width + 1, len(long))]
    for start, end in spans:
        size = end - start
        if _share(min(size, width), size + width) <= best:
            continue
        best = max(best, _share(common_length(masks, width, long[start:end]), size + width))
        if best == 100.0:
            break
    return best


def partial_ratio(a: str, b: str, needed: float = 0.0) -> float:
    """Ratio of the shorter string to the window of the longer one it resembles most.

    No window has more in common with the shorter string than the whole of the longer one has; where that rules out
    a result above ``needed``, 0 is returned.
    """
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = sorted((a, b), key=len)
    common = common_length(_positions(short), len(short), long)
    if _share(common, len(short) + common) < needed:
        return 0.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(short, long)


class Name(NamedTuple):
    text: str
    words: frozenset[str]
    in_order: str  # all words, sorted
    once: str  # distinct words, sorted


@lru_cache(maxsize=65536)
def prepare(text: str) -> Name:
    words = text.split()
    return Name(text, frozenset(words), " ".join(sorted(words)), " ".join(sorted(set(words))))


def _word_ratio(a: Name, b: Name) -> float:
    shared = a.words & b.words
    only_a, only_b = " ".join(sorted(a.words - b.words)), " ".join(sorted(b.words - a.words))
    if shared and not (only_a and only_b):
        return 100.0
    best = ratio(a.in_order, b.in_order)
    base = len(" ".join(shared))
    gap = 1 if base else 0
    total = 2 * (base + gap) + len(only_a) + len(only_b)
    apart = len(only_a) + len(only_b) - 2 * common_length(_positions(only_a), len(only_a), only_b)
    best = max(best, 100.0 - 100.0 * apart / total if total else 100.0)
    for only in (only_a, only_b) if base else ():
        best = max(best, _share(base, 2 * base + gap + len(only)))
    return best


def _partial_word_ratio(a: Name, b: Name, needed: float) -> float:
    if a.words & b.words:
        return 100.0
    best = partial_ratio(a.in_order, b.in_order, needed)
    if (a.once, b.once) != (a.in_order, b.in_order):
        best = max(best, partial_ratio(a.once, b.once, needed))
    return best


def weighted_ratio(a: Name, b: Name, needed: float = 0.0) -> float:
    """Score of two names; a score below ``needed`` may come out lower than it is."""
    if not a.text or not b.text:
        return 0.0
    short, long = sorted((len(a.text), len(b.text)))
    best = ratio(a.text, b.text)
    if long < SIMILAR_LENGTH * short:
        return max(best, _word_ratio(a, b) * WORD_WEIGHT)
    weight = PARTIAL_WEIGHT if long <= LONG_LENGTH * short else LONG_WEIGHT
    slack = 1e-9
    by_words = weight * WORD_WEIGHT
    best = max(best, _partial_word_ratio(a, b, max(best, needed) / by_words - slack) * WORD_WEIGHT * weight)
    return max(best, partial_ratio(a.text, b.text, max(best, needed) / weight - slack) * weight)


# characters that occur in compared names: digits, lower-case letters, "_" and blank
_COLUMN = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789_ ")}


def _letter_counts(texts: list[str]) -> np.ndarray:
    counts = np.zeros((len(texts), len(_COLUMN)), dtype=np.int16)
    for i, text in enumerate(texts):
        for char in text:
            if char in _COLUMN:
                counts[i, _COLUMN[char]] += 1
    return counts


class Block:
    """Candidates in rank order, with what is needed to bound their score against a name."""

    def __init__(self, texts: list[str]):
        self.names = [prepare(t) for t in texts]
        self.length = np.array([len(n.text) for n in self.names], dtype=float)
        self.least = np.array([len(n.once) for n in self.names], dtype=float)
        self.letters = _letter_counts([n.text for n in self.names])
        by_word: dict[str, list[int]] = defaultdict(list)
        for i, name in enumerate(self.names):
            for word in name.words:
                by_word[word].append(i)
        self.by_word = {word: np.array(places) for word, places in by_word.items()}

    def limits(self, name: Name) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score against every candidate, from lengths, letters and words in common."""
        size, least = len(name.text), len(name.once)
        common = np.minimum(self.letters, _letter_counts([name.text])).sum(axis=1, dtype=np.int64)
        apart = np.maximum(self.length, size) / np.maximum(np.minimum(self.length, size), 1.0)
        similar = apart < SIMILAR_LENGTH
        weight = np.where(apart <= LONG_LENGTH, PARTIAL_WEIGHT, LONG_WEIGHT)

        whole = np.minimum(200.0 * common / np.maximum(self.least + least, 1.0), 100.0)
        short = np.minimum(self.least, least)
        window = np.minimum(200.0 * common / np.maximum(short + common, 1.0), 100.0)
        # strings that differ in length by more than the limit cannot be more alike than this as a whole
        unequal = np.minimum(whole, 200.0 / (1.0 + SIMILAR_LENGTH))
        by_letters = np.where(similar, whole, np.maximum(unequal, weight * window)) + 1e-9

        base = np.zeros(len(self.names))
        for word in name.words:
            if word in self.by_word:
                base[self.by_word[word]] += len(word) + 1
        # only-words of the side that has fewer of them; none left means that its words are all common
        rest = short - (base - 1)
        sets = np.where(rest <= 0, 100.0, 200.0 * (base - 1) / np.maximum(2 * (base - 1) + rest, 1.0))
        by_words = np.where(similar, sets * WORD_WEIGHT, 100.0 * WORD_WEIGHT * weight)
        by_words = np.where((base > 0) & (self.length > 0), by_words, 0.0)
        return by_words, np.maximum(by_letters, by_words)

    def best_two(self, text: str, threshold: float) -> list[tuple[float, int]]:
        """Score and rank of the best candidate and the runner-up at or above ``threshold``; lower rank wins ties.

        Where common words alone decide the score it is known without comparing letters. The others are compared in
        the order of their greatest possible score, until that is below the runner-up's.
        """
        name = prepare(text)
        if not name.text:
            return []
        least, greatest = self.limits(name)
        known = np.flatnonzero((least >= greatest) & (least >= threshold))
        top = [(float(least[i]), int(i)) for i in known[np.argsort(-least[known], kind="stable")[:2]]]
        open_ = np.flatnonzero((least < greatest) & (greatest >= threshold))
        for i in open_[np.argsort(-greatest[open_], kind="stable")]:
            needed = top[1][0] if len(top) == 2 else threshold
            if greatest[i] < needed:
                break
            score = weighted_ratio(name, self.names[i], needed)
            if score >= needed:
                top = sorted([*top, (score, int(i))], key=lambda x: (-x[0], x[1]))[:2]
        return top
