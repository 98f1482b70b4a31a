"""Licence scan by a positional index of rare words.

The index holds, per licence notice (template), its words with their places. A word's weight is its inverse document
frequency among the templates, so a text gets the same result in every table. Of a template only the rarest words are
indexed: so many that whatever lacks all of them cannot reach ``LEAST_COVER`` of the template's weight (prefix filter;
nothing is lost). A file's words are looked up from these; each hit proposes places of the template in the file, and the postings of a template are intersected by that relative place: a proposal counts the weight of all template words
that stand where the template has them, give or take ``SLACK`` words. What covers enough is verified: every mandatory
phrase of the template must stand word for word within the place. All hits of all files are followed, however many.

Three phrases are looked up as they are (base); they are templates too, so the method finds them again.

Null text is empty and has no words; repeated rows give repeated results; an empty table gives an empty result. Columns
other than doc_id and text are not read. Work and memory go by the words of a piece of text and the hits of a text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ALNUM, arrow_map, pieces, words_of

# Phrases that are always reported.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Opening words of public licence notices, with the phrases that must stand in them word for word.
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction",
     ("permission is hereby granted", "free of charge")),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     ("apache license version 2",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either"
     " version 3 of the license or at your option any later version", ("gnu general public license", "version 3")),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either"
     " version 2 of the license or at your option any later version", ("gnu general public license", "version 2")),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2 1", ("gnu lesser general public license", "version 2 1")),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("bsd", "released under the bsd 3 clause license", ("bsd 3 clause",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify", "with or without fee")),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial",)),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
#: Share of a template's weight that must be in place, in thousandths, and words by which one may be out of place.
LEAST_COVER = 600
SLACK = 2
#: Cells of the table of places and template words that is looked at in one go.
CELLS = 1 << 20


class Index:
    """Templates as word numbers, weights, rare postings and phrases."""

    def __init__(self, notices: tuple = NOTICES, base: tuple = BASE) -> None:
        templates = [*((label, phrase.split(), [phrase.split()]) for phrase, label in base),
                     *((label, text.split(), [p.split() for p in phrases]) for label, text, phrases in notices)]
        seen = Counter(w for _, words, _ in templates for w in set(words))
        self.words = sorted(seen)
        self.number = {w: k for k, w in enumerate(self.words)}
        # whole numbers, so that sums do not depend on their order
        self.weight = np.array([round(1000 * math.log(1 + len(templates) / seen[w])) for w in self.words], np.int64)
        self.labels = [label for label, _, _ in templates]
        self.templates = [self.numbers(words) for _, words, _ in templates]
        self.phrases = [[self.numbers(p) for p in phrases] for _, _, phrases in templates]
        self.base = [(self.numbers(phrase.split()), label) for phrase, label in base]
        #: (template, place, word) of the rare words
        self.postings = [(t, q, int(words[q])) for t, words in enumerate(self.templates) for q in self._rare(words)]
        raw = [w.encode() for w in self.words]
        self.raw = raw
        _, _, _, _, hashes = words_of(raw, ALNUM)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.array([self.number[w] for w in words], np.int64)

    def _rare(self, words: np.ndarray) -> list[int]:
        """Places of the rarest words: without any of them the rest weighs less than the bar."""
        weights = self.weight[words]
        rest, out = int(weights.sum()), []
        bar = rest * LEAST_COVER
        # all places of a word enter together
        for word in sorted(set(words.tolist()), key=lambda w: (-self.weight[w], w)):
            if rest * 1000 < bar:
                break
            places = np.flatnonzero(words == word)
            out += places.tolist()
            rest -= int(weights[places].sum())
        return out


class Piece:
    """Words of some texts as numbers of the index (-1 for others), and where each text begins."""

    def __init__(self, index: Index, texts: list[str]) -> None:
        data, start, end, doc, hashes = words_of([t.encode().lower() for t in texts], ALNUM)
        blob = data.tobytes()
        at = np.minimum(np.searchsorted(index.hashes, hashes), len(index.hashes) - 1)
        number = np.where(index.hashes[at] == hashes, index.order[at], -1)
        hits = np.flatnonzero(number >= 0)
        known = index.raw
        for k, s, e, n in zip(hits.tolist(), start[hits].tolist(), end[hits].tolist(), number[hits].tolist()):
            if blob[s:e] != known[n]:
                number[k] = -1
        hits = hits[number[hits] >= 0]
        self.number, self.doc = number, doc
        self.bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        by_word = hits[np.argsort(number[hits], kind="stable")]
        cuts = np.searchsorted(number[by_word], np.arange(len(known) + 1))
        self.places = [by_word[a:b] for a, b in zip(cuts, cuts[1:])]
        self._found: dict[bytes, np.ndarray] = {}

    def phrase(self, words: np.ndarray) -> np.ndarray:
        """Places where the words stand one after another within a text, ascending."""
        key = words.tobytes()
        if key not in self._found:
            rarest = min(range(len(words)), key=lambda q: len(self.places[words[q]]))
            first = self.places[words[rarest]] - rarest
            first = first[(first >= 0) & (first + len(words) <= len(self.number))]
            for q, word in enumerate(words.tolist()):
                first = first[self.number[first + q] == word]
            self._found[key] = first[self.doc[first] == self.doc[first + len(words) - 1]]
        return self._found[key]


def placed(index: Index, piece: Piece) -> Iterator[tuple[int, int, int, int]]:
    """(text, template, place, weight in place) of every verified place of a template; the place is a word of the piece."""
    proposals: dict[int, list[np.ndarray]] = {}
    for t, q, word in index.postings:
        if len(hits := piece.places[word]):
            # the word that gives the place away may itself be out of place
            at = (hits - q + np.arange(-SLACK, SLACK + 1)[:, None]).ravel()
            proposals.setdefault(t, []).append(np.stack([np.tile(piece.doc[hits], 2 * SLACK + 1), at]))
    for t, found in proposals.items():
        words = index.templates[t]
        weights, size = index.weight[words], len(words)
        bar = int(weights.sum()) * LEAST_COVER
        every = np.unique(np.concatenate(found, axis=1), axis=1)
        step = max(1, CELLS // size)
        for k in range(0, every.shape[1], step):
            doc, place = every[:, k : k + step]
            low, high = piece.bounds[doc], piece.bounds[doc + 1]
            in_place = np.zeros((len(doc), size), bool)
            for shift in range(-SLACK, SLACK + 1):
                at = place[:, None] + np.arange(size) + shift
                inside = (at >= low[:, None]) & (at < high[:, None])
                in_place |= inside & (piece.number[np.where(inside, at, 0)] == words)
            weight = in_place @ weights
            good = weight * 1000 >= bar
            for phrase in index.phrases[t]:
                where = piece.phrase(phrase)
                from_, to = np.maximum(place - SLACK, low), np.minimum(place + size + SLACK, high) - len(phrase)
                good &= np.searchsorted(where, to, side="right") > np.searchsorted(where, from_)
            for i in np.flatnonzero(good).tolist():
                yield int(doc[i]), t, int(place[i]), int(weight[i])


_INDEX: list[Index] = []


def the_index() -> Index:
    """The index of this process."""
    if not _INDEX:
        _INDEX.append(Index())
    return _INDEX[0]


SCHEMA = ("doc_id long, n_words long, base array<struct<start:bigint,label:string>>,"
          " found array<struct<start:bigint,label:string,score:double>>")


def find_licences(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, base (places of the base phrases), found (verified places of notices).

    A place is the number of a word of the text, from 0 (a notice whose beginning is missing may begin before it); the
    score of a place is the share of the notice's weight that is in place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = the_index()
        total = [int(index.weight[words].sum()) for words in index.templates]
        for ids, texts in pieces(batches, 1):
            piece = Piece(index, texts)
            low = piece.bounds.tolist()
            base: list[list] = [[] for _ in texts]
            found: list[list] = [[] for _ in texts]
            for words, label in index.base:
                at = piece.phrase(words)
                for doc, place in zip(piece.doc[at].tolist(), at.tolist()):
                    base[doc].append({"start": place - low[doc], "label": label})
            for doc, t, place, weight in placed(index, piece):
                found[doc].append({"start": place - low[doc], "label": index.labels[t], "score": weight / total[t]})
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(np.diff(piece.bounds), pa.int64()),
                pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
                pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))),
            ], ["doc_id", "n_words", "base", "found"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def licence_digest(docs: DataFrame) -> DataFrame:
    return find_licences(docs).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        _labels(F.col("base.label")).alias("base_labels"),
        _labels(F.concat("base.label", "found.label")).alias("labels"),
        F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"),
    )
