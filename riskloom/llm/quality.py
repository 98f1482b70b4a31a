"""Quality of documents by co-training a text view and a metadata view.

The text view sees hashed words and beginnings of words (each once per document) and style measures of the whole text; the metadata view sees
source, language and length class. Both are logistic regressions fitted on a sample of at most ``SAMPLE_ROWS`` labelled
rows. Over ``ROUNDS`` rounds each view labels the rows of an unlabelled pool (also at most SAMPLE_ROWS) about which it is
most confident, and the other view learns from them. On labelled rows kept apart, both views are calibrated and combined
by a logistic regression of their logits. The sample only fits the weights; every document is scored on its whole text.

A document is good if its quality is 1 and it is not toxic; it is kept from ``KEEP`` on. Labels without quality are not
used, several labels of one document are averaged. Without labels of both kinds every score is the share of good
labels (1 without any labels). Null texts are empty, null metadata is a value of its own, repeated rows get equal
scores, an empty table gives an empty result. Other columns are only carried by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ALNUM, SPACE, arrow_map, give_back, pieces, prefix_hashes, span_hashes, words_of

SAMPLE_ROWS = 6000
#: Bound of labelled and other rows together; some room, so that chance alone never makes it choose among rows.
POOLED_ROWS = SAMPLE_ROWS * 11 // 5
WORD_BUCKETS = 1 << 20
#: Bytes of the beginnings of words that count as features beside the words.
PREFIXES = (3, 5)
#: How far from chance a word bucket must be on the fitted labels to take part.
LEAST_Z, LEAST_ROWS = 4.0, 4
STYLES = 10
META_BUCKETS = 1 << 10
ROUNDS = 3
#: Share of the pool that a view may label in a round, and how sure it must be.
SHARE, CONFIDENT = 0.1, 0.95
KEEP = 0.5

_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), list(range(*r))) for r in ((65, 91), (97, 123), (48, 58)))
_SYMBOL = ~(ALNUM | SPACE)


def text_view(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) pairs of words and their beginnings, each once, and a matrix of style measures."""
    raw = [t.encode() for t in texts]
    lowered, start, end, which, words = words_of([t.lower() for t in raw], ALNUM)
    sums, owner, kinds = prefix_hashes(lowered), [which], [words]
    for length in PREFIXES:
        longer = end - start > length
        owner.append(which[longer])
        kinds.append(span_hashes(sums, start[longer], start[longer] + length) ^ np.uint64(length))
    bucket = (np.concatenate(kinds) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    pairs = np.unique(np.concatenate(owner).astype(np.int64) * WORD_BUCKETS + bucket)
    n = len(raw)
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])[:-1]])

    def share(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask[data].astype(np.int32), begin) if n else np.zeros(0)

    size = np.array([len(t) + 1 for t in raw], float)
    count = np.bincount(which, minlength=n).astype(float)
    distinct = np.bincount(pairs // WORD_BUCKETS, minlength=n)
    letters = np.bincount(which, weights=(end - start), minlength=n)
    upper, lower = share(_UPPER), share(_LOWER)
    only = [share(np.arange(256) == ord(c)) for c in "!|\n"]
    style = np.stack([
        upper / (upper + lower + 1), share(_SYMBOL) / size, share(_DIGIT) / size, only[0] / size, only[1] / size,
        only[2] / size, letters / (count + 1), distinct / (count + 1), np.log1p(count), share(_SYMBOL) / (count + 1),
    ], axis=1) if n else np.zeros((0, STYLES))
    return pairs // WORD_BUCKETS, pairs % WORD_BUCKETS, style


def meta_view(sources: list, langs: list, sizes: list) -> np.ndarray:
    """Four buckets per row: source, language, class of length, source with language."""
    import zlib

    def bucket(*value: object) -> int:
        return zlib.crc32(repr(value).encode()) % META_BUCKETS

    return np.array([
        (bucket(0, s), bucket(1, g), bucket(2, None if n is None else int(2 * np.log2(1 + max(n, 0)))), bucket(3, s, g))
        for s, g, n in zip(sources, langs, sizes)
    ], np.int64).reshape(-1, 4)


def logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, dim: int, y: np.ndarray, weight: np.ndarray,
             steps: int = 200, ridge: float = 1e-5) -> np.ndarray:
    """Weights (last: intercept) of a weighted logistic regression over sparse rows, by adaptive gradient steps."""
    w, speed = np.zeros(dim + 1), np.zeros(dim + 1)
    total = max(weight.sum(), 1e-9)
    for _ in range(steps):
        z = np.bincount(rows, weights=values * w[cols], minlength=len(y)) + w[dim]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / total
        slope = np.concatenate([np.bincount(cols, weights=values * error[rows], minlength=dim), [error.sum()]])
        slope[:dim] += ridge * w[:dim]
        speed += slope * slope
        w -= 0.3 * slope / np.sqrt(speed + 1e-12)
    return w


@dataclass
class Model:
    text: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    meta: np.ndarray
    mix: np.ndarray  # weight of the text logit, of the metadata logit, intercept
    prior: float | None = None  # set if there is nothing to learn from

    def logits(self, rows: np.ndarray, words: np.ndarray, style: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.bincount(rows, weights=self.text[words], minlength=len(style))
        text += ((style - self.centre) / self.scale).clip(-5, 5) @ self.text[WORD_BUCKETS : WORD_BUCKETS + STYLES] + self.text[-1]
        return text, self.meta[meta].sum(1) + self.meta[-1]

    def score(self, texts: list[str], sources: list, langs: list, sizes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.prior is not None:
            return (np.full(len(texts), self.prior),) * 3
        text, meta = self.logits(*text_view(texts), meta_view(sources, langs, sizes))
        squash = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return squash(text), squash(meta), squash(self.mix[0] * text + self.mix[1] * meta + self.mix[2])


def telling_words(rows: np.ndarray, words: np.ndarray, label: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    """Word buckets whose share among good and bad fitted rows differs by more than chance."""
    bad = fitted & (label < 0.5)
    seen = [np.bincount(words[mask[rows]], minlength=WORD_BUCKETS) for mask in (bad, fitted & ~bad)]
    sizes = [max(int(bad.sum()), 1), max(int((fitted & ~bad).sum()), 1)]
    share = (seen[0] + seen[1]) / sum(sizes)
    spread = np.sqrt(share * (1 - share) * (1 / sizes[0] + 1 / sizes[1])) + 1e-12
    z = np.abs(seen[0] / sizes[0] - seen[1] / sizes[1]) / spread
    return np.flatnonzero((z >= LEAST_Z) & (seen[0] + seen[1] >= LEAST_ROWS))


def _entries(rows: np.ndarray, words: np.ndarray, style: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(style)
    return (
        np.concatenate([rows, np.repeat(np.arange(n), STYLES)]),
        np.concatenate([words, np.tile(np.arange(first, first + STYLES), n)]),
        np.concatenate([np.ones(len(rows)), style.ravel()]),
    )


def co_train(rows: np.ndarray, words: np.ndarray, style: np.ndarray, meta: np.ndarray, label: np.ndarray) -> Model:
    """``label`` is the share of good labels, or NaN for the pool."""
    known = ~np.isnan(label)
    good = float(label[known].mean()) if known.any() else 1.0
    empty = Model(np.zeros(WORD_BUCKETS + STYLES + 1), np.zeros(STYLES), np.ones(STYLES), np.zeros(META_BUCKETS + 1), np.zeros(3))
    if known.sum() < 20 or good in (0.0, 1.0):
        empty.prior = good
        return empty
    centre, scale = style.mean(0), style.std(0) + 1e-6
    apart = known & (np.arange(len(label)) % 5 == 0)
    chosen = telling_words(rows, words, label, known & ~apart)
    place = np.full(WORD_BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    used = place[words] >= 0
    text = _entries(rows[used], place[words[used]], ((style - centre) / scale).clip(-5, 5), len(chosen))
    side = (np.repeat(np.arange(len(meta)), 4), meta.ravel(), np.ones(meta.size))
    weights = [(known & ~apart).astype(float) for _ in range(2)]
    targets = [np.where(known, label, 0.0) for _ in range(2)]
    views = [(text, len(chosen) + STYLES), (side, META_BUCKETS)]
    models: list[np.ndarray] = []
    for turn in range(ROUNDS + 1):
        models = [logistic(*view, dim, y, w) for (view, dim), y, w in zip(views, targets, weights)]
        if turn == ROUNDS:
            break
        for me, other in ((0, 1), (1, 0)):
            (r, c, v), dim = views[me]
            z = np.bincount(r, weights=v * models[me][c], minlength=len(label)) + models[me][dim]
            p = 1 / (1 + np.exp(-z.clip(-30, 30)))
            sure = np.maximum(p, 1 - p)
            free = np.flatnonzero(~known & (weights[other] == 0) & (sure >= CONFIDENT))
            surest = free[np.argsort(-sure[free], kind="stable")][: int(SHARE * (~known).sum())]
            weights[other][surest] = 0.5
            targets[other][surest] = (p[surest] > 0.5).astype(float)
    whole = np.zeros(WORD_BUCKETS + STYLES + 1)
    whole[chosen], whole[WORD_BUCKETS:] = models[0][: len(chosen)], models[0][len(chosen) :]
    out = Model(whole, centre, scale, models[1], np.zeros(3))
    logits = np.stack(out.logits(rows, words, style, meta), axis=1)[apart]
    n = len(logits)
    mix = logistic(np.repeat(np.arange(n), 2), np.tile([0, 1], n), logits.ravel(), 2, label[apart], np.ones(n), 400, 1e-3)
    out.mix = np.array([max(mix[0], 0.0), max(mix[1], 0.0), mix[2]])
    if not out.mix[:2].any():
        out.mix = np.array([1.0, 0.0, 0.0])
    return out


COLUMNS = ("doc_id", "text", "source", "lang", "n_chars")


def _inputs(docs: DataFrame) -> DataFrame:
    kinds = dict(zip(COLUMNS, ("long", "string", "string", "string", "long")))
    return docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from bounded samples; which rows are drawn depends on a hash of the id alone."""
    rank = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30))
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(labels.count(), 1))
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).cast("double")
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), good.alias("good")
    ).where(rank < int(share * (1 << 30)) + 1).groupBy("doc_id").agg(F.avg("good").alias("good")).orderBy(rank, "doc_id").limit(SAMPLE_ROWS)
    pool = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    rows = _inputs(docs).join(F.broadcast(chosen), "doc_id", "left").where(
        F.col("good").isNotNull() | (rank < int(pool * (1 << 30)) + 1)
    ).select(*COLUMNS, "good").limit(POOLED_ROWS)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, sources, langs, sizes, good in pieces(batches, 1):
            r, words, style = text_view(texts)
            cuts = np.searchsorted(r, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays([
                pa.array([words[a:b].tolist() for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int32())),
                pa.array(style.tolist(), pa.list_(pa.float64())),
                pa.array(meta_view(sources, langs, sizes).tolist(), pa.list_(pa.int32())), pa.array(good, pa.float64()),
            ], ["words", "style", "meta", "good"])

    table = arrow_map(rows, features, "words array<int>, style array<double>, meta array<int>, good double").toArrow()
    lists = table.column("words").combine_chunks()
    words = np.asarray(lists.flatten(), np.int32)
    sizes = np.asarray(lists.value_lengths(), np.int64) if len(lists) else np.zeros(0, np.int64)
    label = np.array([np.nan if x is None else x for x in table.column("good").to_pylist()], float)
    style = np.array(table.column("style").to_pylist(), float).reshape(-1, STYLES)
    meta = np.array(table.column("meta").to_pylist(), np.int64).reshape(-1, 4)
    # rows come in any order: sort them, so that a fit can be repeated
    content = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=words, minlength=len(sizes))
    order = np.lexsort((label, *meta.T, content, *style.T)) if len(style) else np.zeros(0, np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rows_of = place[np.repeat(np.arange(len(sizes)), sizes)]
    by_row = np.argsort(rows_of, kind="stable").astype(np.int32)
    rows_of, words = rows_of[by_row].astype(np.int32), words[by_row]
    del table, lists, by_row
    give_back()
    return co_train(rows_of, words, style[order], meta[order], label[order])


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score (probability that the document is good) and keep, of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, sources, langs, sizes in pieces(batches, 1):
            scores = model.value.score(texts, sources, langs, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *map(pa.array, scores), pa.array(scores[2] >= KEEP)],
                ["doc_id", "text_score", "meta_score", "score", "keep"],
            )

    return arrow_map(_inputs(docs), run, "doc_id long, text_score double, meta_score double, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    names = [c for c in COLUMNS if c in docs.columns]
    places = [docs.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            part = batch.select(places)
            for columns in pieces([part], names.index("text")):
                of = dict(zip(names, columns))
                none = [None] * len(of["text"])
                scores = model.value.score(of["text"], of.get("source", none), of.get("lang", none), of.get("n_chars", none))
                keep += (scores[2] >= KEEP).tolist()
            yield batch.filter(pa.array(keep, pa.bool_()))

    return arrow_map(docs, run, docs.schema)  # type: ignore[arg-type]
