"""Scores of documents by a hidden Markov language model.

Training rows are those whose crc32 of the id as text, modulo 5, is not 1. Word counts are summed in every task before
they are shuffled. The ``HEAD`` commonest words, a fixed bound, travel to the tasks; all other words meet their counts in
a join, one row per token, by a 64-bit hash of the word.

The model has ``STATES`` hidden states. They emit the ``SYMBOLS`` commonest words, the end of the text, or the class of
all other words; within that class a word has its smoothed share of the class's counts. Baum-Welch starts from the
unigram distribution, disturbed per state, and sums the expected counts of all training rows over partitions
(one aggregation of SYMBOLS + STATES + 2 rows per round). There sequences of more than ``SEGMENT`` tokens count as several.
The score is the exact likelihood of the whole sequence by the scaled forward recursion.

Null texts are empty: one token, the end. Rows without doc_id count as id '' and are trained on. Repeated rows are
counted and scored each; ties among words of equal count go by hash; an empty table gives an empty result. Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, arrow_map, free_shuffles, pieces, words_of
from riskloom.session import stored

HEAD = 1 << 17
SYMBOLS = 8190
STATES = 6
ROUNDS = 3
SEGMENT = 512
#: Padded cells of a batch of sequences.
CELLS = 1 << 18
#: Different words a task holds before it hands on its counts.
COUNTED = 2_000_000
END = 0  # symbol of the end; 1.. are words, the last the class of all others


@dataclass
class Vocabulary:
    hashes: np.ndarray  # sorted hashes of the head words
    counts: np.ndarray
    symbols: np.ndarray  # symbol of each head word
    size: int  # number of symbols
    tokens: int  # N
    distinct: int  # V
    ends: int  # training rows
    rest_tokens: int
    rest_distinct: int

    @property
    def base_log(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.distinct + 1))

    @property
    def rest_log(self) -> float:
        return math.log10(self.rest_tokens + 0.5 * (self.rest_distinct + 1))


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


def _rows(docs: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.crc32(key.cast("binary")) % 5 == 1).alias("held_out"),
    )


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    _, _, _, which, words = words_of([t.encode().lower() for t in texts], SPACE_FREE)
    return which, words


SPACE_FREE = ~SPACE


def word_counts(rows: DataFrame) -> DataFrame:
    """(h long, c long) of all words of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = merged = 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            words, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(place, weights=np.concatenate([c for _, c in held])).astype(np.int64)

        def batch(words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(words), 100_000):
                part = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(words[part].view(np.int64)), pa.array(counts[part])], ["h", "c"])

        for (texts,) in pieces(batches, 0):
            words, counts = np.unique(_hashes(texts)[1], return_counts=True)
            held.append((words, counts))
            size += len(words)
            if size > 2 * merged + COUNTED // 2:
                held = [merge()]
                size = merged = len(held[0][0])
                if merged > COUNTED:
                    yield from batch(*held[0])
                    held, size, merged = [], 0, 0
        if held:
            yield from batch(*merge())

    return arrow_map(rows.select("text"), run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, training_rows: int) -> Vocabulary:
    """The head words, found by a histogram of counts, and the totals."""
    step = F.floor(F.log2("c") * 16)
    steps = sorted(
        ((r.step, r.words, r.tokens) for r in counts.groupBy(step.alias("step")).agg(
            F.count("*").alias("words"), F.sum("c").alias("tokens")).collect()), reverse=True)
    least, words = None, 0
    for at, n, _ in steps:
        if words + n > HEAD:
            break
        least, words = at, words + n
    head = counts.where(step >= least).toArrow() if least is not None else None
    hashes = head.column("h").to_numpy().view(np.uint64) if head else np.zeros(0, np.uint64)
    values = head.column("c").to_numpy().astype(np.int64) if head else np.zeros(0, np.int64)
    order = np.lexsort((hashes, -values))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    symbols = np.where(rank < SYMBOLS, rank + 1, min(SYMBOLS, len(order)) + 1)
    size = min(SYMBOLS, len(order)) + 2
    by_hash = np.argsort(hashes)
    tokens, distinct = sum(t for _, _, t in steps), sum(n for _, n, _ in steps)
    own = values[rank < SYMBOLS]
    return Vocabulary(
        hashes[by_hash], values[by_hash], symbols[by_hash].astype(np.uint16), size, tokens + training_rows,
        distinct + bool(training_rows), training_rows, tokens - int(own.sum()), distinct - len(own),
    )


CODED = (
    "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, n_rest long, rest_log double,"
    " codes binary, tail array<long>"
)


def coded(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Every row as a sequence of symbols, with the words whose counts are not known yet."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, rid = shared.value, TaskContext.get().partitionId() << 36
        logs = np.log10(v.counts + 0.5)
        end_log = math.log10(v.ends + 0.5)
        for ids, texts, held in pieces(batches, 1):
            which, words = _hashes(texts)
            place = np.searchsorted(v.hashes, words)
            known = np.zeros(len(words), bool)
            inside = place < len(v.hashes)
            known[inside] = v.hashes[place[inside]] == words[inside]
            symbol = np.full(len(words), v.size - 1, np.uint16)
            symbol[known] = v.symbols[place[known]]
            log = np.zeros(len(words))
            log[known] = logs[place[known]]
            n = len(texts)
            rest = symbol == v.size - 1
            sums = [np.bincount(which, weights=w, minlength=n).astype(float) for w in (known, log, rest, log * rest)]
            cuts = np.searchsorted(which, np.arange(n + 1))
            tails = np.flatnonzero(~known)
            tail_cuts = np.searchsorted(which[tails], np.arange(n + 1)).astype(np.int32)
            codes = [symbol[a:b].tobytes() + b"\0\0" for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(rid, rid + n)), pa.array(ids, pa.int64()), pa.array(held, pa.bool_()),
                pa.array(np.diff(cuts) + 1), pa.array(sums[0].astype(np.int64) + (v.ends > 0)), pa.array(sums[1] + end_log),
                pa.array(sums[2].astype(np.int64)), pa.array(sums[3]), pa.array(codes, pa.binary()),
                pa.ListArray.from_arrays(pa.array(tail_cuts), pa.array(words[tails].view(np.int64))),
            ], [c.split()[0] for c in CODED.split(", ")])
            rid += n

    return arrow_map(rows.select("doc_id", "text", "held_out"), run, CODED)


def padded(sequences: list[np.ndarray], pad: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the sequences, matrix time x sequence) in batches of sequences of similar length."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]])
        mine = order[at : at + max(1, CELLS // longest)]
        out = np.full((len(mine), longest), pad, np.int64)
        out[np.arange(longest)[None, :] < lengths[mine][:, None]] = np.concatenate([sequences[i] for i in mine])
        yield mine, np.ascontiguousarray(out.T)
        at += len(mine)


def _emissions(model: Model) -> np.ndarray:
    """With a last row for padding, which every state emits surely and so changes no likelihood."""
    return np.vstack([model.emit, np.ones(model.emit.shape[1])])


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural logarithm of the probability of each sequence."""
    out = np.zeros(len(sequences))
    emit = _emissions(model)
    for mine, x in padded(sequences, len(model.emit)):
        a = model.start * emit[x[0]]
        scale = a.sum(1)
        total = np.log(scale)
        a /= scale[:, None]
        for t in range(1, len(x)):
            a = (a @ model.move) * emit[x[t]]
            scale = a.sum(1)
            a /= scale[:, None]
            total += np.log(scale)
        out[mine] = total
    return out


def expected_counts(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Rows: symbols, then states (moves from them), then the start, then the log-likelihood in the first column."""
    size, k = model.emit.shape
    emit = _emissions(model)
    out = np.zeros((size + k + 2, k))
    for _, x in padded(sequences, size):
        steps, n = x.shape
        e = emit[x]
        a, b, scale = np.empty((steps, n, k)), np.ones((steps, n, k)), np.empty((steps, n, 1))
        for t in range(steps):
            now = (model.start if t == 0 else a[t - 1] @ model.move) * e[t]
            scale[t] = now.sum(1, keepdims=True)
            a[t] = now / scale[t]
        e /= scale
        for t in range(steps - 2, -1, -1):
            b[t] = (b[t + 1] * e[t + 1]) @ model.move.T
        real = x < size
        gamma = (a * b * real[:, :, None]).reshape(-1, k)
        for s in range(k):
            out[:size, s] += np.bincount(x.ravel(), weights=gamma[:, s], minlength=size + 1)[:size]
        after = (b[1:] * e[1:] * real[1:, :, None]).reshape(-1, k)
        out[size : size + k] += (a[:-1].reshape(-1, k).T @ after) * model.move
        out[size + k] += (a[0] * b[0]).sum(0)
        out[size + k + 1, 0] += np.log(scale[:, :, 0]).sum()
    return out


def _sequences(batches: Iterator[pa.RecordBatch], tokens: int = 1 << 21) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(rows of the other columns, sequences) of about that many tokens."""
    rows: list = []
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for *other, codes in zip(*[c.to_pylist() for c in batch.columns]):
            rows.append(other)
            held.append(np.frombuffer(codes, np.uint16))
            size += len(held[-1])
            if size >= tokens:
                yield rows, held
                rows, held, size = [], [], 0
    if held:
        yield rows, held


def initial(share: np.ndarray, states: int, seed: int = 7) -> Model:
    noise = np.random.default_rng(seed).gamma(2.0, size=(len(share), states))
    emit = share[:, None] * noise
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def improved(counts: np.ndarray, share: np.ndarray) -> Model:
    """Model from expected counts; the unigram shares and a uniform distribution smooth it."""
    k = counts.shape[1]
    size = len(counts) - k - 2
    emit = counts[:size] + 2.0 * share[:, None] * size / 8
    move = counts[size : size + k] + 1.0
    start = counts[size + k] + 1.0
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def baum_welch(sequences: DataFrame, share: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Train on a frame with a binary column ``codes``; returns the model and the log-likelihood before each round."""
    spark = sequences.sparkSession
    columns = [f"s{k}" for k in range(states)]
    schema = "i int, " + ", ".join(f"{c} double" for c in columns)
    model, likelihoods = initial(share, states), []
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            total = None
            for _, held in _sequences(batches):
                cut = [s[k : k + SEGMENT] for s in held for k in range(0, len(s), SEGMENT)]
                counts = expected_counts(cut, shared.value)
                total = counts if total is None else total + counts
            if total is not None:
                used = np.flatnonzero(total.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), *[pa.array(c) for c in total[used].T]], ["i", *columns])

        sums = arrow_map(sequences.select("codes"), run, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in columns])
        counts = np.zeros((len(share) + states + 2, states))
        for row in sums.collect():
            counts[row[0]] = row[1:]
        likelihoods.append(float(counts[-1, 0]))
        model = improved(counts, share)
    return model, likelihoods


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    rows = _rows(docs)
    training = rows.where(~F.col("held_out"))
    counts = stored(word_counts(training), "word-counts")
    vocab = vocabulary(counts, training.count())
    table = stored(coded(rows, vocab), "coded")
    free_shuffles(spark)

    share = np.zeros(vocab.size)
    share[END] = vocab.ends
    np.add.at(share, vocab.symbols, vocab.counts)
    share[-1] = vocab.rest_tokens
    share = (share + 0.5) / (share + 0.5).sum()
    model, _ = baum_welch(table.where(~F.col("held_out")), share)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in _sequences(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for (i,) in ids]), pa.array(log_likelihoods(held, shared.value) / math.log(10))], ["rid", "forward"])

    forward = arrow_map(table.select("rid", "codes"), run, "rid long, forward double")
    tails = table.select("rid", F.explode("tail").alias("h")).join(counts, "h", "left").groupBy("rid").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"), F.count("c").alias("tail_known"))
    tail_log, tail_known = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("tail_known", F.lit(0))
    return table.drop("codes", "tail").join(forward, "rid").join(tails, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + tail_known).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") + tail_log - F.col("n_tokens") * vocab.base_log).alias("base_score"),
        (F.col("forward") + F.col("rest_log") + tail_log - F.col("n_rest") * vocab.rest_log).alias("score"),
    )
