"""Packing token sequences: bounded-space online best-fit.

Every task packs its own rows in the order in which they come. It keeps a fixed number of open bins; a bitset, keyed by
free space, tells in one step which open bin is left with the least space by the next piece. When all bins are open
and none fits, the fullest closes and a new one opens. Texts longer than a sequence are cut, full pieces fill a
sequence alone. Memory of a task is bounded by the open bins with the rows in them, and by the word cache.

What is in bins still open at the end of a task is packed once more: these pieces are dealt to as few tasks as keep them
small and come in order of length, longest first, so that the number of sequences hardly depends on the number of tasks.

A null text is empty and still has its end token; repeated rows are packed each; ties between open bins go to the one
filled last; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_map, pieces
from riskloom.session import stored

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Different words whose ids a worker remembers for sure; words not met for that many others are forgotten.
CACHE_WORDS = 600_000
#: Pieces from open bins that one task packs again.
LEFT_OVER = 250_000
#: Numbers of sequences made by the second pass begin here.
SECOND = 1 << 62
#: ASCII signs between a letter and white space, which are a token of their own. Those that begin with an apostrophe stay,
#: since it may belong to the letters behind it.
ENDING = re.compile(r"(?<=[a-z\u00df-\u00f6\u00f8-\u00ff])([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)(?![^ \t\n\r])")
END = bytes(4)


class BestFit:
    """Open bins of one task. ``place`` returns (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.limit = capacity, open_bins
        self.bits = 0  # bit f is set if an open bin has f free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0
        #: Bins that the last call of ``place`` has closed.
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return found

    def _put(self, free: int, which: int) -> None:
        if free:
            self.by_free[free].append(which)
            self.bits |= 1 << free
        else:
            self.open -= 1
            self.closed.append(which)

    def place(self, size: int) -> tuple[int, int]:
        self.closed = []
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            which = self._take(free)
        else:
            if self.open == self.limit:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
                self.open -= 1
            which, free = self.made, self.capacity
            self.made += 1
            self.open += 1
        self._put(free - size, which)
        return which, self.capacity - free


class WordIds:
    """Ids of texts by a lower-casing tokenizer whose tokens never cross white space or join letters with signs.

    Each different word is encoded once in a worker.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Tokens that stand for themselves wherever they occur; a text with one of them is encoded whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # ids as little-endian bytes: the words met last, and those met before them
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        known, before = self.known, self.before
        new = []
        for word in words.difference(known):
            if (ids := before.get(word)) is None:
                new.append(word)
            else:
                known[word] = ids
        for k in range(0, len(new), 1000):
            part = new[k : k + 1000]
            for word, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[word] = array("I", e.ids).tobytes()

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > CACHE_WORDS:
            self.before, self.known = self.known, {"": b""}
        # the two letters whose lower case depends on the library stay as they are
        lowered = [t if "\u0130" in t or "\u03a3" in t else t.lower() for t in texts]
        whole = [any(a in text or a in low for a in self.added) for text, low in zip(texts, lowered)]
        split = [[] if w else ENDING.sub(r" \1", t).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                 for t, w in zip(lowered, whole)]
        self._learn(set().union(*split))
        for text, words, one in zip(texts, split, whole):
            ids = [array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()] if one else map(self.known.__getitem__, words)
            yield np.frombuffer(b"".join([*ids, END]), "<u4")


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The encoder of this worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


#: What a task knows of a piece: the columns of SCHEMA and whether its bin was still open at the end.
PLACED = SCHEMA + ", open boolean"
Row = tuple[int, int, int, int, int]


def _place(pieces_in: Iterator[Row], capacity: int, open_bins: int, first: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``PLACED``; a bin's rows wait until it closes."""
    bins = BestFit(capacity, open_bins)
    waiting: dict[int, list[tuple]] = {}
    rows: list[tuple] = []
    for row in pieces_in:
        which, offset = bins.place(row[3])
        waiting.setdefault(which, []).append((*row, first + which, offset, False))
        for done in bins.closed:
            rows += waiting.pop(done)
        if len(rows) > 50_000:
            yield _batch(rows)
            rows = []
    yield _batch(rows + [(*r[:-1], True) for held in waiting.values() for r in held])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in PLACED.split(", ")])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, open_bins: int = 512) -> DataFrame:
    """One row per piece of every document, see ``SCHEMA``. sequence_id is unique over all tasks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        encode = encoder(tokenizer_path)
        for ids, texts in pieces(batches, 1):
            for doc_id, tokens in zip(ids, encode(texts)):
                for piece, start in enumerate(range(0, len(tokens), capacity)):
                    part = tokens[start : start + capacity]
                    yield doc_id, piece, start, len(part), zlib.crc32(part.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return _place(cut(batches), capacity, open_bins, TaskContext.get().partitionId() << 36)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        return _place(rows, capacity, open_bins, SECOND + (TaskContext.get().partitionId() << 36))

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    placed = stored(arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PLACED), "placed")
    left = placed.where("open")
    tasks = max(1, -(-left.count() // LEFT_OVER))
    dealt = left.repartition(tasks, F.xxhash64("sequence_id", "offset")).sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    second = arrow_map(dealt.select(*names[:5]), again, PLACED)
    return placed.where("not open").select(*names).unionAll(second.select(*names))
