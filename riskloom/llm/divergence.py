"""Source divergence audit over run-length encoded count columns.

Per language, the terms that occur in enough documents are the vocabulary, and every source is a column of counts over
it. The vocabulary is put in an order that brings terms with equal counts together: by their greatest count, their total
and a signature of the whole row of counts (equal rows of counts have equal signatures, so they stand side by side; two
different rows that share one by accident only make runs shorter). In that order each column is a short list of runs of
equal counts. The divergence of two sources is a sum of f over all terms; f depends on the two counts only, so it is
evaluated once per stretch between two run boundaries of either source and multiplied by the length of the stretch.

The vocabulary of a language is cut into blocks of ``BLOCK`` places and its sources into buckets of about ``BUCKET``; a
task holds the runs of one block and two buckets, whatever the size of a language or a source, and sums meet afterwards.
Zero counts are runs like any other, so sources without a term of a block take part.

Null text, lang and source are ''. A group without terms has zero counts throughout; a language without kept terms has
pairs of value 0 and no terms. Repeated rows are documents of their own. An empty table gives an empty result. Columns
other than text, lang and source are not read. Arithmetic is in whole numbers: 64 bits where that is enough for any
share, more where counts are multiplied.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_map, free_shuffles, pieces, words_of
from riskloom.llm.ordering import numbered
from riskloom.session import stored

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Places of the vocabulary in a block, and sources a bucket holds on average.
BLOCK = 1 << 14
BUCKET = 64
#: Terms of one task that wait for their counts to be sent, at most.
HELD_TERMS = 400_000
#: Letters and every byte of a character beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term; a null term stands for the group itself.

    Words are counted per piece of text by sorting their hashes, and pieces of one group are added up in the task before
    anything is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, list[int]]] = {}
        size = 0
        for langs, sources, texts in pieces(batches, 2):
            raw = [t.encode().lower() for t in texts]
            which: dict[tuple, int] = {}
            group = np.array([which.setdefault((a or "", b or ""), len(which)) for a, b in zip(langs, sources)])
            data, start, end, doc, h = words_of(raw, LETTERS)
            blob, names = data.tobytes(), list(which)
            order = np.lexsort((doc, h, group[doc]))
            g, h, d = group[doc][order], h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(h)))
            fresh = new.copy()
            fresh[1:] |= d[1:] != d[:-1]
            docs_of = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else n
            at = order[first]
            for name in names:
                held.setdefault(name, {})
            for k, s, e, count, in_docs in zip(g[first].tolist(), start[at].tolist(), end[at].tolist(), n.tolist(), docs_of.tolist()):
                terms = held[names[k]]
                seen = terms.get(word := blob[s:e])
                if seen is None:
                    terms[word] = [count, in_docs]
                    size += 1
                else:
                    seen[0] += count
                    seen[1] += in_docs
            if size >= HELD_TERMS:
                yield from _counted(held)
                held, size = {}, 0
        yield from _counted(held)

    def column(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    counted = arrow_map(docs.select(column("lang"), column("source"), column("text")), run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(held: dict[tuple, dict[bytes, list[int]]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), terms in held.items():
        words = [None, *terms]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()),
            pa.array(words, pa.binary()).cast(pa.string()), pa.array([0, *(v[0] for v in terms.values())], pa.int64()),
            pa.array([0, *(v[1] for v in terms.values())], pa.int64()),
        ], ["lang", "source", "term", "n", "docs"])


#: Share of a count in a column with ``total`` occurrences of ``terms`` terms; a decimal, as counts times SCALE leave 64 bits.
SHARE = "1 + (cast({scale} as decimal(10,0)) * cast({n} + 1 as decimal(19,0))) div cast({total} + {terms} as decimal(20,0))"


def share(n: str, total: str, terms: str) -> Column:
    return F.expr(SHARE.format(scale=SCALE, n=n, total=total, terms=terms)).cast("long")


def shares_of(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same as :func:`share` for an array of counts."""
    if len(counts) and (int(counts.max()) + 1) * SCALE >= 1 << 63:
        return np.array([1 + SCALE * (c + 1) // (total + terms) for c in counts.tolist()], np.int64)
    return 1 + SCALE * (counts + 1) // max(total + terms, 1)


def run_lengths(at: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive) and counts of the runs of a column of ``width`` places that is zero but at the places ``at``."""
    column = np.zeros(width, np.int64)
    column[at] = n
    last = np.flatnonzero(np.append(column[1:] != column[:-1], True)) if width else np.zeros(0, np.int64)
    return last + 1, column[last]


def divergences(ends_a: np.ndarray, p: np.ndarray, ends_b: np.ndarray, q: np.ndarray) -> tuple[int, int]:
    """Sums of f(p, q) and f(q, p) over all places: once per stretch between run boundaries, times its length."""
    ends = np.union1d(ends_a, ends_b)
    lengths = np.diff(ends, prepend=0)
    p, q = p[np.searchsorted(ends_a, ends)], q[np.searchsorted(ends_b, ends)]
    square = (p - q) ** 2
    return int((square // q * lengths).sum()), int((square // p * lengths).sum())


class Audit:
    """Counts, vocabulary and groups of all sources, stored; :meth:`columns` and :meth:`pairs` and :meth:`terms` read them."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS) -> None:
        counts = stored(term_counts(docs), "term-counts")
        known = counts.where("term is not null")
        vocabulary = numbered(known.groupBy("lang", "term").agg(
            F.max("n").alias("most"), F.sum("n").alias("total"), F.sum("docs").alias("docs"),
            F.bit_xor(F.xxhash64("source", "n")).alias("signature"),
        ).where(F.col("docs") >= least_docs).drop("docs"), ["lang"], [F.col(c) for c in ("most", "total", "signature", "term")], "vocabulary")
        vocabulary = stored(vocabulary.select("lang", "term", "total", "idx"), "vocabulary-order")
        free_shuffles(docs.sparkSession)
        #: lang, source, term, n, total (in the language), idx (place in the vocabulary)
        self.kept = stored(known.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "total", "idx"), "kept-terms")
        langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_total"))
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
        names = counts.where("term is null").select("lang", "source")
        sizes = names.groupBy("lang").agg(F.ceil(F.count("*") / BUCKET).alias("buckets"))
        #: lang, source, buckets, group_total, terms, lang_total
        self.groups = stored(names.join(sizes, "lang").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(
            0, ["group_total", "terms", "lang_total"]), "groups")
        free_shuffles(docs.sparkSession)

    def columns(self) -> DataFrame:
        """(lang, source, block, buckets, ends, shares): the run-length column of every group and block."""
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(terms - 1, 0) div {BLOCK}"))).alias("block")
        grid = self.groups.select("lang", "source", blocks, "buckets", "group_total", "terms", F.lit(None).cast("struct<at:int,n:bigint>").alias("cell"))
        cells = self.kept.select(
            "lang", "source", F.expr(f"idx div {BLOCK}").alias("block"), *[F.lit(None).cast("long").alias(c) for c in ("buckets", "group_total", "terms")],
            F.struct((F.col("idx") % BLOCK).cast("int").alias("at"), "n").alias("cell"))
        gathered = grid.unionAll(cells).groupBy("lang", "source", "block").agg(
            *[F.max(c).alias(c) for c in ("buckets", "group_total", "terms")], F.collect_list("cell").alias("cells")
        ).select("lang", "source", "block", "buckets", "group_total", "terms", F.col("cells.at").alias("at"), F.col("cells.n").alias("n"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ends, shares = [], []
                block, total, terms = (batch.column(c).to_pylist() for c in ("block", "group_total", "terms"))
                for k in range(batch.num_rows):
                    at, n = (batch.column(c)[k].values.to_numpy() for c in ("at", "n"))
                    stop, counts = run_lengths(at, n, max(min(BLOCK, terms[k] - block[k] * BLOCK), 0))
                    ends.append(stop)
                    shares.append(shares_of(counts, total[k], terms[k]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("lang", "source", "block", "buckets")), pa.array(ends, pa.list_(pa.int64())),
                     pa.array(shares, pa.list_(pa.int64()))], ["lang", "source", "block", "buckets", "ends", "shares"])

        return arrow_map(gathered, run, "lang string, source string, block long, buckets long, ends array<long>, shares array<long>")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of every ordered pair of different sources of a language."""

        def meet(rows: pa.Table) -> pa.Table:
            sources, mine = rows.column("source").to_pylist(), rows.column("bucket").to_pylist()
            ends, shares = ([x.values.to_numpy() for x in rows.column(c)] for c in ("ends", "shares"))
            low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
            out: list[tuple[str, str, int]] = []
            for a, b in itertools.combinations(range(len(sources)), 2):
                if {mine[a], mine[b]} == {low, high}:
                    there, back = divergences(ends[a], shares[a], ends[b], shares[b])
                    out += [(sources[a], sources[b], there), (sources[b], sources[a], back)]
            x, y, value = zip(*out) if out else ((), (), ())
            return pa.table({"lang": pa.array([rows.column("lang")[0].as_py()] * len(out), pa.string()), "source": pa.array(x, pa.string()),
                             "item": pa.array(y, pa.string()), "value": pa.array(value, pa.int64())})

        # the group's two buckets are the same for the pairs of one bucket with itself
        bucket = F.pmod(F.xxhash64("source"), F.col("buckets")).alias("bucket")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("other")
        dealt = self.columns().select("lang", "source", "block", "buckets", bucket, "ends", "shares").select("*", other).select(
            "lang", "block", F.least("bucket", "other").alias("low"), F.greatest("bucket", "other").alias("high"), "source", "bucket", "ends", "shares")
        parts = dealt.groupBy("lang", "block", "low", "high").applyInArrow(meet, "lang string, source string, item string, value long")
        return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of every kept term that a group uses more than its language does."""
        held = self.kept.join(self.groups.select("lang", "source", "group_total", "terms", "lang_total"), ["lang", "source"])
        shares = held.select("lang", "source", F.col("term").alias("item"), share("n", "group_total", "terms").alias("p"),
                             share("total", "lang_total", "terms").alias("q"))
        return shares.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def ranked(values: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = values.withColumn("rank", F.row_number().over(order))
    return (out if most is None else out.where(F.col("rank") <= most)).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank, as the module describes."""
    found = Audit(docs, least_docs)
    return ranked(found.pairs(), "pair").unionAll(ranked(found.terms(), "term", top_terms))
