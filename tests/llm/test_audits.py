"""Manifest, licence scan and divergence audit against plain versions on whole tables and odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm import divergence, licences, merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def way(levels, idx):
    for level in levels[:-1]:
        run = idx // 8 * 8
        yield level[run:idx], level[idx + 1 : run + 8]
        idx //= 8


def plain_manifest(rows):
    by_lang = defaultdict(list)
    for r in rows:
        text = r["text"]
        if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
            text = text.translate(LOWER)
        by_lang[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), leaf_of(r, text)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels_of([x[2] for x in sorted(by_lang[lang])]) for lang in langs}
    top = levels_of([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (known, doc_id, leaf, fold) in enumerate(sorted(by_lang[lang])):
            steps = [*way(trees[lang], i), *way(top, k)]
            for left, right in steps:
                fold = h(*left, fold, *right)
            out.append((doc_id if known else None, leaf, trees[lang][-1][0], top[-1][0],
                        h(*(x for left, right in steps for x in left + right)), fold, fold == top[-1][0]))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    from tests.llm.conftest import FOLDER

    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_manifest_of_a_table(table):
    got = rows_of(merkle.manifest_digest(table))
    assert got == plain_manifest(table.collect())
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("langs", [1, 3, 70])
def test_manifest_of_uneven_trees(spark, langs):
    """A language with most rows, lone languages, a run of one node, ids in no order, null and repeated keys."""
    rng = random.Random(langs)
    rows = [(rng.randrange(10**6), f"Text {k}", None if k % 97 == 5 and langs > 1 else f"l{min(k, rng.randrange(langs * 4)) % langs}", f"s{k % 3}", k) for k in range(586)]
    rows += [(None, None, "l0", None, None), (None, None, "l0", None, None), (7, "A", "l0", "", 1), (7, "B", "l0", None, 1)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert rows_of(merkle.manifest_digest(df)) == plain_manifest(df.collect())


def test_manifest_of_odd_rows_and_empty_tables(odd_rows):
    assert rows_of(merkle.manifest_digest(odd_rows)) == plain_manifest(odd_rows.collect())
    assert merkle.manifest_digest(odd_rows.limit(0)).collect() == []


def test_paths_double(spark):
    """After the rounds every inner node points to the root, and its path has one step per level."""
    nodes = spark.range(600).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("idx"), F.lit(600).cast("long").alias("size"),
                                    F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"))
    levels, _ = merkle._grow(nodes, "t", [])
    pointers = merkle._pointers(levels[0], 0)
    for k, runs in enumerate(levels[1:], 1):
        pointers = pointers.unionAll(merkle._pointers(runs, k))
    for r in merkle.jumped(pointers, len(levels)).collect():
        assert r.anc.tree == merkle.TOP and len(r.path) == len(levels) - r.node.level


def plain_licences(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOWER))
    index = licences.Index()

    def places(phrase):
        return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]

    base = [(i, label) for phrase, label in licences.BASE for i in places(phrase.split())]
    labels, score = {label for _, label in base}, 0.0
    for t, numbers in enumerate(index.templates):
        notice = [index.words[n] for n in numbers]
        weights = [int(index.weight[n]) for n in numbers]
        for place in range(-len(notice), len(words)):
            got = sum(w for q, (word, w) in enumerate(zip(notice, weights))
                      if word in words[max(place + q - 2, 0) : max(place + q + 3, 0)])
            low, high = max(place - 2, 0), min(place + len(notice) + 2, len(words))
            if got * 1000 >= 600 * sum(weights) and all(
                any(low <= i and i + len(p) <= high for i in places([index.words[n] for n in p])) for p in index.phrases[t]
            ):
                labels.add(index.labels[t])
                score = max(score, got / sum(weights))
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score)


def notices():
    rng = random.Random(3)
    out = ["", "under the MIT license under the mit-license", "Apache License, Version 2 cc by-nc 4.0", "mit " * 30, "the license " * 20,
           "under the terms of the GNU General Public License, version 3", "GNU Lesser General Public License version 3",
           "Licensed under the GNU Affero General Public License, version 3", "ünder the MİT license café cc0 1 0 universal"]
    for _, text, _ in licences.NOTICES:
        words = text.split()
        out.append("Before. " + " ".join(words).upper() + "; behind")
        for _ in range(3):
            changed = list(words)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(changed))
                changed[at : at + 1] = rng.choice([[], ["other"], [changed[at], "more"]])
            out.append(" ".join(changed + rng.choice(licences.NOTICES)[1].split()[:9]))
    return out


def test_licences_by_brute_force(spark):
    texts = notices()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licences.licence_digest(df).collect()}
    assert got == {k: plain_licences(t) for k, t in enumerate(texts)}
    assert got[5][5] == "gpl-3" and got[6][5] == "lgpl-3" and got[7][5] == "agpl-3"
    assert all(label in got[9 + 4 * k][5].split(",") for k, (label, _, _) in enumerate(licences.NOTICES))


def test_licences_of_a_table(table):
    texts = {r.doc_id: r.text for r in table.collect()}
    got = licences.licence_digest(table).collect()
    few = [r for r in got if r.labels] + got[:10]
    assert any(r.labels for r in got)
    for r in few:
        if len(texts[r.doc_id]) < 20_000:
            assert tuple(r)[1:] == plain_licences(texts[r.doc_id])


def test_licences_of_odd_rows(spark, odd_rows):
    got = rows_of(licences.licence_digest(odd_rows).select("doc_id", "n_words", "labels", "score"))
    assert got[(1, 0, "", 0.0)] == 1 and got[(5, 3, "", 0.0)] == 2 and sum(got.values()) == odd_rows.count()
    assert licences.licence_digest(odd_rows.limit(0)).collect() == []
    # one hit per word, in one long text
    long = spark.createDataFrame([(1, "under the MIT license " * 50_000)], "doc_id long, text string")
    assert tuple(licences.licence_digest(long).first())[1:5] == (200_000, 50_000, 0, 199_996)


def plain_audit(rows, least=3, top=200):
    docs = [(r["lang"] or "", r["source"] or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (r["text"] or "").translate(LOWER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(w for d in mine for w in set(d[2]))
        kept = [w for w, n in seen.items() if n >= least]
        counts = {s: Counter(w for d in mine if d[1] == s for w in d[2]) for s in {d[1] for d in mine}}
        whole = Counter(w for d in mine for w in d[2])

        def shares(count, kept=kept):
            total = sum(count[w] for w in kept) + len(kept)
            return {w: 1 + 10**9 * (count[w] + 1) // total for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in counts if o != s]
            terms = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(values, key=lambda v: (-v[0], v[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return Counter(out)


@pytest.mark.parametrize("block, bucket", [(divergence.BLOCK, divergence.BUCKET), (7, 2)])
def test_divergence_by_brute_force(spark, table, odd_rows, monkeypatch, block, bucket):
    """Whole table, odd rows and a group without terms; also with many blocks and buckets."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "BUCKET", bucket)
    short = table if block > 7 else table.where("length(text) < 1500")
    assert rows_of(divergence.audit(short)) == plain_audit(short.collect())
    assert rows_of(divergence.audit(odd_rows)) == plain_audit(odd_rows.collect())
    rows = [(k, t, lang, s, 0) for k, (t, lang, s) in enumerate(itertools.product(["a b B é", "a c", "1 2", None], ["x", None, ""], ["s", None, "t", "u"]))]
    rows += [(None, "only one", "z", s, 0) for s in "abc"[:2]] + [(1, "a a a a", "x", "s", 1)] * 5
    df = spark.createDataFrame(rows, COLUMNS)
    assert rows_of(divergence.audit(df, top_terms=2)) == plain_audit(df.collect(), top=2)
    assert divergence.audit(df.limit(0)).collect() == []


def test_runs_of_equal_counts(spark):
    """Terms with equal rows of counts stand side by side, so the runs are few."""
    rows = [(k, " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)), "x", s, 0) for k, s in enumerate("aaabbbb")]
    rows += [(9, "waa waa wzz", "x", "a", 0)]
    columns = divergence.Audit(spark.createDataFrame(rows, COLUMNS)).columns().collect()
    assert {c.source: c.ends for c in columns} == {"a": [399, 400], "b": [400]}


def test_shares_beyond_64_bits(spark):
    import numpy as np

    n, total, terms = 5 * 10**11, 10**13, 10**7
    want = 1 + 10**9 * (n + 1) // (total + terms)
    assert divergence.shares_of(np.array([n]), total, terms).tolist() == [want]
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert df.select(divergence.share("n", "total", "terms")).first()[0] == want
