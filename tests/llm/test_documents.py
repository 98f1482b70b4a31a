"""Operators on documents against plain brute force over the given tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from riskloom.llm import decontam, hmm, packing, pii, queries, secrets, simhash, suffixes
from tests.llm.conftest import FOLDER


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_pii(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def plain_secrets(text):
    pattern = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_pii_base(spark, documents):
    for row in queries.op1_skip_chain_pii(spark, FOLDER).collect():
        assert row.base_sha256 == digest(pii.digest(plain_pii(documents[row.doc_id])))


@pytest.mark.parametrize("text", [
    "a@b.c.d%x@e.f a@b @x.y a@@b.c", "1.2.3.4.5.6.7.8.9 256.1.1.1 0000255.1.2.3", "4111 1111-1111 1111 +1 (2", "+12 34.56(78)90-",
    "é 10.0.0.1 😀 x@y.z", "1" * 30, "+" * 50 + "1 2345678901",
])
def test_pii_base_by_hand(text):
    assert pii.base_spans(text) == plain_pii(text)


def test_marginals_are_exact_on_trees():
    rng = np.random.default_rng(1)
    unary, potential = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    pairs = np.array([(0, 1), (1, 2), (1, 3)])
    weight = np.zeros((3,) * 4)
    for x in np.ndindex(*weight.shape):
        weight[x] = np.exp(sum(unary[i, v] for i, v in enumerate(x)) + sum(potential[x[a], x[b]] for a, b in pairs))
    want = [weight.sum(axis=tuple(j for j in range(4) if j != i)) / weight.sum() for i in range(4)]
    got = pii.marginals(unary, [(pairs, potential), (np.zeros((0, 2), np.int64), potential)], rounds=10)
    assert np.allclose(got, want)


def test_skip_links_carry_a_label():
    known = [f"call +1 ({a}) 555-{b} now" for a, b in zip(range(200, 400), range(1000, 1200))] + ["plain 12 of 7 items 2020"] * 100
    weights = pii.fit(known)
    text = "call +1 (988) 555-2485 now; later 12 items; again (988) 555-2485 here"
    base = pii.base_spans(text)
    (added,) = pii.added_spans([text], [base], weights)
    assert [text[s:e] for s, _, e in added] == ["(988) 555-2485"]


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = queries.op2_best_fit_packing(spark, FOLDER).collect()
    by_doc, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in documents.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        cut = [(k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted(by_doc[doc_id]) == cut
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) < 1.15 * sum(r.length for r in rows) / 2048 + 1


def test_signs_after_letters_share_the_word_they_end():
    from tokenizers import Tokenizer

    from riskloom.llm.packing import WordIds

    encode, plain = WordIds(queries.tokenizer_path()), Tokenizer.from_file(queries.tokenizer_path())
    words = ["abé", "word", "straße", "it's", "x÷", "o'", "éß"]
    signs = ["", "###", "&&&", "$$$", "***", ".'", "'.", "'s", ".'s", "&'ll.", "(%)", "<|", "|>", "-", "_", "~`", "\"", "÷", "≠", "9", "=\u0338", ")\u0301"]
    texts = [before + w + s + gap + w + s for before in ("", "(", "'") for w in words for s in signs for gap in ("", " ", "\n", "\t\r", "\u00a0", "\x0b")]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0], text
    shared = WordIds(queries.tokenizer_path())
    list(shared(["straßé### straßé&&& straßé. straßé"]))
    assert "straßé" in shared.known and "straßé###" not in shared.known


def test_packing_of_added_tokens(spark):
    """Ids are those of the plain tokenizer, also where a text holds one of its added tokens, in any case."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    texts = ["a <|endoftext|> b", "a<|startoftext|>b.", "A <|EndOfText|> B", "plain, text!", "", "\u0130stanbul \u03a3\u0391\u03a3 <|endoftext|>",
             "x" * 3000 + " <|endoftext|> " + "word " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in packing.pack(df, queries.tokenizer_path()).collect()}
    want = {}
    for k, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want |= {(k, a): (len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for a in range(0, len(ids), 2048)}
    assert got == want


def test_packing_hardly_depends_on_the_tasks(spark):
    df = spark.read.parquet(FOLDER.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text")
    for tasks in (1, 8, 64):
        rows = packing.pack(df.repartition(tasks), queries.tokenizer_path()).collect()
        bins = collections.defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for parts in bins.values():
            parts.sort()
            assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()] and sum(n for _, n in parts) <= 2048
        assert len(bins) <= 1.02 * math.ceil(sum(r.length for r in rows) / 2048)


def test_best_fit_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(s) for s in (6, 7, 3, 4, 9, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    bins = packing.BestFit(10, 2)
    assert [bins.place(s) for s in (8, 5, 6, 5, 4)] == [(0, 0), (1, 0), (2, 0), (1, 5), (2, 6)]


def test_repeats(spark, documents):
    first = {}
    for doc_id, text in sorted(documents.items()):
        raw = text.encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], doc_id)
    want = {}
    for doc_id, text in documents.items():
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < doc_id:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        want[doc_id] = (len(raw), sum(gone), spans, bytes(x for x, g in zip(raw, gone) if not g))
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for hot in (suffixes.HOT_BLOCKS, 0):  # with 0 every repeated string takes the way of very common ones
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df, hot).collect()}
        assert got == want


def test_language_model(spark, documents):
    counts = collections.Counter()
    for doc_id, text in documents.items():
        if zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update(words(text))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    rows = queries.op5_hmm_scores(spark, FOLDER).collect()
    for r in rows:
        tokens = [*words(documents[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_and_expected_counts_by_enumeration():
    rng = np.random.default_rng(3)
    model = hmm.Model(rng.dirichlet([1, 1]), rng.dirichlet([1, 1], 2), rng.dirichlet(np.ones(4), 2).T)
    sequences = [np.array(s, np.uint16) for s in ([1, 2, 0], [3, 0], [0])]
    moves, total = np.zeros((2, 2)), []
    for s in sequences:
        weight = {}
        for path in np.ndindex(*[2] * len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            weight[path] = p
        total.append(sum(weight.values()))
        for path, p in weight.items():
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total[-1]
    assert np.allclose(hmm.log_likelihoods(sequences, model), np.log(total))
    counts = hmm.expected_counts(sequences, model)
    assert np.allclose(counts[4:6], moves) and np.isclose(counts[-1, 0], np.log(total).sum())
    assert np.isclose(counts[:4].sum(), 6)


def test_simhash_components(spark, documents):
    prints = {}
    for doc_id, text in documents.items():
        w = words(text)
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids, label = sorted(prints), {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                if label[a] != label[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash_bk_trees(spark, FOLDER).collect()}
    assert got == {d: (f"{prints[d]:016x}", label[d]) for d in ids}


def test_large_shards_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_LIMIT", 3)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 12)
    values = sorted({int(b) ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)) for b in base for k in (0, 1, 2, 3, 4)})
    values = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in simhash.component_roots(simhash.links(df, 4)).collect()}
    for a in values:
        for b in values:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                assert roots.get(a, a) == roots.get(b, b)


def test_bk_tree():
    rng = np.random.default_rng(2)
    values = [int(x) for x in np.unique(rng.integers(0, 1 << 12, 300))]
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1 << 12, 97):
        assert sorted(tree.values[i] for i in tree.near(q, 2)) == [v for v in values if (v ^ q).bit_count() <= 2]


def test_leaks(spark, documents):
    import duckdb

    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()

    def cut(text):
        return re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", text.lower())

    def bag(w):
        k = min(5, len(w))
        return collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    want = set()
    bags = [(i, len(cut(t)), bag(cut(t))) for i, t in items]
    for doc_id, text in documents.items():
        w = cut(text)
        grams = set(bag(w))
        for item, n, b in bags:
            if grams & set(b):
                size = min(n, len(w))
                best = max(decontam.weighted_similarity(bag(w[k : k + size]), b) for k in range(len(w) - size + 1))
                if best >= 0.8:
                    want.add((doc_id, item, round(best, 9)))
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in queries.op3_benchmark_decontamination(spark, FOLDER).collect()}
    assert got == want


def test_index_returns_everything_within_the_radius():
    rng = np.random.default_rng(4)
    index = decontam.Items([(k, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 20))) for k in range(50)])
    prints = index.prints[rng.integers(0, 50, 400)].copy()
    bits = np.unpackbits(prints.view(np.uint8), axis=1)
    for row in bits:
        row[rng.choice(128, rng.integers(0, 50), replace=False)] ^= 1
    prints = np.packbits(bits, axis=1).view(np.uint16)
    distance = np.bitwise_count(prints[:, None, :] ^ index.prints[None, :, :]).sum(axis=2)
    assert index.lookup(prints, 20, 5) == set(zip(*[x.tolist() for x in np.nonzero(distance <= decontam.RADIUS)]))


def test_secrets_base(spark, documents):
    for row in queries.op10_secret_battery(spark, FOLDER).collect():
        assert row.base_sha256 == digest(plain_secrets(documents[row.doc_id]))


def test_secrets_by_hand(spark):
    texts = ["secret: token: abcdefgh", "PASSWORD = 'ab.cd=ef' x", "é token=abcdef😀 AKIA" + "X" * 16, "a" * 24 + "g", "api_key:abc apikey=abcdefg"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.secret_digest(df).collect():
        assert row.base_sha256 == digest(plain_secrets(texts[row.doc_id]))


def test_battery_tells_random_strings_from_words(spark):
    rng = np.random.default_rng(6)
    random = ["".join(rng.choice(list("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), 40)) for _ in range(60)]
    word = ["".join(rng.choice(["the", "an", "ing", "er"], 14)) for _ in range(60)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(w,) for w in random + word], "b string").select(secrets.randomness(F.col("b")).alias("p"))
    p = [r.p for r in df.collect()]
    assert np.median(p[:60]) > 0.2 and max(p[60:]) < 0.05


def test_secrets_of_small_tables_and_of_letters_alone(spark):
    rng = np.random.default_rng(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

    def found(abc):
        keys = ["".join(rng.choice(list(abc), 40)) for _ in range(40)]
        rows = [(k, f"the key is {v} here") for k, v in enumerate(keys)]
        rows += [(k, w) for k, w in enumerate(["incomprehensibilities", "one-word-after-another-in-a-row", "getTheNameOfTheNextElement"], 100)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        n = {r.doc_id: r.n_random for r in secrets.secret_digest(df).collect()}
        assert not n[100] and not n[101] and not n[102]
        return sum(n[k] for k in range(40))

    assert found(letters) >= 30 and found(letters + "0123456789") >= 30 and found("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") >= 30


def test_random_strings_among_words(spark):
    """Random strings among words of one table are found, the words are not."""
    rng = np.random.default_rng(10)
    word = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(3000)]
    rows = [(k, " ".join(rng.choice(word, 60)) + ".") for k in range(3200)]
    rows += [(k, "x " + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), 40)) + " y") for k in range(4000, 4020)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = {r.doc_id: r.n_random for r in secrets.secret_digest(df).collect()}
    assert sum(n[k] for k in range(4000, 4020)) >= 14 and not any(n[k] for k in range(3200))


def plain_battery(b, abc):
    """Plain version of the battery."""
    r = np.array([abc.index(c) + 1 for c in b if c in abc], float)
    n, k = len(r), len(abc)
    if n < 8:
        return 0.0
    counts = np.array([b.count(c) for c in abc], float)
    tail = lambda z: max(math.erfc(abs(z) / math.sqrt(2)), 1e-300)
    df = k - 1
    chi = max((counts**2).sum() * k / n - n, 1e-9)
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    p1 = tail(z) / 2 if z > 0 else 1 - tail(z) / 2
    high = (2 * r > k).sum()
    expected = 2 * high * (n - high) / n + 1
    spread = math.sqrt((expected - 1) * (expected - 2) / (n - 1)) if (expected - 1) * (expected - 2) > 0 else 0
    p2 = tail((1 + ((2 * r[1:] > k) != (2 * r[:-1] > k)).sum() - expected) / spread) if spread else 1e-300
    c = r - r.mean()
    p3 = tail(((c[1:] * c[:-1]).sum() / (c * c).sum() + 1 / n) * math.sqrt(n)) if (c * c).sum() else 1e-300
    half = -math.log(p1) - math.log(p2) - math.log(p3)
    return math.exp(-half) * (1 + half + half * half / 2)


def plain_finds(text, shares):
    """Plain version of the battery's finds: runs whose share passes the step-up rule among those of the text."""
    runs = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
        name, abc = next((n, a) for n, a, rule in secrets.ENCODINGS if re.search(rule, m[0]))
        if name != "decimal":
            cls = min(max(math.floor(4 * math.log2(len(m[0]))), secrets.CLASSES[0]), secrets.CLASSES[-1])
            step = min(math.floor(-4 * math.log2(max(plain_battery(m[0], abc), 1e-300))), secrets.STEPS - 1)
            runs.append((shares[name, not re.search("[0-9]", m[0]), cls][step], m.start(), m.end(), "random_" + name))
    passed = [s for k, (s, *_) in enumerate(sorted(runs), 1) if s * len(runs) <= secrets.FALSE_SHARE * k]
    return [(a, b, kind) for s, a, b, kind in runs if passed and s <= max(passed)]


def test_finds_by_a_plain_version(spark):
    rng = np.random.default_rng(12)
    abc = {"hex": "0123456789ABCDEF", "b32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "low": "abcdefghijklmnopqrstuvwxyz0123456789",
           "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
    texts = ["", "=" * 20, "a" * 40 + " 1234567890123456789", "incomprehensibilities and antidisestablishmentarianism"]
    for _ in range(150):
        some = ["".join(rng.choice(list(abc[a]), rng.integers(16, 140))) for a in rng.choice(list(abc), rng.integers(0, 4))]
        some += ["".join(rng.choice(secrets.ORDINARY, rng.integers(4, 12))) for _ in range(rng.integers(0, 6))]
        texts.append("\u00e9 " + " word ".join(rng.permutation(some)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: ([(s.start, s.end, s.kind) for s in r.added], r.base) for r in secrets.find_secrets(df).collect()}
    shares = secrets.null_shares(spark)
    for k, text in enumerate(texts):
        want = [x for x in plain_finds(text, shares) if not any(b.start < x[1] and x[0] < b.end for b in got[k][1])]
        assert got[k][0] == want
    assert sum(len(v[0]) for v in got.values()) > 100
    # the same text has the same finds in any table
    alone = secrets.find_secrets(df.where("doc_id % 40 = 7")).collect()
    assert [([(s.start, s.end, s.kind) for s in r.added], r.base) for r in alone] == [got[r.doc_id] for r in alone]


def test_null_shares_are_those_of_the_null_strings(spark):
    shares = secrets.null_shares(spark)
    drawn = secrets.null_strings(spark).where("encoding = 'alnum' and class = 20").collect()
    abc = dict((n, a) for n, a, _ in secrets.ENCODINGS)["alnum"]
    for letters in (True, False):
        p = [plain_battery(r.b, abc) for r in drawn if r.letters == letters]
        assert len(p) == secrets.NULL_STRINGS
        for step in (4, 12, 20):
            above = sum(math.floor(-4 * math.log2(x)) <= step for x in p)
            if above:
                assert math.isclose(shares["alnum", letters, 20][step], (above + 1) / (len(p) + 1))
    assert all(a <= b for line in shares.values() for a, b in zip(line, line[1:]))


def test_many_matches_in_one_text(spark):
    """20,000 finds of a pattern and runs in one text: places are right, and the time is seconds."""
    import time

    rng = np.random.default_rng(13)
    text = " ".join("".join(x) for x in rng.choice(list("0123456789abcdef"), (20_000, 32)))
    start = time.time()
    (row,) = secrets.secret_digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.n_hex == 20_000 and row.base_sha256 == digest(plain_secrets(text)) and time.time() - start < 60
