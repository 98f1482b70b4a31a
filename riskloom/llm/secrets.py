"""Secrets in text: three fixed patterns and a battery of randomness tests, all in DataFrame expressions.

The battery looks at every unbroken run of at least ``MIN_RUN`` code characters. The narrowest alphabet that holds the
run (decimal, hex, base 32, lower or upper letters and digits, letters and digits, base 64) is its encoding. Three tests
ask whether it is a uniform random string over that alphabet: chi-squared of character counts, number of runs above and
below the middle of the alphabet, and serial correlation of neighbours; Fisher's rule joins them to one p-value. Short
strings of ordinary words pass such tests by chance and long ones do not, so the p-value is set against a null
distribution per encoding, class of length, and whether the run has letters alone: the p-values of ordinary words (with
a number behind the first) written together in that alphabet. These strings are drawn by a rule that knows nothing of the
table, so a text has the same finds in every table. A run's share is that of the null strings that look at least as
random; beyond the most random of them it falls with the distance. Among the runs of a text the shares pass the step-up
rule of Benjamini and Hochberg at ``FALSE_SHARE``. Runs of digits alone are numbers and no finds.

Null texts are empty and give no spans; repeated rows give repeated results; an empty table gives an empty result.
Columns other than doc_id and text are not read. Work is about linear in the text and its matches, also for one long
text: places come from sums over chunks of matches.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_=-]{16,}"
MIN_RUN = 16
FALSE_SHARE = 0.05
#: Classes of length (quarter octaves, from 16); the last has the longer runs too. Null strings of each, and steps into
#: which p-values fall.
CLASSES = range(16, 29)
NULL_STRINGS = 300
STEPS = 64
#: Matches of one chunk when places are summed up.
CHUNK = 128
# Common words of four languages, of which null strings are made.
ORDINARY = (
    "the and that have with this from they will would there their what about which when make like time just know take people into"
    " year your good some could them other than then look only come over think also back after work first well even want because"
    " any these give most user name file data list value index server client order number default config message request model"
    " der und die nicht mit sich auf eine auch werden haben nach wird aus noch wie einem ueber zeit jahr"
    " les des une dans que pour pas sur avec son plus tout faire nous comme mais leur bien sans annee"
    " los las por con para como pero sus este entre cuando todo esta ser son dos tambien fue habia tiempo"
).split()
ENCODINGS = (
    ("decimal", "0123456789", "^[0-9]+$"),
    ("hex", "0123456789abcdef", "^[0-9a-f]+$"),
    ("hex", "0123456789ABCDEF", "^[0-9A-F]+$"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "^[A-Z2-7]+$"),
    ("lower", "0123456789abcdefghijklmnopqrstuvwxyz", "^[0-9a-z]+$"),
    ("upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "^[0-9A-Z]+$"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "^[0-9A-Za-z]+$"),
    ("base64", "+-/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", "^[0-9A-Za-z+/_=-]+$"),
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once; Spark evaluates what a lambda names from outside for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda a, x: a + x)


def running_sums(steps: Column) -> Column:
    """Sums of all beginnings of an array: per chunk, over the chunks before, and within the chunk."""
    def over_chunks(x: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int"))
        sums = F.transform(chunks, lambda c: _total(F.slice(x, c * CHUNK + 1, F.lit(CHUNK))))
        return bound(sums, lambda t: F.flatten(F.transform(chunks, lambda c: bound(
            F.struct(F.slice(x, c * CHUNK + 1, F.lit(CHUNK)).alias("x"), _total(F.slice(t, F.lit(1), c)).alias("before")),
            lambda y: F.transform(y["x"], lambda _, i: y["before"] + _total(F.slice(y["x"], F.lit(1), i + 1)))))))

    return bound(steps, over_chunks)


def _matches(text: Column, pattern: str, kind: str, order: int, group: int | None = None) -> Column:
    """Array of (start, order, kind, end, body) of all matches: what stands between them gives their places."""
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int,body:string>>")

    def spans(x: Column) -> Column:
        sizes = F.transform(x["found"], F.length)
        gaps = F.transform(F.slice(x["gaps"], F.lit(1), F.size(x["found"])), F.length)
        steps = F.zip_with(gaps, F.concat(F.array(F.lit(0)), F.slice(sizes, F.lit(1), F.size(sizes) - 1)), lambda g, s: g + s)
        parts = F.arrays_zip(running_sums(steps).alias("start"), sizes.alias("size"), x["body"].alias("body"))
        return F.transform(parts, lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
            (m["start"] + m["size"]).alias("end"), m["body"].alias("body")))

    found = F.struct(
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("found"), F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit((group or 0) + 1)).alias("body"))
    return F.when(text.rlike(pattern), bound(found, spans)).otherwise(empty)


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def normal_tail(z: Column) -> Column:
    """P(|Z| >= |z|) of the standard normal, by a rational approximation with error below 1.5e-7."""
    def tail(y: Column) -> Column:
        t, x = y["t"], y["x"]
        series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.greatest(series * F.exp(-x * x), F.lit(1e-300))

    return bound(F.abs(z) / math.sqrt(2.0), lambda x: bound(F.struct(x.alias("x"), (1.0 / (1.0 + 0.3275911 * x)).alias("t")), tail))


def _encoding(body: Column) -> Column:
    """Number of the narrowest alphabet in ENCODINGS that holds ``body``; the last holds every run."""
    out = F.lit(len(ENCODINGS) - 1)
    for k, (_, _, rule) in reversed(list(enumerate(ENCODINGS[:-1]))):
        out = F.when(body.rlike(rule), F.lit(k)).otherwise(out)
    return out


def _listed(values: tuple | list, kind: str = "string") -> Column:
    """An array literal that is one node of the plan while it is analysed."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


NAMES = [name for name, _, _ in ENCODINGS]
ALPHABETS = [alphabet for _, alphabet, _ in ENCODINGS]


def randomness(body: Column, encoding: Column | None = None) -> Column:
    """p-value that ``body`` is a uniform random string over its inferred alphabet; low for words and patterns."""
    which = _encoding(body) if encoding is None else encoding
    return bound(F.struct(body.alias("b"), F.get(_listed(ALPHABETS), which).alias("abc")), _battery)


def _battery(x: Column) -> Column:
    def with_ranks(y: Column) -> Column:
        ranks = F.transform(F.split(y["b"], ""), lambda c: F.instr(y["abc"], c).cast("double"))

        def count(c: Column) -> Column:
            return (F.length(y["b"]) - F.length(F.replace(y["b"], c, F.lit("")))).cast("double")

        return F.struct(
            F.filter(ranks, lambda r: r > 0).alias("r"), F.length(y["abc"]).cast("double").alias("k"),
            F.aggregate(F.transform(F.split(y["abc"], ""), count), F.lit(0.0), lambda a, n: a + n * n).alias("squares"),
        )

    def with_moments(y: Column) -> Column:
        n = F.greatest(F.size(y["r"]), F.lit(2)).cast("double")  # shorter ones are never finds
        return F.struct(
            y["r"].alias("r"), y["k"].alias("k"), n.alias("n"),
            y["squares"].alias("squares"),
            (F.aggregate(y["r"], F.lit(0.0), lambda a, r: a + r) / n).alias("mean"),
            F.size(F.filter(y["r"], lambda r: r * 2 > y["k"])).cast("double").alias("high"),
        )

    def with_pairs(y: Column) -> Column:
        n, r, mean, high, df = y["n"], y["r"], y["mean"], y["high"], y["k"] - 1
        after = F.greatest(F.size(r) - 1, F.lit(0))
        pairs = F.arrays_zip(F.slice(r, F.lit(1), after).alias("a"), F.slice(r, F.lit(2), after).alias("b"))
        expected = 2 * high * (n - high) / n + 1
        return bound(pairs, lambda p: F.struct(
            n.alias("n"), y["k"].alias("k"), df.alias("df"), ((y["squares"] * y["k"] / n - n) / df).alias("chi"),
            expected.alias("expected"), F.sqrt((expected - 1) * (expected - 2) / (n - 1)).alias("spread"),
            (1 + F.size(F.filter(p, lambda v: (v["a"] * 2 > y["k"]) != (v["b"] * 2 > y["k"])))).alias("runs"),
            F.aggregate(p, F.lit(0.0), lambda a, v: a + (v["a"] - mean) * (v["b"] - mean)).alias("product"),
            F.aggregate(r, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)).alias("square")))

    def with_scores(y: Column) -> Column:
        n, df = y["n"], y["df"]
        return F.struct(
            ((F.pow(F.greatest(y["chi"], 1e-9 / df), F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))).alias("z1"),
            F.try_divide(y["runs"] - y["expected"], F.nullif(y["spread"], F.lit(0.0))).alias("z2"),
            ((F.try_divide(y["product"], y["square"]) + 1 / n) * F.sqrt(n)).alias("z3"),
            ((n >= 8) & (y["k"] > 1)).alias("long"))

    def with_logs(y: Column) -> Column:
        # lower tail counts as random too: only too uneven counts speak against it
        p1 = bound(normal_tail(y["z1"]) / 2, lambda p: F.when(y["z1"] > 0, p).otherwise(1 - p))
        p2, p3 = (F.coalesce(normal_tail(y[z]), F.lit(1e-300)) for z in ("z2", "z3"))
        return F.struct(y["long"].alias("long"), (-(F.log(p1) + F.log(p2) + F.log(p3))).alias("half"))

    def joint(y: Column) -> Column:
        return F.when(y["long"], F.exp(-y["half"]) * (1 + y["half"] + y["half"] * y["half"] / 2)).otherwise(0.0)

    out = with_ranks(x)
    for stage in (with_moments, with_pairs, with_scores, with_logs, joint):
        out = bound(out, stage)
    return out


def _class(length: Column) -> Column:
    return F.least(F.greatest(F.floor(4 * F.log2(length)), F.lit(CLASSES[0])), F.lit(CLASSES[-1])).cast("int")


def _step(p: Column) -> Column:
    """Quarter powers of two by which p is below 1: 0 for the most random."""
    return F.least(F.floor(-4 * F.log2(F.greatest(p, F.lit(1e-300)))), F.lit(STEPS - 1)).cast("int")


def null_strings(spark: SparkSession) -> DataFrame:
    """(encoding, letters, class, b): ordinary words written together in every alphabet, drawn by hashes of their number."""
    forms = {  # how words are written, and what stands between them
        "hex": (F.lower, ""), "base32": (F.upper, ""), "lower": (F.lower, ""), "upper": (F.upper, ""), "alnum": (F.initcap, ""), "base64": (F.initcap, "-"),
    }
    kinds = F.explode(F.array(*[
        F.struct(F.lit(e).alias("encoding"), F.lit(letters).alias("letters"), F.lit(c).alias("class"))
        for e in forms for letters in (True, False) for c in CLASSES]))
    drawn = spark.range(0, NULL_STRINGS, 1, 16).select("id", kinds.alias("kind")).select("id", "kind.*").withColumn(
        "n", F.expr("cast(ceil(power(2, (class + pmod(xxhash64(id, class), 1000) / 1000) / 4)) as int)"))
    # words lose their letters outside the alphabet, so short alphabets need as many words as there are places
    picks = F.transform(F.sequence(F.lit(1), F.when(F.col("encoding") == "hex", F.col("n")).otherwise(F.ceil(F.col("n") / 2)).cast("int")), lambda i: F.struct(
        F.get(_listed(ORDINARY), F.pmod(F.xxhash64("id", "encoding", "n", i), F.lit(len(ORDINARY))).cast("int")).alias("w"),
        F.when(F.col("letters") | (i > 1), "").otherwise(F.pmod(F.xxhash64("id", "n", i), F.lit(1000)).cast("string")).alias("d")))
    alphabets = {name: rule[2:-2] for name, _, rule in reversed(ENCODINGS)}  # what stands between ^[ and ]+$
    out = F.lit(None).cast("string")
    for encoding, (form, between) in forms.items():
        def word(p: Column) -> Column:
            return F.concat(form(p["w"]), p["d"])  # noqa: B023 (called at once)

        written = F.regexp_replace(F.concat_ws(between, F.transform("picks", word)), f"[^{alphabets[encoding]}]", "")
        out = F.when(F.col("encoding") == encoding, written).otherwise(out)
    return drawn.withColumn("picks", picks).select("encoding", "letters", "class", F.substr(out, F.lit(1), F.col("n")).alias("b"), "n").where(
        F.length("b") == F.col("n")).drop("n")


_NULL: list[dict[tuple[str, bool, int], list[float]]] = []


def null_shares(spark: SparkSession) -> dict[tuple[str, bool, int], list[float]]:
    """Per encoding, letters alone or not, and class: share of null strings at least as random, for every step of p.

    Steps above all null strings go on falling by quarter powers of two, while p rises by them. The strings are the same in every
    session, so this is evaluated once per process.
    """
    if not _NULL:
        first = F.array_position(_listed(NAMES), F.col("encoding")).cast("int") - 1
        p = randomness(F.col("b"), first)
        counts: dict[tuple[str, bool, int], list[int]] = {}
        for e, letters, c, step, n in null_strings(spark).groupBy("encoding", "letters", "class", _step(p).alias("step")).count().collect():
            counts.setdefault((e, letters, c), [0] * STEPS)[step] = n
        _NULL.append({key: shares_of(seen) for key, seen in counts.items()})
    return _NULL[0]


def shares_of(counts: list[int]) -> list[float]:
    """Shares of null strings at or above every step, given how many fall on each."""
    total, first = sum(counts), next(k for k, n in enumerate(counts) if n)
    out = [2.0 ** ((k - first) / 4) / (total + 1) for k in range(first)]
    above = 0
    for n in counts[first:]:
        above += n
        out.append((above + 1) / (total + 1))
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base spans, and the runs with their shares, of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    assign = F.filter(_matches(F.col("text"), ASSIGN, "assign", 0, 2), lambda s: F.length(s["body"]) >= 6)
    base = F.concat(assign, _matches(F.col("text"), ACCESS, "access", 1), _matches(F.col("text"), HEX, "hex", 2))
    shares = null_shares(docs.sparkSession)
    # one line of the table per encoding, letters alone or not, and class; numbers have none
    table = _listed([x for e in NAMES for letters in (False, True) for c in CLASSES for x in shares.get((e, letters, c), [None] * STEPS)], "double")

    def judged(s: Column) -> Column:
        return bound(F.struct(s.alias("s"), _encoding(s["body"]).alias("e")), lambda x: bound(F.struct(
            x["s"].alias("s"), x["e"].alias("e"), _step(randomness(x["s"]["body"], x["e"])).alias("step"),
            F.when(x["s"]["body"].rlike("[0-9]"), 0).otherwise(1).alias("letters"),
            (_class(F.length(x["s"]["body"])) - CLASSES[0]).alias("class"),
        ), lambda r: F.struct(
            r["s"]["start"].alias("start"), r["s"]["end"].alias("end"), F.get(_listed(NAMES), r["e"]).alias("encoding"),
            F.get(table, ((r["e"] * 2 + r["letters"]) * len(CLASSES) + r["class"]) * STEPS + r["step"]).alias("share"))))

    runs = F.filter(F.transform(_matches(F.col("text"), RUN, "random", 3), judged), lambda r: r["share"].isNotNull())
    return rows.select("doc_id", base.alias("base"), runs.alias("runs"))


def false_discovery_bar(shares: Column) -> Column:
    """Greatest share that is a find among these: the k-th smallest of m may be FALSE_SHARE * k / m."""
    def bar(x: Column) -> Column:
        passed = F.filter(F.transform(x, lambda s, i: F.when(s * F.size(x) <= FALSE_SHARE * (i + 1), s)), lambda s: s.isNotNull())
        return F.coalesce(F.array_max(passed), F.lit(-1.0))

    return bound(F.array_sort(shares), bar)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (spans by pattern), added (spans by randomness), each start, order, kind, end."""
    slim = F.transform("base", lambda b: F.struct(*[b[c].alias(c) for c in ("start", "order", "kind", "end")]))
    finds = bound(F.struct(F.col("runs").alias("runs"), false_discovery_bar(F.col("runs.share")).alias("bar")),
                  lambda x: F.filter(x["runs"], lambda r: r["share"] <= x["bar"]))
    added = bound(F.struct(finds.alias("finds"), _chunked(F.col("base")).alias("base")), lambda x: F.transform(
        F.filter(x["finds"], lambda r: ~_overlaps(r, x["base"])), lambda r: F.struct(
            r["start"].alias("start"), F.lit(3).alias("order"), F.concat(F.lit("random_"), r["encoding"]).alias("kind"),
            r["end"].alias("end"))))
    return scanned(docs).select("doc_id", slim.alias("base"), added.alias("added"))


def _chunked(spans: Column) -> Column:
    """Sorted spans in chunks, each with the stretch of text it lies in."""
    def cut(x: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(x) - 1) / CHUNK), F.lit(0)).cast("int"))
        return F.transform(chunks, lambda c: bound(F.slice(x, c * CHUNK + 1, F.lit(CHUNK)), lambda y: F.struct(
            F.array_min(F.transform(y, lambda s: s["start"])).alias("start"), F.array_max(F.transform(y, lambda s: s["end"])).alias("end"),
            y.alias("spans"))))

    return bound(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))), cut)


def _overlaps(r: Column, chunks: Column) -> Column:
    def meets(s: Column) -> Column:
        return (s["start"] < r["end"]) & (r["start"] < s["end"])

    return F.exists(chunks, lambda c: meets(c) & F.exists(c["spans"], meets))


def secret_digest(docs: DataFrame) -> DataFrame:
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(docs).select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_random"),
    )
