"""Personal data by a skip-chain conditional random field.

Four fixed patterns give spans that always stay (``base``). The field labels tokens: every word with a digit or '@' is a
node with the labels other, email, ip, card, phone; all other words are fixed to 'other', so they only end a chain.
Neighbouring nodes share a transition potential. Distant nodes of the same text with equal or similar keys (the same
letters and digits in either case, or the same last seven digits) share a potential that favours equal labels; each
occurrence is linked with the one before it, so that the links of a text grow with its length. Loopy message passing over
all edges yields marginals, and nodes that are surely personal but lie in no base span are added.

Weights are fitted by pieces on a sample of at most ``SAMPLE_ROWS`` rows whose base spans are the labels: token weights by
softmax regression over shape features, transitions and skip links by smoothed counts of label pairs. The sample only
fits weights; every row and every whole text is searched.

Null texts are empty and give no spans; repeated rows give repeated results; an empty table or one without base spans
gives no added spans. Columns other than doc_id and text are not read by ``find_pii``; ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import arrow_map, pieces

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns, built so that each is linear in the text; see ``base_spans``.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NODE = re.compile(r"[^\s]*[0-9@][^\s]*")
SAMPLE_ROWS = 3000
FEATURES = 24
ROUNDS = 8
SURE = 0.9
Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, 0, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[Span]:
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            if all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in parts[k : k + 4]):
                yield at, 1, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind."""
    out = list(_emails(text)) + list(_ips(text))
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PLUS.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


@dataclass
class Graph:
    """Nodes and edges of several texts; texts share no edge."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of similar nodes


def _features(word: str, before: bool, after: bool) -> list[float]:
    digits = sum("0" <= c <= "9" for c in word)
    dots, hyphens = word.count("."), word.count("-")
    return [
        1.0, "@" in word, "@" in word and "." in word.partition("@")[2], word[:1] == "+", "(" in word, ")" in word,
        digits == 0, 1 <= digits <= 2, digits == 3, 4 <= digits <= 6, 7 <= digits <= 9, 10 <= digits <= 11, 12 <= digits <= 19,
        digits > 19, dots == 0, dots == 1, dots == 2, dots == 3, dots > 3, hyphens == 1, hyphens > 1,
        any(c.isalpha() for c in word), before, after,
    ]


def graph_of(texts: list[str]) -> Graph:
    which, starts, ends, features, chain, skip = [], [], [], [], [], []
    for t, text in enumerate(texts):
        found = list(NODE.finditer(text))
        seen: dict[str, int] = {}
        for k, m in enumerate(found):
            n = len(which)
            before = k > 0 and not text[found[k - 1].end() : m.start()].strip()
            after = k + 1 < len(found) and not text[m.end() : found[k + 1].start()].strip()
            which.append(t)
            starts.append(m.start())
            ends.append(m.end())
            features.append(_features(m[0], before, after))
            if before:
                chain.append((n - 1, n))
            letters = "".join(c for c in m[0].lower() if c.isalnum() or c == "@")
            digits = "".join(c for c in letters if "0" <= c <= "9")
            last = set()
            for key in {letters, "#" + digits[-7:]} if len(digits) >= 7 else {letters}:
                if key in seen and seen[key] not in last:
                    skip.append((seen[key], n))
                    last.add(seen[key])
                seen[key] = n
    pairs = [np.array(x, np.int64).reshape(-1, 2) for x in (chain, skip)]
    return Graph(np.array(which, np.int64), np.array(starts, np.int64), np.array(ends, np.int64),
                 np.array(features, float).reshape(-1, FEATURES), *pairs)


def base_labels(graph: Graph, spans: list[list[Span]]) -> np.ndarray:
    """Label of every node: 1 + kind of the base span that it meets, else 0."""
    out = np.zeros(len(graph.text), np.int64)
    by_text: dict[int, list[int]] = {}
    for node, t in enumerate(graph.text.tolist()):
        by_text.setdefault(t, []).append(node)
    for t, nodes in by_text.items():
        k = 0
        for node in nodes:
            while k < len(spans[t]) and spans[t][k][2] <= graph.start[node]:
                k += 1
            if k < len(spans[t]) and spans[t][k][0] < graph.end[node]:
                out[node] = 1 + spans[t][k][1]
    return out


@dataclass
class Weights:
    token: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log potentials
    skip: np.ndarray


def _log_ratio(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """log P(a, b) / P(a) P(b) of the label pairs, smoothed; no pairs give zeros."""
    counts = np.full((size, size), 0.5)
    np.add.at(counts, (a, b), 1.0)
    counts = (counts + counts.T) / counts.sum() / 2
    one = counts.sum(1)
    return np.log(counts / np.outer(one, one)) if len(a) else np.zeros((size, size))


def fit(texts: list[str], steps: int = 300) -> Weights:
    size = len(KINDS) + 1
    graph = graph_of(texts)
    labels = base_labels(graph, [base_spans(t) for t in texts])
    token = np.zeros((FEATURES, size))
    if labels.any():
        want = np.eye(size)[labels]
        speed = np.zeros_like(token)
        for _ in range(steps):
            score = graph.features @ token
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            slope = graph.features.T @ (p - want) / len(labels) + 1e-4 * token
            speed += slope * slope
            token -= 0.5 * slope / np.sqrt(speed + 1e-8)
        pair = [_log_ratio(labels[e[:, 0]], labels[e[:, 1]], size) for e in (graph.chain, graph.skip)]
        # equal labels of similar nodes are never penalised
        pair[1] = np.where(np.eye(size) > 0, np.maximum(pair[1], 0), pair[1])
        return Weights(token, *pair)
    token[0, 0] = 10.0
    return Weights(token, np.zeros((size, size)), np.zeros((size, size)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(unary: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> np.ndarray:
    """Loopy belief propagation; ``edges`` holds (pairs, log potentials). Exact on trees after as many rounds as they are deep."""
    pairs = np.concatenate([e for e, _ in edges])
    if len(pairs):
        n = len(pairs)
        potential = np.concatenate([np.broadcast_to(p, (len(e), *p.shape)) for e, p in edges])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        message = np.zeros((2 * n, unary.shape[1]))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            new = _lse(out[:, :, None] + potential, 1)
            message = 0.5 * message + 0.5 * (new - _lse(new, 1)[:, None]) if rounds <= ROUNDS else new - _lse(new, 1)[:, None]
        unary = unary.copy()
        np.add.at(unary, target, message)
    return np.exp(unary - _lse(unary, 1)[:, None])


def added_spans(texts: list[str], base: list[list[Span]], weights: Weights) -> list[list[Span]]:
    """Spans the field adds: runs of neighbouring nodes with one sure label that meet no base span."""
    out: list[list[Span]] = [[] for _ in texts]
    graph = graph_of(texts)
    if not len(graph.text):
        return out
    belief = marginals(graph.features @ weights.token, [(graph.chain, weights.chain), (graph.skip, weights.skip)])
    label = belief.argmax(1)
    covered = base_labels(graph, base) > 0
    good = (label > 0) & (belief.max(1) >= SURE) & ~covered
    joined = {b: a for a, b in graph.chain.tolist()}
    for node in np.flatnonzero(good).tolist():
        t, text = int(graph.text[node]), texts[int(graph.text[node])]
        start, end = int(graph.start[node]), int(graph.end[node])
        while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        if start == end:
            continue
        kind, last = int(label[node]) - 1, joined.get(node)
        if last is not None and good[last] and label[last] == label[node] and out[t]:
            out[t][-1] = (out[t][-1][0], kind, end)
        else:
            out[t].append((start, kind, end))
    return out


def _sample(docs: DataFrame) -> list[str]:
    """SAMPLE_ROWS different texts with a digit or '@' (all, if fewer) by a hash of id and text, whatever the order of the rows."""
    text = F.col("text").cast("string")
    rows = docs.select(text.alias("text"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"))
    total = docs.count()
    share = min(1.0, 1.5 * SAMPLE_ROWS / max(total, 1))
    chosen = rows.where((F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1) & F.col("text").rlike("[0-9@]"))
    return [r.text for r in chosen.distinct().orderBy("h", "text").limit(SAMPLE_ROWS).collect()]


def find_pii(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added spans, each array of (start, kind, end) in code points."""
    weights = weights or fit(_sample(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        for ids, texts in pieces(batches, 1):
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, weights)
            columns = [[[dict(zip(("start", "kind", "end"), s)) for s in x] for x in spans] for spans in (base, added)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(columns[0], kind), pa.array(columns[1], kind)], ["doc_id", "base", "added"]
            )

    spans = "array<struct<start:int,kind:int,end:int>>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     f"doc_id long, base {spans}, added {spans}")


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def pii_digest(docs: DataFrame) -> DataFrame:
    found = find_pii(docs)

    def text_of(column: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.concat_ws(",", F.transform(F.array_sort(column), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["end"])))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", *[number(k) for k in range(4)],
        F.sha2(text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        text_of(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; null texts stay null."""
    weights = weights or fit(_sample(docs))
    place, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(place).to_pylist()
            base: list[list[Span]] = []
            added: list[list[Span]] = []
            for (texts,) in pieces([batch.select([place])], 0):
                base += [base_spans(t) for t in texts]
                added += added_spans(texts, base[len(added) :], weights)
            out = [t and masked(t, b + a) for t, b, a in zip(raw, base, added)]
            columns = [pa.array(out, pa.string()) if k == place else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in docs.schema])
    return arrow_map(docs.withColumn("text", F.col("text").cast("string")), run, schema)  # type: ignore[arg-type]


def masked(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind]}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
