"""SQL counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

from riskloom.llm.licences import Index

#: Levels the SQL unrolls: enough for 8^8 documents of a language and 8^3 languages.
_LEVELS, _TOP_LEVELS = 8, 3


def _tree(leaves: str, name: str, levels: int) -> str:
    """Levels of trees over ``leaves`` (tree, idx, size, h), siblings per level, and the root of every tree."""
    out = [f"{name}0 AS (SELECT tree, idx, size, h FROM {leaves})"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS (SELECT tree, idx // 8 AS idx, (size + 7) // 8 AS size, sha256(string_agg(h, '' ORDER BY idx)) AS h"
            f" FROM {name}{k} WHERE size > 1 GROUP BY tree, idx // 8, (size + 7) // 8)")
        out.append(
            f"{name}_s{k} AS (SELECT tree, idx,"
            f" coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"
            f" FROM {name}{k} WHERE size > 1 WINDOW w AS (PARTITION BY tree, idx // 8 ORDER BY idx))")
    union = " UNION ALL ".join(f"SELECT tree, h FROM {name}{k} WHERE size = 1" for k in range(levels + 1))
    out.append(f"{name}_root AS ({union})")
    return ",\n".join(out)


def _climb(source: str, name: str, levels: int, tree: str, idx: str) -> list[str]:
    """Proof and folded digest carried up level by level; the last step is ``{name}_c{levels}``."""
    out, last = [], source
    for k in range(levels):
        out.append(
            f"{name}_c{k + 1} AS (SELECT c.* EXCLUDE (proof, fold), proof || coalesce(s.l || s.r, '') AS proof,"
            f" CASE WHEN s.tree IS NULL THEN fold ELSE sha256(s.l || fold || s.r) END AS fold"
            f" FROM {last} c LEFT JOIN {name}_s{k} s ON s.tree = c.{tree} AND s.idx = c.{idx} // {8**k})")
        last = f"{name}_c{k + 1}"
    return out


def _value(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes enter the checksum by their value, each followed by eight shifts (marked -1).
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(doc_id::VARCHAR, ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""

MERKLE = f"""
WITH crc AS (SELECT *, {_CRC32} AS crc FROM documents),
leaf AS (SELECT doc_id, lang, {_leaf('text')} AS h,
  {_leaf(f"(CASE WHEN crc % 3 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END)")} AS altered FROM crc),
place AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS size,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM leaf),
{_tree('place', 'n', _LEVELS)},
langs AS (SELECT -1 AS tree, tree AS idx, count(*) OVER () AS size, h FROM n_root),
{_tree('langs', 't', _TOP_LEVELS)},
start AS (SELECT *, -1 AS top, '' AS proof, altered AS fold FROM place),
{", ".join(_climb('start', 'n', _LEVELS, 'tree', 'idx') + _climb(f'n_c{_LEVELS}', 't', _TOP_LEVELS, 'top', 'tree'))}
SELECT c.doc_id, c.h AS leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
  fold = r.h AS verified
FROM t_c{_TOP_LEVELS} c JOIN n_root s ON s.tree = c.tree CROSS JOIN t_root r
"""

DIVERGENCE = f"""
WITH doc AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents),
word AS (SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM doc),
vocabulary AS (SELECT lang, term, count(*)::HUGEINT AS total FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS lang_n FROM vocabulary GROUP BY lang),
seen AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM word JOIN vocabulary USING (lang, term) GROUP BY ALL),
grp AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS group_n FROM (SELECT DISTINCT lang, source FROM doc) g
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source GROUP BY ALL),
cell AS (SELECT g.lang, g.source, v.term, coalesce(s.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(s.n, 0) + 1) // (group_n + l.v) AS p,
    1 + 1000000000::HUGEINT * (v.total + 1) // (l.lang_n + l.v) AS q
  FROM grp g JOIN langs l USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = v.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM cell WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank
FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs)
UNION ALL BY NAME
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms) WHERE rank <= 200
"""


def _licences() -> str:
    """The scan of licence notices; the lists of fixed words and their weights are the operator's own."""
    index = Index()
    words = ", ".join(f"({t}, '{index.labels[t]}', {q}, '{index.words[w]}', {index.weight[w]}, {len(ws)}, {index.weight[ws].sum()})"
                      for t, ws in enumerate(index.templates) for q, w in enumerate(ws.tolist()))
    rare = ", ".join(f"({t}, {q}, '{index.words[w]}')" for t, q, w in index.postings)

    def listed(phrase) -> str:
        return "[" + ", ".join(f"'{index.words[w]}'" for w in phrase.tolist()) + "]"

    phrases = ", ".join(f"({t}, {listed(p)}, {len(p)})" for t, ps in enumerate(index.phrases) for p in ps)
    base = ", ".join(f"({listed(p)}, {len(p)}, '{label}')" for p, label in index.base)
    return f"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
tword(t, label, q, w, weight, len, total) AS (VALUES {words}),
rare(t, q, w) AS (VALUES {rare}),
phrase(t, p, len) AS (VALUES {phrases}),
base(p, len, label) AS (VALUES {base}),
word AS (SELECT d, w, pos FROM (SELECT d, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM doc) WHERE w IN (SELECT w FROM tword)),
based AS (SELECT d, pos, label FROM word JOIN base ON w = p[1] JOIN doc USING (d) WHERE ws[pos + 1 : pos + base.len] = p),
proposal AS (SELECT DISTINCT d, t, pos - q + shift AS place FROM word JOIN rare USING (w) CROSS JOIN range(-2, 3) s(shift)),
covered AS (SELECT d, t, place, label, len, total, sum(weight) AS weight FROM (
    SELECT DISTINCT c.d, c.t, c.place, x.label, x.q, x.len, x.total, x.weight FROM proposal c JOIN tword x ON x.t = c.t
    JOIN word o ON o.d = c.d AND o.w = x.w AND o.pos BETWEEN c.place + x.q - 2 AND c.place + x.q + 2) GROUP BY ALL
  HAVING sum(weight) * 1000 >= total * 600),
stands AS (SELECT d, t, p, pos, phrase.len AS plen FROM word JOIN phrase ON w = p[1] JOIN doc USING (d) WHERE ws[pos + 1 : pos + phrase.len] = p),
verified AS (SELECT c.d, c.t, c.place, label, weight / total AS score FROM covered c JOIN phrase f ON f.t = c.t
  LEFT JOIN stands s ON s.d = c.d AND s.t = c.t AND s.p = f.p AND s.pos >= c.place - 2 AND s.pos + s.plen <= c.place + c.len + 2
  GROUP BY c.d, c.t, c.place, label, weight, total HAVING count(DISTINCT f.p) = count(DISTINCT s.p)),
b AS (SELECT d, count(*) AS n, min(pos)::BIGINT AS lo, max(pos)::BIGINT AS hi FROM based GROUP BY d),
bl AS (SELECT d, string_agg(label, ',' ORDER BY label) AS l FROM (SELECT DISTINCT d, label FROM based) GROUP BY d),
al AS (SELECT d, string_agg(label, ',' ORDER BY label) AS l FROM (SELECT d, label FROM based UNION SELECT d, label FROM verified) GROUP BY d),
sc AS (SELECT d, max(score) AS score FROM verified GROUP BY d)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo AS first_word, hi AS last_word,
  coalesce(bl.l, '') AS base_labels, coalesce(al.l, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN b USING (d) LEFT JOIN bl USING (d) LEFT JOIN al USING (d) LEFT JOIN sc USING (d)
"""


LLM_ORACLES: dict[str, str] = {
    "op11_merkle_manifest": MERKLE, "op12_licence_index": _licences(), "op13_source_divergence": DIVERGENCE,
}
