"""DuckDB text of the queries that SQL can express."""

from wakeline.llm.license_digest import COPYRIGHT_LINE, LICENCE_WORD, SPELLINGS
from wakeline.llm.license_texts import KNOWN

ORACLES: dict[str, str] = {}

ORACLES["op10_winnowing"] = r"""
WITH lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, n, w[p : p + n - 1] AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0))),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, p, w[p : p + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, p, d.n, item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.win = i.win),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM found) GROUP BY doc_id),
matched AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN matched USING (doc_id)
"""

ORACLES["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, w[p : p + n - 1] AS s
  FROM (SELECT doc_id, w, least(len(w), 5) AS n, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM edges UNION SELECT node, b FROM reach JOIN edges ON seen = a),
lowest AS (SELECT node, min(seen) AS low FROM reach GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(low, w.doc_id) AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN lowest ON node = w.doc_id
"""

ORACLES["op2_suffix_trees"] = r"""
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, p, w[p : p + 12] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words)),
lowest AS (SELECT win, min(doc_id) AS low FROM windows GROUP BY win),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM windows JOIN lowest USING (win) WHERE low < doc_id),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (p <> before + 1 OR before IS NULL) AS n_spans, list(p) AS gone
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words) ANTI JOIN hit USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM words LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op9_suffix_intervals"] = r"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS win
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM bytes)),
lowest AS (SELECT win, min(doc_id) AS low FROM windows GROUP BY win),
repeat AS (SELECT doc_id, p FROM windows JOIN lowest USING (win) WHERE low < doc_id),
starts AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM repeat),
numbered AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM starts),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY ALL),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS pieces
  FROM edges JOIN bytes USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(pieces, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), {quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    for pattern, word in SPELLINGS:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(word.replace('$', chr(92)))}, 'g')"
    return rf"sha256(trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')))"


ORACLES["op4_license_digests"] = rf"""
WITH texts(license, t) AS (VALUES {", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in KNOWN)}),
known AS (SELECT d, min(license) AS license FROM (SELECT license, {canonical("t")} AS d FROM texts) GROUP BY d),
lines AS (
  SELECT doc_id, unnest(l) AS t, CAST(unnest(range(1, len(l) + 1)) AS BIGINT) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
units AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS line, {canonical("coalesce(text, '')")} AS canonical_sha256 FROM documents
  UNION ALL SELECT doc_id, line, {canonical("t")} FROM lines WHERE regexp_matches(t, {quoted(LICENCE_WORD)}))
SELECT doc_id, line, canonical_sha256, license FROM units LEFT JOIN known ON d = canonical_sha256
WHERE line = 0 OR license IS NOT NULL
"""


def merkle_levels(first: str, grp: str, levels: int) -> str:
    """Tables ``{first}1`` to ``{first}{levels}`` of nodes above ``{first}0(grp, pos, h)``, and each level's runs of siblings."""
    out = []
    for k in range(levels):
        out.append(
            f"{first}s{k} AS (SELECT *, count(*) OVER (PARTITION BY {grp}) AS m FROM {first}{k}),"
            f"{first}{k + 1} AS (SELECT {grp}, pos // 8 AS pos, CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h "
            f"FROM {first}s{k} GROUP BY {grp}, pos // 8, m)"
        )
    return ",".join(out)


def merkle_path(first: str, grp: str, start: str, pos: str, levels: int, out: str) -> str:
    """Table ``{out}``: ``start`` rows with the siblings of each level in the list ``path``."""
    sides = ",".join(
        f"{{'l': coalesce(a{k}.l, ''), 'r': coalesce(a{k}.r, ''), 'f': a{k}.m > 1}}" for k in range(levels)
    )
    joins = " ".join(
        f"JOIN (SELECT {grp} AS g, pos, m, string_agg(h, '') OVER (PARTITION BY {grp}, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, "
        f"string_agg(h, '') OVER (PARTITION BY {grp}, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM {first}s{k}) a{k} "
        f"ON a{k}.g = s.{grp} AND a{k}.pos = s.{pos} // {8 ** k}"
        for k in range(levels)
    )
    return f"{out} AS (SELECT s.*, [{sides}] AS path FROM {start} s {joins})"


def framed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: One byte of CRC-32: eight times shift and reduce.
_CRC_BYTE = "list_reduce([xor(c, CAST(ascii(substr(digits, k, 1)) AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
#: Unrolled for up to 8 ** 7 rows a language.
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, text,
         sha256({" || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         sha256({" || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {framed(_LOWERED)}) AS changed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos
  FROM documents),
crc(doc_id, digits, k, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, digits, k + 1, {_CRC_BYTE} FROM crc WHERE k <= strlen(digits)),
hit AS (SELECT doc_id FROM crc WHERE k = strlen(digits) + 1 AND xor(c, 4294967295) % 3 = 0),
n0 AS (SELECT grp, pos, leaf AS h FROM leaves),
{merkle_levels("n", "grp", 7)},
tops AS (SELECT grp, h AS subroot, 1 AS one, row_number() OVER (ORDER BY grp) - 1 AS spot FROM n7),
t0 AS (SELECT one, spot AS pos, subroot AS h FROM tops),
{merkle_levels("t", "one", 3)},
{merkle_path("n", "grp", "leaves", "pos", 7, "low")},
{merkle_path("t", "one", "tops", "spot", 3, "high")},
proofs AS (
  SELECT l.doc_id, leaf, subroot, t3.h AS root, list_concat(l.path, h.path) AS path,
         CASE WHEN hit.doc_id IS NULL THEN leaf ELSE changed END AS start
  FROM low l JOIN high h USING (grp) CROSS JOIN t3 LEFT JOIN hit ON hit.doc_id = l.doc_id),
{",".join(
    f"f{k + 1} AS (SELECT * EXCLUDE (start), CASE WHEN path[{k + 1}].f THEN sha256(path[{k + 1}].l || start || path[{k + 1}].r) ELSE start END AS start "
    f"FROM {'proofs' if k == 0 else f'f{k}'})" for k in range(10)
)}
SELECT doc_id, leaf, subroot, root,
       sha256({" || ".join(f"path[{k}].l || path[{k}].r" for k in range(1, 11))}) AS proof_sha256,
       start AS folded_root, start = root AS verified
FROM f10
"""

ORACLES["op13_cap_filters"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT node, b FROM reach JOIN links ON seen = a),
lowest AS (SELECT node, min(seen) AS low FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(low, vec_id) AS component_id, vec_id = coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN lowest ON node = vec_id LEFT JOIN counts ON a = vec_id
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
known AS (
  SELECT lang, size, array_to_string(w[p : p + size - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 100),
whole AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM known WHERE size > 1),
cuts AS (SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM whole),
scores AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n,
         CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN known l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN known r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 : c.size], ' ')),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS first FROM scores),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[p : p + part - 1], ' ') AS phrase, a
  FROM (SELECT lang, w, a, part, unnest(range(1, size - part + 2)) AS p FROM whole, (SELECT unnest(range(2, 5)) AS part) WHERE part < size)),
longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (
  SELECT lang, phrase, a, l, r, n, score FROM least LEFT JOIN longer USING (lang, phrase)
  WHERE first = 1 AND (most IS NULL OR 100 * most < 100 * a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""
