"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

#: Digests of payloads that occur more than once from 1000 bytes on; the largest page is the response.
OP4 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM m
"""

#: Every window of every item, looked up among the document's windows of the same length.
OP10 = r"""
WITH RECURSIVE letters AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, letters WHERE text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, i, i + least(13, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
        FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, letters
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM docs, lengths WHERE len(w) >= n)
), hits AS (
  SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.win = b.win
), words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: Shingle sets as lists of distinct word triples; pairs meet on a shared shingle; components spread by smallest id.
OP3 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[ 	-
]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
                 END AS s
  FROM docs
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), classes AS (
  SELECT min(doc_id) AS rep, any_value(s) AS s, len(any_value(s)) AS n
  FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), grams AS (
  SELECT rep, n, unnest(s) AS g FROM classes
), pairs AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep
   AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep
), links AS (
  SELECT a, b FROM pairs WHERE 100 * common >= 85 * (na + nb - common)
  UNION SELECT b, a FROM pairs WHERE 100 * common >= 85 * (na + nb - common)
), reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a AS rep, least(a, min(b)) AS component FROM reach GROUP BY a
), members AS (
  SELECT s.doc_id, len(s.s) AS n, c.rep FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = list_sort(c.s)
)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles, coalesce(component, m.rep, m.doc_id) AS component_id,
       m.doc_id = coalesce(component, m.rep, m.doc_id) AS kept
FROM members m LEFT JOIN smallest USING (rep)
"""

#: The units of each text as a list; the four numbers from the digest of the id; parts joined again.
OP13 = r"""
WITH h AS (
  SELECT *, sha256('1:' || CAST(doc_id AS VARCHAR)) AS x, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents
), numbers AS (
  SELECT doc_id, t, u, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4
  FROM h
), cuts AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT doc_id, t, form, len(u) AS n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""


def _op12() -> str:
    """Windows and lines as rows; candidate cutoffs as rows; binomial tails as sums of terms by ``lgamma``."""
    from filegate.llm.qualityrules import DELTA, RISK, RULES

    candidates = ", ".join(f"('{r.name}', {i}, CAST({c!r} AS DOUBLE))" for r in RULES for i, c in enumerate(r.cutoffs, 1))
    values = " UNION ALL ".join(
        f"SELECT r, doc_id, stratum, base_failed, '{r.name}' AS rule, {r.measure.replace('0.0D', '0.0')} AS x FROM base"
        for r in RULES)
    return rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('s' || lang, 'n') AS stratum, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words
), windows AS (
  SELECT r, unnest(g) AS g, generate_subscripts(g, 1) AS i
  FROM (SELECT r, [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] AS g
        FROM words WHERE len(w) >= 3)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(d) GROUP BY r
), counts AS (
  SELECT r, doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words JOIN lines USING (r) LEFT JOIN covered USING (r)
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), measures AS (
  {values}
), candidates(rule, step, cutoff) AS (
  VALUES {candidates}
), good AS (
  SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) > 0
), tested AS (
  SELECT stratum, rule, step, cutoff, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(x > cutoff) AS DOUBLE) AS k
  FROM measures SEMI JOIN good USING (doc_id) JOIN candidates USING (rule)
  WHERE NOT base_failed GROUP BY ALL
), tails AS (
  SELECT stratum, rule, step, cutoff, CASE WHEN k > n * {RISK / len(RULES)!r} THEN 1.0 ELSE list_sum(list_transform(
           range(0, CAST(k AS BIGINT) + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
             + j * ln({RISK / len(RULES)!r}) + (n - j) * ln(1 - {RISK / len(RULES)!r})))) END AS p
  FROM tested
), accepted AS (
  SELECT *, max(p) OVER (PARTITION BY stratum, rule ORDER BY step) AS worst FROM tails
), chosen AS (
  SELECT stratum, rule, arg_max(cutoff, step) AS cutoff FROM accepted
  WHERE worst <= {DELTA!r} / ((SELECT count(DISTINCT stratum) FROM tested) * {len(RULES)}) GROUP BY ALL
), order_of(rule, place) AS (
  VALUES {", ".join(f"('{r.name}', {i})" for i, r in enumerate(RULES))}
), rejected AS (
  SELECT r, string_agg(rule, ',' ORDER BY place) AS failed_rules
  FROM measures JOIN chosen USING (stratum, rule) JOIN order_of USING (rule) WHERE x > cutoff GROUP BY r
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
FROM base LEFT JOIN rejected USING (r)
"""


def _tree(nodes: str, name: str, levels: int = 6) -> str:
    """Levels of the trees of ``nodes`` (tree, pos, d), 16 to a run, as CTEs: runs as lists, then the nodes above."""
    parts, below = [], nodes
    for i in range(levels):
        parts.append(f"""{name}_runs{i} AS (
  SELECT tree, pos // 16 AS run, list(d ORDER BY pos) AS ds, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {below}) GROUP BY tree, pos // 16
), {name}_level{i} AS (
  SELECT tree, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}_runs{i}
)""")
        below = f"{name}_level{i}"
    return ", ".join(parts)


def _path(start: str, tree: str, pos: str, node: str, carry: str, name: str, levels: int = 6) -> str:
    """``node`` and the siblings beside it carried up the levels of the tree, as CTEs over ``start``."""
    parts, below = [], start
    for i in range(levels):
        parts.append(f"""{name}{i} AS (
  SELECT {carry}, p.{tree}, p.{pos} // 16 AS {pos},
         CASE WHEN n > 1 THEN p.sib || array_to_string(list_concat(ds[1:p.{pos} % 16], ds[p.{pos} % 16 + 2:]), '')
              ELSE p.sib END AS sib,
         CASE WHEN n > 1 THEN sha256(array_to_string(list_concat(list_append(ds[1:p.{pos} % 16], p.{node}),
                                                                 ds[p.{pos} % 16 + 2:]), '')) ELSE p.{node} END AS {node}
  FROM {below} p JOIN {name}_runs{i} r ON p.{tree} = r.tree AND p.{pos} // 16 = r.run
)""")
        below = f"{name}{i}"
    return ", ".join(parts)


def _field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _op11() -> str:
    """Leaves, levels and paths unrolled: six levels of 16 for the leaves of a source, six for the sources."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    head = " || ".join(map(_field, fields))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, sha256({head} || {_field('text')}) AS d,
         sha256({head} || {_field(low)}) AS lowered,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)),
             lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, b)),
             4294967295::BIGINT), 4294967295) % 5 = 0 AS hit
  FROM documents
), nodes AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, d) - 1 AS pos FROM leaves
), {_tree("nodes", "a")}, sources AS (
  SELECT 'all' AS tree, tree AS source, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a_level5
), {_tree("sources", "b")}, start AS (
  SELECT doc_id, d AS leaf, tree, pos, '' AS sib, CASE WHEN hit THEN lowered ELSE d END AS h FROM nodes
), {_path("start", "tree", "pos", "h", "p.doc_id, p.leaf", "a")}, middle AS (
  SELECT p.doc_id, p.leaf, p.sib, p.h, s.d AS subroot, 'all' AS tree, s.pos
  FROM a5 p JOIN sources s ON p.tree = s.source
), {_path("middle", "tree", "pos", "h", "p.doc_id, p.leaf, p.subroot", "b")}
SELECT doc_id, leaf, subroot, (SELECT d FROM b_level5) AS root, sha256(sib) AS proof_sha256, h AS folded_root,
       h = (SELECT d FROM b_level5) AS verified
FROM b5
"""


def statements() -> dict[str, str]:
    """SQL per query name."""
    return {"op3_near_duplicates": OP3, "op4_warc": OP4, "op10_decontamination": OP10,
            "op11_merkle_manifest": _op11(), "op12_quality_rules": _op12(), "op13_fill_in_middle": OP13}
