"""SQL that the results of corpus operators must equal, where SQL can state them."""

from __future__ import annotations

from tunetables.llm import near_dup, secret_scan

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates_sql(shingle: int = near_dup.SHINGLE, similar: int = near_dup.SIMILAR) -> str:
    """Distinct shingles as text, all pairs that share one, and what can be reached from each document."""
    return rf"""
      WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'),
                                   lambda w: w <> '') AS w FROM documents),
      sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(w[i:i + {shingle} - 1], ' '))) END AS s
        FROM words),
      grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
      near AS MATERIALIZED (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {similar} * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {similar} * (a.n + b.n - count(*))),
      links AS MATERIALIZED (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
      reach AS (SELECT doc_id, doc_id AS other FROM sets
                UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
      SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
      FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = s.doc_id"""


def _matches(pattern: str, kind: int, group: int = 0) -> str:
    """Matches of a pattern with their places: what lies before a match is its pieces and earlier matches."""
    quoted = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, source, lang, kind, token, value, start, start + length(token) AS "end" FROM (
        SELECT doc_id, source, lang, {kind} AS kind, m[k] AS token, v[k] AS value,
               CAST(list_sum(list_transform(p[1:k], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (
          SELECT doc_id, source, lang, regexp_extract_all(body, '{quoted}') AS m, regexp_extract_all(body, '{quoted}', {group}) AS v,
                 regexp_split_to_array(body, '{quoted}') AS p FROM texts)))"""


def secrets_sql(owners: int = secret_scan.OWNERS, repositories: int = secret_scan.REPOSITORIES) -> str:
    """Base spans, and candidates apart from them that few owners and repositories have."""
    names = ", ".join(f"'{k}'" for k in secret_scan.KINDS)
    listed = f"""string_agg([{names}][kind + 1] || ':' || start || ':' || "end", ',' ORDER BY start, kind)"""
    return f"""
      WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS body FROM documents),
      base AS MATERIALIZED (
        SELECT * FROM ({_matches(secret_scan.ASSIGN, 0, 2)}) WHERE length(value) >= {secret_scan.LEAST_VALUE}
        UNION ALL {_matches(secret_scan.ACCESS, 1)}
        UNION ALL {_matches(secret_scan.HEX, 2)}),
      candidates AS MATERIALIZED (
        SELECT * FROM ({_matches(secret_scan.CANDIDATE, 3)}) c
        WHERE regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Za-z]')
          AND len(list_distinct(string_split(token, ''))) >= {secret_scan.LEAST_DIFFERENT}
          AND NOT regexp_matches(token, '{secret_scan.PLACEHOLDER}')
          AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c."end" AND c.start < b."end")),
      found AS (SELECT doc_id, source, lang, kind, value, start, "end" FROM base
                UNION ALL SELECT doc_id, source, lang, kind, value, start, "end" FROM candidates),
      seen AS (SELECT value, count(DISTINCT coalesce('=' || source, '')) < {owners}
                        AND count(DISTINCT coalesce('=' || source, '') || chr(10) || coalesce('=' || lang, '')) < {repositories} AS own
               FROM found GROUP BY value),
      spans AS (SELECT f.doc_id, f.kind, f.start, f."end", s.own AND (kind = 3 OR NOT regexp_matches(f.value, '{secret_scan.PLACEHOLDER}')) AS own
                FROM found f JOIN seen s ON s.value = f.value)
      SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             sha256(coalesce({listed} FILTER (kind < 3), '')) AS base_sha256,
             coalesce({listed} FILTER (own OR kind < 3), '') AS spans,
             count(*) FILTER (kind = 3 AND own) AS n_owned, count(*) FILTER (kind = 3 AND NOT own) AS n_copied,
             count(*) FILTER (kind < 3 AND own) AS n_base_owned, count(*) FILTER (kind < 3 AND NOT own) AS n_base_copied
      FROM texts t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id"""


def ranked_sql(k: int = 10) -> str:
    """Scores of all documents that share a term with an item, and the best of each item."""
    terms = rf"""unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
    return f"""
      WITH words AS MATERIALIZED (SELECT doc_id, {terms} AS t FROM documents),
      total AS (SELECT count(DISTINCT doc_id) AS nd, count(*) AS nt FROM words),
      lengths AS (SELECT doc_id, 25 + (75 * count(*) * any_value(nd)) // any_value(nt) AS m FROM words, total GROUP BY doc_id),
      asked AS MATERIALIZED (SELECT item_id, t, count(*) AS repeats FROM (SELECT item_id, {terms} AS t FROM benchmark) GROUP BY item_id, t),
      counts AS MATERIALIZED (SELECT doc_id, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
      weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, total GROUP BY t),
      scores AS (
        SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM asked JOIN weights USING (t) JOIN counts USING (t) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id)
      SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
      WHERE rank <= {k}"""


def negatives_sql() -> str:
    """Every anchor with every row, then the best of its label, then the best of other labels in each window."""
    return """
      WITH good AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      pairs AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM good a JOIN good b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
      positives AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM pairs WHERE same)
        WHERE place <= 5)
      SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
        SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS place
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
          AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
      WHERE place <= 3"""


ORACLES: dict[str, str] = {"op6_secrets": secrets_sql(), "op8_near_duplicates": near_duplicates_sql(), "op11_hard_negatives": negatives_sql(), "op12_lexical_search": ranked_sql()}
