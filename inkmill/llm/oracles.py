"""SQL that gives the rows of the queries that SQL can express.

The other queries (shards, hashed n-grams, library tokens, MinHash components, spans, templates) are held against
plain Python in ``tests/llm``.
"""

from __future__ import annotations

SQL: dict[str, str] = {
    "op3_chat_format": """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, 2 * length(text) - length(translate(text, '\\<[', '')) + 2 * length(role) - length(translate(role, '\\<[|', '')) + 13 AS shown FROM c),
     g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(shown)::BIGINT AS formatted_chars,
             string_agg(role, ',' ORDER BY turn, role, text) AS roles FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  CASE WHEN roles = 'user,assistant' THEN 'prompt' WHEN roles = 'system,user,assistant' THEN 'instruction'
       WHEN split_part(roles, ',', 1) = 'user' AND NOT regexp_matches(roles, '(^|,)(human|gpt)(,|$)') THEN 'sharegpt' ELSE 'messages' END AS layout
FROM g""",
    # The given pages hold no redirect and no canonical link.
    "op10_url_filter": """
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
     r AS (SELECT *, CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                          WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                          WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                          WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op11_hard_negatives": """
WITH e AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
       FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
       FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
     n AS (SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
           FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
