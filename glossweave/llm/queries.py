"""The queries and oracle SQL of this subpackage."""

from glossweave.llm import codes, divergence
from glossweave.llm.bpe import op5_bpe
from glossweave.llm.codes import op13_codes
from glossweave.llm.divergence import op11_divergence
from glossweave.llm.lm import op12_lm
from glossweave.llm.media import op1_media
from glossweave.llm.mixing import op7_mixing
from glossweave.llm.neardup import op2_neardup
from glossweave.llm.pii import op3_pii
from glossweave.llm.quality import op6_quality
from glossweave.llm.repeats import op4_repeats
from glossweave.llm.secrets import op8_secrets
from glossweave.llm.token_files import op10_token_files
from glossweave.llm.topk import op9_topk

QUERIES = {
    "op1_media": op1_media,
    "op2_neardup": op2_neardup,
    "op3_pii": op3_pii,
    "op4_repeats": op4_repeats,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_topk": op9_topk,
    "op10_token_files": op10_token_files,
    "op11_divergence": op11_divergence,
    "op12_lm": op12_lm,
    "op13_codes": op13_codes,
}

ORACLE_SQL = {
    "op11_divergence": divergence.SQL,
    "op13_codes": codes.sql(),
    "op9_topk": r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op7_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sizes),
weighed AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM placed),
running AS (
  SELECT *, coalesce(sum(source_size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
    sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM weighed
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, (1.5::DOUBLE * all_size::DOUBLE - 2.0::DOUBLE * size_before::DOUBLE) / (all_weight - weight_before)::DOUBLE AS c FROM running),
level AS (SELECT c FROM levels WHERE c * weight <= 2.0::DOUBLE * source_size ORDER BY weight_before LIMIT 1),
plan AS (
  SELECT source, source_size, coalesce(least(2.0::DOUBLE * source_size, (SELECT c FROM level) * weight), 2.0::DOUBLE * source_size) AS target FROM weighed),
classes AS (
  SELECT source, length(size::VARCHAR) AS digits, sum(size)::BIGINT AS size, (sum(size) * length(size::VARCHAR))::DOUBLE AS weight FROM sized WHERE size > 0 GROUP BY source, length(size::VARCHAR)),
class_levels AS (
  SELECT c.*, (p.target - 2.0::DOUBLE * coalesce(sum(c.size) OVER w, 0)::DOUBLE) / (sum(c.weight) OVER (PARTITION BY c.source) - coalesce(sum(c.weight) OVER w, 0)) AS c, coalesce(sum(c.weight) OVER w, 0) AS weight_before
  FROM classes c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source
  WINDOW w AS (PARTITION BY c.source ORDER BY c.size / c.weight, c.digits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
source_level AS (SELECT source, min_by(c, weight_before) AS level FROM class_levels WHERE c * weight <= 2.0::DOUBLE * size GROUP BY source),
rated AS (
  SELECT s.*, p.source_size, p.target, coalesce(least(2.0::DOUBLE, l.level * length(s.size::VARCHAR)), 2.0::DOUBLE) AS expected
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN source_level l ON s.source IS NOT DISTINCT FROM l.source),
parts AS (SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS part FROM rated),
odds AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS o FROM parts),
ranked AS (
  SELECT *, CASE WHEN part > 0 THEN o / (1 + o) END AS q,
    target - sum(size * whole) OVER (PARTITION BY source) AS missing FROM odds),
cum AS (
  SELECT source, q, missing, sum(size) OVER (PARTITION BY source ORDER BY q) AS words_to FROM ranked WHERE q IS NOT NULL),
choices AS (
  SELECT source, q, abs(words_to - missing) AS off FROM cum
  UNION ALL SELECT DISTINCT source, -1::DOUBLE, abs(missing) FROM cum),
cuts AS (SELECT source, q AS cut FROM choices QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, q) = 1)
SELECT r.doc_id, r.size, r.source_size::BIGINT AS source_size, r.target,
  (r.size * (r.whole + CASE WHEN r.q <= c.cut THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked r LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
""",
}
