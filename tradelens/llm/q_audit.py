"""Query on filters and their interaction: op12."""

from __future__ import annotations

from tradelens.llm import audit
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op12_filter_audit", sql=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS failed
  FROM w LEFT JOIN l USING (doc_id)
), p AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT '' AS filter_order, 0 AS bits
  UNION ALL SELECT filter_order || letter, bits + bit FROM o, letters WHERE (bits & bit) = 0
), steps AS (
  SELECT w.filter_order, s.step, letters.bit, b.bits AS before
  FROM (SELECT filter_order FROM o WHERE length(filter_order) = 5) w, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
  JOIN letters ON letters.letter = substr(w.filter_order, s.step, 1)
  JOIN o b ON b.filter_order = substr(w.filter_order, 1, s.step - 1)
), r AS (
  SELECT p.part, filter_order, step, bit,
         sum(CASE WHEN (failed & (bit | before)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (failed & bit) <> 0 AND (failed & before) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (failed & bit) <> 0 AND (failed & before) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (failed & bit) <> 0 AND (failed & before) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (failed & bit) <> 0 AND (failed & before) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM p, steps GROUP BY p.part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
""")
def op12_filter_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
