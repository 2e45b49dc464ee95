"""Query on exact copies: op13."""

from __future__ import annotations

from tradelens.llm import exact
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op13_exact_dedup", sql="""
WITH r AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM r
""")
def op13_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))
