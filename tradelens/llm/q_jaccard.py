"""Query on similar documents: op5."""

from __future__ import annotations

from tradelens.llm.frames import table
from tradelens.llm.jaccard import link
from tradelens.llm.registry import register


@register("op5_jaccard_join")
def op5_jaccard_join(spark, sf_dir):
    return link(table(spark, sf_dir, "documents"))
