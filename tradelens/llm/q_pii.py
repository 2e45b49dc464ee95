"""Query on personal data: op8."""

from __future__ import annotations

from tradelens.llm import pii
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op8_pii")
def op8_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))
