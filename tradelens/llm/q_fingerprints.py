"""Query on document fingerprints: op3."""

from __future__ import annotations

from tradelens.llm.fingerprints import fingerprint
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    return fingerprint(table(spark, sf_dir, "documents"))
