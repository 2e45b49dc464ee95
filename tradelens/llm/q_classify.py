"""Queries on learned decisions: op2 and op4."""

from __future__ import annotations

from tradelens.llm import quality, urls
from tradelens.llm.frames import table
from tradelens.llm.registry import register

#: The rule list of the URL query. Fixed values.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


@register("op2_quality")
def op2_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_url_filter")
def op4_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), RULES)
