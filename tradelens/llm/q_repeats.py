"""Queries on repeated text: op1 and op6."""

from __future__ import annotations

from tradelens.llm.frames import table
from tradelens.llm.registry import register
from tradelens.llm.substring_dedup import substring_dedup
from tradelens.llm.suffix_dedup import suffix_dedup


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))


@register("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))
