"""Query on periodic runs: op11."""

from __future__ import annotations

from tradelens.llm import periodic
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    return periodic.digest(periodic.planted(table(spark, sf_dir, "documents")))
