"""Query on vectors: op10."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.llm.ann import nearest
from tradelens.llm.frames import table
from tradelens.llm.registry import register


@register("op10_nearest")
def op10_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
