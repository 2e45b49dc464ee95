"""Queries on tokens: op7 and op9."""

from __future__ import annotations

import os

from tradelens.llm import bpe, packing
from tradelens.llm.frames import table
from tradelens.llm.registry import register

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return f"{TOKENIZERS}/{name}" if TOKENIZERS else public_tokenizers.path(name)


@register("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    import public_tokenizers
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@register("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
