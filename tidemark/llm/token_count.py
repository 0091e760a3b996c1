"""Operator 1, token counts: batch encoding in an Arrow function that returns lengths only.

Texts are taken in slices of bounded bytes, cut into fragments at safe boundaries (so a very long text is many
short ones), and fragments not yet known are encoded in batches balanced by bytes. One narrow pass, no shuffle.
"""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import id_text, record_batch, slices
from tidemark.llm.fragments import encoder

SCHEMA = "doc_id long,n_bytes long,n_tokens long,over_limit boolean"
#: Tokens above which a document is reported as over the limit.
LIMIT = 512


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for each row of ``docs``.

    A null text counts as empty (0 bytes, 0 tokens); a null id stays null; equal rows each give a row; an empty
    table gives none; other columns of ``docs`` are neither read nor returned.
    """

    def run(batches):
        model = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                n = [len(ids) >> 2 for ids in model.encode(part.column(1).to_pylist())]
                yield record_batch([part.column(0), pc.cast(pc.binary_length(part.column(1)), "int64"), n, [x > limit for x in n]], SCHEMA)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA.replace(",", ", "))
