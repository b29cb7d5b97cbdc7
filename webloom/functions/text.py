"""Document text and tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters that make up a token.
TOKEN_CHARS = "a-z0-9áéíóúñ"
# Rows whose words are counted together.
ROWS_AT_ONCE = 500


def normalise(text: Column, token_chars: str = TOKEN_CHARS) -> Column:
    """Lower case; every run of other characters becomes one space."""
    return F.regexp_replace(F.lower(text), f"[^{token_chars}]+", " ")


def token_array(text: Column, token_chars: str = TOKEN_CHARS) -> Column:
    """Tokens in order: what normalising and splitting at spaces gives, in one scan.

    Looking for the runs of token characters is several times faster than looking
    for what lies between them.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{token_chars}]+"), F.lit(0))


def count_words(rows: DataFrame, text: str, word: str) -> DataFrame:
    """(token, tf, other columns of ``rows``): matches of the pattern ``word`` in each row's ``text``.

    Counted on Arrow batches, ``ROWS_AT_ONCE`` rows at a time, because Spark's functions on
    arrays are interpreted word by word. A row without words gives nothing.
    """
    others = [c for c in rows.columns if c != text]
    counted = [T.StructField("token", T.StringType()), T.StructField("tf", T.LongType())]
    schema = T.StructType(counted + [rows.schema[c] for c in others])
    names, n_others, at_once = schema.names, len(others), ROWS_AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(word).findall
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                batch = whole.slice(at, at_once)
                counts = [Counter(find(t)) if t else {} for t in batch.column(0).to_pylist()]
                row = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
                tokens = pa.array(list(chain.from_iterable(counts)), pa.string())
                tf = pa.array(list(chain.from_iterable(c.values() for c in counts)), pa.int64())
                rest = [batch.column(k + 1).take(row) for k in range(n_others)]
                yield pa.RecordBatch.from_arrays([tokens, tf, *rest], names=names)

    return rows.select(text, *others).mapInArrow(run, schema)


def query_terms(text: Column) -> Column:
    """Distinct search terms: lower-cased words, punctuation kept."""
    words = F.split(F.lower(text), r"\s+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def document_text(
    domain: Column, real_path: Column, url: Column, tags: Column, texts: Column
) -> Column:
    """All searchable text of a page; the domain counts once alone and once in the URL."""
    return F.concat_ws(
        " ",
        domain,
        F.regexp_replace(real_path, "[/-]", " "),
        url,
        F.concat_ws(" ", tags),
        F.concat_ws(" ", texts["h1"]),
        F.concat_ws(" ", texts["h2"]),
        F.concat_ws(" ", texts["p"]),
    )
