"""Arrow functions for what SQL lacks: NFKC and the full HTML entity table.

Each works on whole Arrow batches; nothing else in the text functions leaves the JVM.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nfkc(text: pa.Array) -> pa.Array:
    # Arrow's own NFKC kernel leaves letters decomposed, so the standard library does it
    done = [None if t is None else unicodedata.normalize("NFKC", t) for t in text.to_pylist()]
    return pa.array(done, pa.string())


@F.arrow_udf(T.StringType())
def nfkc(text: pa.Array) -> pa.Array:
    return _nfkc(text)


@F.arrow_udf(T.ArrayType(T.StringType()))
def nfkc_all(texts: pa.Array) -> pa.Array:
    flat = _nfkc(texts.values)
    return pa.ListArray.from_arrays(texts.offsets, flat, mask=texts.is_null())


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")
