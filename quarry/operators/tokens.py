"""Native tokenisation used when no tokenizer plug-in is given.

Tokens are runs of word characters or single punctuation marks; this is a
JVM-side regular expression, so token counts stay in whole-stage codegen.
A real tokenizer can be plugged in with ``plugin_token_counts`` (Arrow
batches through a pandas UDF).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_RE = r"(?U)\w+|[^\w\s]"
TOKEN_RE2 = r"[\p{L}\p{Mn}\p{Mc}\p{Me}\p{Nd}\p{Pc}]+|[^\p{L}\p{Mn}\p{Mc}\p{Me}\p{Nd}\p{Pc}\s]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str, lower: bool = False) -> Column:
    t = _c(text)
    if lower:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(TOKEN_RE), 0)


def token_count(text: Column | str) -> Column:
    """M1 (native): number of tokens, no special tokens."""
    return F.regexp_count(_c(text), F.lit(TOKEN_RE)).cast("bigint")


def token_ids(text: Column | str) -> Column:
    """Stable integer ids for native tokens (first 6 hex digits of md5)."""
    return F.transform(tokens(text), lambda t: F.conv(F.substring(F.md5(t), 1, 6), 16, 10).cast("int"))


def plugin_token_counts(count_fn: Callable[[list[str]], list[int]]):
    """M1 plug-in: wrap a batch tokenizer (e.g. a Hugging Face tokenizer's
    ``__call__``) as an Arrow-batched pandas UDF returning counts.

    ``count_fn`` receives a list of texts and returns their token counts;
    it is called once per Arrow batch on the executors.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("bigint")
    def _count(texts: pd.Series) -> pd.Series:
        return pd.Series(count_fn(texts.fillna("").tolist()), dtype="int64")

    return _count
