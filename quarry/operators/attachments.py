"""Attachment operators (A1-A5) over fetch results, and the page decoder hook.

Fetching itself is an I/O client outside Spark's scope; these operators
select what to fetch, validate what came back and account for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.order import first_n

PDF_MAGIC = b"%PDF"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_attachment(catalog: DataFrame, col: str = "pdf_url") -> DataFrame:
    """A1: rows with a non-empty attachment URL (position kept in ``idx``)."""
    return catalog.filter(F.nullif(F.col(col), F.lit("")).isNotNull())


def attachment_limit(df: DataFrame, max_downloads: int | None, order: str = "idx") -> DataFrame:
    """A2: first ``max_downloads`` in catalog order; None or 0 means all."""
    return first_n(df, [order], max_downloads) if max_downloads else df


def skip_existing(todo: DataFrame, listing: DataFrame, name: str = "file_name", overwrite: bool = False) -> DataFrame:
    """A3: ``action`` = skip when the target file exists (and no overwrite), else fetch.

    An existing file counts as a success, as a finished download would.
    """
    have = listing.select(F.col(name).alias("_have")).distinct()
    j = todo.join(have, todo[name] == have["_have"], "left")
    exists = F.col("_have").isNotNull()
    action = F.when(exists & F.lit(not overwrite), F.lit("skipped")).otherwise(F.lit("fetch"))
    return j.withColumn("action", action).drop("_have")


def fetch_status(status: Column | str, content: Column | str) -> Column:
    """A4: 'failed' unless HTTP 200; 'not_pdf' unless the body starts with %PDF; else 'ok'."""
    magic = F.substring(_c(content), 1, 4) == F.lit(PDF_MAGIC)
    return (
        F.when(_c(status) != 200, F.lit("failed"))
        .when(_c(content).isNull() | ~magic, F.lit("not_pdf"))
        .otherwise(F.lit("ok"))
    )


def fetch_summary(df: DataFrame, result: str = "result", content: str = "content") -> DataFrame:
    """A5: files and kilobytes per result."""
    return df.groupBy(result).agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.coalesce(F.sum(F.length(content)), F.lit(0)) / 1024.0, 3).alias("kb"),
    )


# ------------------------------------------------------------------- X1
def form_feed_decoder(data: bytes) -> list[str]:
    """Decoder for plain-text attachments: header line, pages separated by form feeds.

    Real PDF bytes need a PDF library; pass its page extractor to
    ``decode_pages`` instead. Unreadable input yields no pages.
    """
    try:
        text = data.decode("utf-8")
    except (UnicodeDecodeError, AttributeError):
        return []
    body = text.split("\n", 1)[1] if text.startswith("%PDF") and "\n" in text else text
    return body.split("\f")


def decode_pages(
    df: DataFrame, key: str = "path", content: str = "content", decoder: Callable[[bytes], list[str]] = form_feed_decoder
) -> DataFrame:
    """Bytes -> long page table ``(key, page_no, text)`` with a pluggable decoder.

    Runs in Arrow batches on the executors; a decoder error gives the
    document no pages (the assembled text is then '' and X10 drops it).
    """
    schema = f"{key} string, page_no int, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, nos, texts = [], [], []
            for k, data in zip(pdf[key], pdf[content]):
                try:
                    pages = decoder(bytes(data)) if data is not None else []
                except Exception:  # noqa: BLE001 - an unreadable file is an empty document
                    pages = []
                for i, t in enumerate(pages):
                    keys.append(str(k))
                    nos.append(i)
                    texts.append(t or "")
            yield pd.DataFrame({key: keys, "page_no": pd.Series(nos, dtype="int32"), "text": texts})

    return df.select(F.col(key).cast("string").alias(key), content).mapInPandas(run, schema)
