"""Collection run: article urls, then article pages, then attachments.

``urls``      links of listing pages -> new catalog rows, up to a target
``scrape``    pages of catalog rows without a record -> article records, catalog update
``download``  attachments of catalog rows without a file -> files with their outcome

Fetching is the caller's: a function from the rows to fetch to what came back.
Each phase is a recorded step of its own outputs, so a run that is called again
goes on where the last one ended, and the catalog follows the records written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.manifest import Manifest, parquet_step
from quarry.operators import attachments as A
from quarry.operators import discover as C
from quarry.operators import pages as P
from quarry.operators.order import first_n

RECORDS = "idx bigint, article_id string, name string, url string, title string, date string, pdf_url string, content string, scraped_at string"
FILES = "idx bigint, file_name string, url string, status int, result string, content binary"


@dataclass
class Collected:
    """The manifest of a run and its catalog; records and files are all that was ever written."""

    manifest: Manifest
    catalog: DataFrame

    @property
    def records(self) -> DataFrame:
        return self.manifest.read("records", RECORDS)

    @property
    def files(self) -> DataFrame:
        return self.manifest.read("files", FILES)


def catalog_of(m: Manifest) -> DataFrame:
    """The catalog as last written; empty before that."""
    done = m.outputs("catalog")
    return m.spark.read.schema(C.CATALOG_SCHEMA).parquet(done[-1][1]) if done else m.spark.createDataFrame([], C.CATALOG_SCHEMA)


def _keep(m: Manifest, catalog: DataFrame, inputs: list[str]) -> None:
    m.step("catalog", inputs, parquet_step(catalog))
    m.drop_superseded("catalog")


def collect_urls(m: Manifest, listing: DataFrame, target: int, pattern: str, page: str = "page_id") -> int:
    """New ids in (page, position) order until the catalog has ``target`` rows; how many were added."""
    catalog = catalog_of(m)
    n = catalog.count()
    if n >= target:
        return 0
    links = C.dedup_keep_first(C.extract_links(listing, page=page, pattern=pattern), [], [page, "pos"])
    known = catalog.select(C.article_id_of("article_id", "url").alias("id"))
    new = C.catalog_stub(C.target_limit(C.new_ids_anti(links, known), n, target, [page, "pos"]))
    _keep(m, C.catalog_append(catalog, new, n, [page, "pos"]).select(*catalog.columns), [])
    return catalog_of(m).count() - n


def scrape_articles(m: Manifest, fetch: Callable[[DataFrame], DataFrame], scraped_at: Column, most: int | None = None) -> None:
    """``fetch`` gets (idx, url) of rows still to scrape and returns (idx, html) of pages that came back.

    Pages without text leave no record and are asked for again by the next run.
    """
    catalog = catalog_of(m)
    aid = C.article_id_of("article_id", "url")
    done = m.read("records", RECORDS).select("article_id").distinct()
    todo = catalog.filter(~F.coalesce("scraped", F.lit(False))).withColumn("_id", aid)
    todo = todo.join(done, todo["_id"] == done["article_id"], "left_anti").select("idx", "url", F.col("_id").alias("article_id"))
    todo = first_n(todo, ["idx"], most) if most else todo
    came = fetch(todo.select("idx", "url")).select(F.col("idx").alias("_i"), "html")
    rows = came.join(todo, F.col("_i") == F.col("idx")).select(F.to_json(F.struct("idx", "article_id", F.col("url").alias("u"))).alias("url"), "html")
    record = P.article_records(rows, scraped_at)  # the row's place and id travel in the url's stead
    row = F.from_json("url", "idx bigint, article_id string, u string")
    record = record.withColumn("_r", row).select("_r.idx", "_r.article_id", C.scraped_filename("_r.idx", "_r.article_id", "title").alias("name"), F.col("_r.u").alias("url"), "title", "date", "pdf_url", "content", "scraped_at")
    m.step("records", [p for _, p in m.outputs("catalog")], parquet_step(record))
    _keep(m, C.catalog_upsert(catalog, m.read("records", RECORDS)), [p for _, p in m.outputs("records")])


def download_files(m: Manifest, fetch: Callable[[DataFrame], DataFrame], most: int | None = None, overwrite: bool = False) -> None:
    """A1-A4: ``fetch`` gets (idx, url, file_name) of attachments without a good file and returns (idx, status, content)."""
    todo = A.attachment_limit(A.has_attachment(catalog_of(m)), most)
    todo = todo.select("idx", F.col("pdf_url").alias("url"), C.pdf_filename("idx", "title").alias("file_name"))
    have = m.read("files", FILES).filter("result = 'ok'").select("file_name")
    todo = A.skip_existing(todo, have, overwrite=overwrite).filter("action = 'fetch'").drop("action")
    came = fetch(todo).select(F.col("idx").alias("_i"), "status", "content")
    x = came.join(todo, F.col("_i") == F.col("idx")).withColumn("result", A.fetch_status("status", "content"))
    kept = F.when(F.col("result") == "ok", F.col("content"))
    m.step("files", [p for _, p in m.outputs("catalog")], parquet_step(x.select("idx", "file_name", "url", F.col("status").cast("int").alias("status"), "result", kept.alias("content"))))


def collect(
    spark: SparkSession,
    folder: str,
    listing: DataFrame,
    target: int,
    fetch_pages: Callable[[DataFrame], DataFrame] | None = None,
    fetch_files: Callable[[DataFrame], DataFrame] | None = None,
    scraped_at: Column | None = None,
    pattern: str = fixed.ARTICLE_LINK_PATTERN,
    max_downloads: int | None = None,
) -> Collected:
    """Runs the phases whose fetcher is given, after the collection of urls, in ``folder`` (shared storage).

    ``listing`` holds (page_id, html). As many articles are scraped in one run as
    the target has rows. A listing without links and an empty catalog are no
    error: the later phases then find nothing to do.
    """
    m = Manifest(spark, folder)
    collect_urls(m, listing, target, pattern)
    if fetch_pages is not None:
        scrape_articles(m, fetch_pages, scraped_at if scraped_at is not None else P.iso_utc(F.current_timestamp()), target)
    if fetch_files is not None:
        download_files(m, fetch_files, max_downloads)
    return Collected(m, catalog_of(m))
