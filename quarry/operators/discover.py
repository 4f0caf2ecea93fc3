"""Discovery and catalog maintenance (C1-C14) over a table of crawled pages.

The catalog is a DataFrame with an explicit ``idx`` (its position), so
appends, upserts and lookups are joins and filters instead of list edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import jre
from quarry.operators.order import first_n, running_sum

CATALOG_SCHEMA = (
    "idx bigint, article_id string, url string, title string, date string, pdf_url string, "
    "scraped boolean, scraped_at string"
)
LINK_STRUCT = "array<struct<id:string,slug:string>>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_links(pages: DataFrame, html: str = "html", page: str = "page_id", pattern: str = fixed.ARTICLE_LINK_PATTERN) -> DataFrame:
    """Every (id, slug) match of a two-group pattern, with its position."""
    ids = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    slugs = F.regexp_extract_all(F.col(html), F.lit(pattern), 2)
    z = pages.select(page, F.posexplode(F.arrays_zip(ids.alias("id"), slugs.alias("slug"))).alias("pos", "m"))
    return z.select(page, "pos", F.col("m.id").alias("id"), F.col("m.slug").alias("slug"))


def embedded_links(html: Column | str, pattern: str = fixed.EMBEDDED_JSON_PATTERN) -> Column:
    """``window.collectedArticles = [...]`` parsed as an array of (id, slug); bad JSON -> null."""
    raw = F.regexp_extract(_c(html), "(?s)" + pattern, 1)
    return F.when(raw != "", F.from_json(raw, LINK_STRUCT, {"mode": "PERMISSIVE"}))


def regex_links(html: Column | str, pattern: str = fixed.ARTICLE_LINK_PATTERN) -> Column:
    ids = F.regexp_extract_all(_c(html), F.lit(pattern), 1)
    slugs = F.regexp_extract_all(_c(html), F.lit(pattern), 2)
    return F.arrays_zip(ids.alias("id"), slugs.alias("slug"))


def link_fallback(js: Column, embedded: Column, regex: Column) -> Column:
    """First non-empty of the three link sources, with the source's name."""

    def nonempty(a: Column) -> Column:
        return a.isNotNull() & (F.size(a) > 0)

    return (
        F.when(nonempty(js), F.struct(F.lit("js").alias("src"), js.alias("links")))
        .when(nonempty(embedded), F.struct(F.lit("embedded").alias("src"), embedded.alias("links")))
        .when(nonempty(regex), F.struct(F.lit("regex").alias("src"), regex.alias("links")))
        .otherwise(F.struct(F.lit("none").alias("src"), F.array().cast(LINK_STRUCT).alias("links")))
    )


def dedup_keep_first(links: DataFrame, scope: list[str], order: list[str], id_col: str = "id") -> DataFrame:
    """C4: first occurrence of each id within ``scope`` (``[]`` = global).

    ``min(struct(order..., rest))`` is a plain aggregate, so the dedup is a
    partial aggregation rather than a window over a whole page set.
    """
    rest = [c for c in links.columns if c not in scope and c != id_col and c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]))
    g = links.groupBy(*scope, id_col).agg(first.alias("_f"))
    return g.select(*scope, id_col, *[F.col(f"_f.{c}").alias(c) for c in order + rest])


def new_ids_anti(links: DataFrame, existing_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Drop ids that the catalog already has."""
    known = existing_ids.select(F.col(id_col).alias(id_col)).distinct()
    return links.join(known, id_col, "left_anti")


def article_id_of(article_id: Column | str, url: Column | str) -> Column:
    """article_id, or the second-last URL segment when missing or empty."""
    return F.coalesce(F.nullif(_c(article_id), F.lit("")), F.try_element_at(F.split(_c(url), "/"), F.lit(-2)))


def normalize_url(article_id: Column | str, slug: Column | str, base: str = fixed.ARTICLE_URL_BASE) -> Column:
    """Canonical URL; the slug loses everything from ``?`` then from ``#``."""
    clean = F.substring_index(F.substring_index(_c(slug), "?", 1), "#", 1)
    return F.concat(F.lit(base), _c(article_id), F.lit("/"), clean)


def catalog_stub(links: DataFrame, base: str = fixed.ARTICLE_URL_BASE) -> DataFrame:
    """New catalog rows with empty metadata."""
    none = F.lit(None).cast("string")
    return links.select(
        *[c for c in ("page_id", "pos") if c in links.columns],
        F.col("id").alias("article_id"),
        normalize_url("id", "slug", base).alias("url"),
        none.alias("title"),
        none.alias("date"),
        none.alias("pdf_url"),
        F.lit(False).alias("scraped"),
    )


def target_limit(new_rows: DataFrame, n_existing: int, target: int, order: list[str]) -> DataFrame:
    """Take new rows until ``existing + new >= target`` (at least one
    row once discovery runs; none when the target is already met). First rows
    in ``order``; a large number of them stays spread (``order.first_n``)."""
    if n_existing >= target:
        return new_rows.limit(0)
    return first_n(new_rows, order, max(1, target - n_existing))


def catalog_append(existing: DataFrame, new_rows: DataFrame, n_existing: int, order: list[str]) -> DataFrame:
    """Existing + new, positions continue at ``n_existing``.

    New rows are numbered in ``order`` through key ranges and their offsets
    (``order.running_sum``), not by a window over all new rows.
    """
    numbered = running_sum(new_rows, order, F.lit(1), "_before")
    appended = numbered.select(
        (F.lit(n_existing) + F.col("_before")).cast("bigint").alias("idx"),
        "article_id", "url", "title", "date", "pdf_url", "scraped",
        F.lit(None).cast("string").alias("scraped_at"),
    )
    base = existing.select(*[F.col(c) if c in existing.columns else F.lit(None).cast("string").alias(c) for c in
                             ("idx", "article_id", "url", "title", "date", "pdf_url", "scraped", "scraped_at")])
    return base.unionByName(appended)


def output_id(name: Column | str) -> Column:
    """The article id encoded in an output file name ``NNN_<id>[_title].json``."""
    return F.nullif(F.regexp_extract(_c(name), r"^\d+_(T\d+EN)(?:_|\.json$)", 1), F.lit(""))


def pending_scrape(catalog: DataFrame, outputs: DataFrame, max_articles: int | None = None) -> DataFrame:
    """C11: not scraped and no output file for the exact id; first n by idx."""
    cid = article_id_of("article_id", "url")
    done = outputs.select(output_id("name").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    pend = catalog.filter(~F.coalesce(F.col("scraped"), F.lit(False))).withColumn("_id", cid)
    pend = pend.join(done, "_id", "left_anti").drop("_id")
    return first_n(pend, ["idx"], max_articles) if max_articles else pend


def catalog_upsert(catalog: DataFrame, results: DataFrame, key: str = "idx") -> DataFrame:
    """Matched rows take the scrape's title/date/pdf_url (nulls included),
    scraped=true and scraped_at; unmatched rows are unchanged.

    Results are matched on the catalog position (``idx``), the identity of
    a catalog row; ids can repeat or be empty, positions cannot.
    """
    r = results.select(
        F.col(key).alias("_k"),
        F.col("title").alias("_t"),
        F.col("date").alias("_d"),
        F.col("pdf_url").alias("_p"),
        F.col("scraped_at").alias("_s"),
    )
    j = catalog.join(r, catalog[key] == r["_k"], "left")
    hit = F.col("_k").isNotNull()
    old_at = F.col("scraped_at") if "scraped_at" in catalog.columns else F.lit(None).cast("string")
    return j.select(
        "idx",
        "article_id",
        "url",
        F.when(hit, F.col("_t")).otherwise(F.col("title")).alias("title"),
        F.when(hit, F.col("_d")).otherwise(F.col("date")).alias("date"),
        F.when(hit, F.col("_p")).otherwise(F.col("pdf_url")).alias("pdf_url"),
        F.when(hit, F.lit(True)).otherwise(F.col("scraped")).alias("scraped"),
        F.when(hit, F.col("_s")).otherwise(old_at).alias("scraped_at"),
    )


def index_lookup(items: DataFrame, catalog: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Catalog position of each item's id (first match), 0 when absent."""
    pos = catalog.groupBy(F.col("article_id").alias("_k")).agg(F.min("idx").alias("_idx"))
    j = items.join(pos, items[id_col] == pos["_k"], "left")
    return j.drop("_k").withColumn("idx", F.coalesce(F.col("_idx"), F.lit(0)).cast("bigint")).drop("_idx")


def safe_title(title: Column | str, n: int = 50) -> Column:
    return F.substring(F.regexp_replace(_c(title), jre(r"[^\w\-]", ""), "_"), 1, n)


def scraped_filename(idx: Column | str, article_id: Column | str, title: Column | str) -> Column:
    """C14: ``{idx:03d}_{id}_{safe_title}.json`` or ``{idx:03d}_{id}.json``."""
    t = _c(title)
    return F.when(
        t.isNotNull() & (t != ""),
        F.format_string("%03d_%s_%s.json", _c(idx), _c(article_id), safe_title(t)),
    ).otherwise(F.format_string("%03d_%s.json", _c(idx), _c(article_id)))


def pdf_filename(idx: Column | str, title: Column | str) -> Column:
    """C14: ``{idx:03d}_{safe_title}.pdf`` (missing title -> ``Untitled``)."""
    return F.format_string("%03d_%s.pdf", _c(idx), safe_title(F.coalesce(_c(title), F.lit("Untitled"))))
