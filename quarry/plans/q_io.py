"""Queries for attachments (A), sources/sinks (S), page assembly (X1) and
the incremental run (I1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import sql_str
from quarry.operators import attachments as A
from quarry.operators import clean as X
from quarry.operators import discover as C
from quarry.operators import formatting as FM
from quarry.operators import splits as T
from quarry.plans import views as V
from quarry.plans import sqlfrag as SQ
from quarry.plans.q_collect import ARTICLE_SQL, LINKS_SQL, MD_SQL, OUTPUTS_SQL, PENDING_SQL, UNTITLED, links, outputs, sql_safe_title
from quarry.plans.q_prepare import PREPARED_SQL, PREPARED_VIEWS, prepared_no_filter, sql_split_on
from quarry.plans.registry import query, with_views
from quarry.session import materialize, shared_dir
from quarry.sources import io as S
from quarry.streaming import discovery as D
from quarry.streaming import incremental as I

CAT = V.catalog_sql()
MAX_DOWNLOADS = 25


# ------------------------------------------------------------------ A1-A5
@query("has_attachment", with_views("SELECT idx, pdf_url FROM cat WHERE nullif(pdf_url, '') IS NOT NULL", cat=CAT))
def q_has(spark, sf):
    """A1 catalog rows with an attachment URL"""
    return A.has_attachment(V.catalog(spark, sf)).select("idx", "pdf_url")


@query(
    "attachment_limit",
    with_views(f"SELECT idx, pdf_url FROM cat WHERE nullif(pdf_url, '') IS NOT NULL ORDER BY idx LIMIT {MAX_DOWNLOADS}", cat=CAT),
)
def q_limit(spark, sf):
    """A2 first 25 attachments in catalog order (max_downloads)"""
    return A.attachment_limit(A.has_attachment(V.catalog(spark, sf)), MAX_DOWNLOADS).select("idx", "pdf_url")


PDF_NAME_SQL = f"printf('%03d_%s.pdf', idx, {sql_safe_title(UNTITLED)})"


@query(
    "skip_existing",
    with_views(
        f"SELECT idx, file_name, CASE WHEN file_name IN (SELECT {PDF_NAME_SQL} FROM cat WHERE idx % 3 = 0) "
        f"THEN 'skipped' ELSE 'fetch' END AS action FROM (SELECT idx, {PDF_NAME_SQL} AS file_name FROM cat "
        "WHERE nullif(pdf_url, '') IS NOT NULL)",
        cat=CAT,
    ),
)
def q_skip_existing(spark, sf):
    """A3 skip attachments already on disk (every third catalog row), no overwrite"""
    cat = V.catalog(spark, sf).withColumn("file_name", C.pdf_filename("idx", "title"))
    todo = A.has_attachment(cat)
    listing = cat.filter(F.col("idx") % 3 == 0).select("file_name")
    return A.skip_existing(todo, listing).select("idx", "file_name", "action")


FETCH_STATUS_SQL = """CASE WHEN status <> 200 THEN 'failed'
    WHEN content IS NULL OR content[1:4] <> '%PDF'::BLOB THEN 'not_pdf' ELSE 'ok' END"""


@query("fetch_status", with_views(f"SELECT idx, status, {FETCH_STATUS_SQL} AS result FROM f", f=V.fetches_sql()))
def q_fetch_status(spark, sf):
    """A4 fetch validation: HTTP status and PDF magic bytes"""
    f = V.fetches(spark, sf)
    return f.select("idx", "status", A.fetch_status("status", "content").alias("result"))


@query(
    "fetch_summary",
    with_views(
        f"SELECT {FETCH_STATUS_SQL} AS result, count(*) AS files, "
        "round(coalesce(sum(octet_length(content)), 0) / 1024.0, 3) AS kb FROM f GROUP BY 1",
        f=V.fetches_sql(),
    ),
)
def q_fetch_summary(spark, sf):
    """A5 files and kilobytes per fetch result"""
    f = V.fetches(spark, sf).withColumn("result", A.fetch_status("status", "content"))
    return A.fetch_summary(f)


# ------------------------------------------------------------------- X1
# pages are a text's lines; behind every third one comes a page that could not be decoded
PAGES_LONG_SQL = """SELECT doc_id, unnest(range(len(parts))) * 2 AS page_no, unnest(parts) AS t
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""


def pages_long(spark, sf):
    d = V.table(spark, sf, "documents")
    x = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "t")).withColumn("page_no", F.col("page_no") * 2)
    failed = x.filter(F.col("page_no") % 6 == 4).select("doc_id", (F.col("page_no") + 1).alias("page_no"), F.lit(None).cast("string").alias("t"))
    return x.unionByName(failed)


@query(
    "assemble_pages",
    with_views(
        "SELECT doc_id, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY page_no) FILTER (WHERE t <> ''), '') AS raw_text "
        "FROM pl GROUP BY doc_id",
        pl=PAGES_LONG_SQL,
    ),
)
def q_assemble(spark, sf):
    """X1 page assembly: non-empty pages joined in order by a blank line"""
    return X.assemble_pages(pages_long(spark, sf), key="doc_id", page_no="page_no", text="t")


@query(
    "decode_pdf_pages",
    with_views(
        f"SELECT path, md5(c) AS text_md5 FROM (SELECT printf('%03d.pdf', idx) AS path, "
        f"{SQ.clean_text('html')} AS c FROM f WHERE status = 200 AND idx % 3 <> 0 AND html <> '')",
        f="SELECT page_id AS idx, CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END AS status, html FROM pages",
    ),
)
def q_decode(spark, sf):
    """X1 decoder plug-in: fetched attachment bytes -> pages -> assembled, cleaned text"""
    f = V.fetches(spark, sf).withColumn("result", A.fetch_status("status", "content"))
    ok = f.filter(F.col("result") == "ok").withColumn("path", F.format_string("%03d.pdf", F.col("idx")))
    pages = A.decode_pages(ok, "path", "content")
    docs = X.assemble_pages(pages, key="path", page_no="page_no", text="text")
    return X.clean_documents(docs).select("path", F.md5("cleaned").alias("text_md5"))


def _filtered_views():
    from quarry.plans.q_filter import FILTERED_VIEWS

    return FILTERED_VIEWS


# ------------------------------------------------------------------ S1-S12
@query("src_pages", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def q_src_pages(spark, sf):
    """S3 page scan with column pruning"""
    return V.table(spark, sf, "pages").select("page_id", "url", F.md5("html").alias("html_md5"))


@query("sink_catalog", with_views("SELECT *, CAST(NULL AS VARCHAR) AS scraped_at FROM cat", cat=CAT))
def q_sink_catalog(spark, sf):
    """S2 catalog snapshot written to a new folder, read back"""
    path = S.write_catalog(V.catalog(spark, sf).withColumn("scraped_at", F.lit(None).cast("string")), shared_dir(spark, "catalog"))
    return S.read_catalog(spark, path)


@query("src_catalog", with_views("SELECT *, CAST(NULL AS VARCHAR) AS scraped_at FROM cat", cat=CAT))
def q_src_catalog(spark, sf):
    """S1 catalog as JSON array files (one per partition), idx kept"""
    cat = V.catalog(spark, sf).withColumn("scraped_at", F.lit(None).cast("string"))
    directory = S.write_catalog_json_arrays(cat, shared_dir(spark, "catalog-array"))
    return S.read_catalog_json_array(spark, directory)


@query("sink_scraped_json", with_views("SELECT * FROM a", md=MD_SQL, a=ARTICLE_SQL))
def q_sink_scraped(spark, sf):
    """S4 article records as JSON lines, read back with a schema"""
    from quarry.operators import pages as P

    recs = P.article_records(V.table(spark, sf, "pages"), F.lit("2024-06-01T00:00:00+00:00"))
    return S.read_scraped(spark, S.write_scraped(recs, shared_dir(spark, "scraped")))


@query(
    "src_pdf_binary",
    with_views(
        f"SELECT {PDF_NAME_SQL} AS file_name, CAST(octet_length(content) AS BIGINT) AS length FROM f JOIN cat USING (idx) "
        "WHERE status = 200 AND content[1:4] = '%PDF'::BLOB",
        f=V.fetches_sql(),
        cat=CAT,
    ),
)
def q_pdf_binary(spark, sf):
    """S5 attachment files written by the executors, scanned with binaryFile (*.pdf)"""
    cat = V.catalog(spark, sf).select("idx", "title")
    f = V.fetches(spark, sf).join(cat, "idx").filter(A.fetch_status("status", "content") == "ok")
    files = f.select(C.pdf_filename("idx", "title").alias("name"), "content")
    directory = S.write_files(files, shared_dir(spark, "pdfs"), "name", "content")
    return S.read_binary(spark, directory).select("file_name", "length")


SER_SQL = f"""{sql_str(fixed.METADATA_START + chr(10) + 'TITLE: ')} || title || chr(10) || 'DATE: ' || coalesce(date, '') || chr(10)
  || 'SOURCE: ' || source || chr(10)
  || CASE WHEN reasoning IS NOT NULL AND reasoning <> '' THEN {sql_str(fixed.REASONING_START + chr(10))} || reasoning || chr(10) ELSE '' END
  || {sql_str(fixed.CONTENT_START + chr(10))} || content"""
SER_VIEW = f"""SELECT doc_id, source, {SER_SQL} AS framed FROM (
  SELECT doc_id, source, title, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '2024-01-01' END AS date, text AS content,
         CASE WHEN doc_id % 2 = 0 THEN 'Looks fine.' END AS reasoning FROM pd)"""


def framed(spark, sf):
    pd = V.press_documents(spark, sf)
    date = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("2024-01-01"))
    reasoning = F.when(F.col("doc_id") % 2 == 0, F.lit("Looks fine."))
    return pd.select("doc_id", "source", FM.serialize_processed("title", date, "source", "text", reasoning).alias("framed"))


@query("ser_processed", with_views("SELECT doc_id, framed FROM s", pd=V.press_documents_sql(), s=SER_VIEW))
def q_ser(spark, sf):
    """S6 framed processed-text serialisation"""
    return framed(spark, sf).select("doc_id", "framed")


def _sql_strip(e):
    return f"regexp_replace({e}, '\\A\\s+|\\s+\\z', '', 'g')"


def _sql_last(prefix):
    n = len(prefix)
    hits = f"list_filter(string_split(hdr, chr(10)), lambda l: starts_with(l, {sql_str(prefix)}))"
    return f"CASE WHEN len({hits}) > 0 THEN {_sql_strip(f'substr(list_extract({hits}, -1), {n + 1})')} END"


MARK = fixed.CONTENT_START + "\n"
PARSE_SQL = f"""SELECT doc_id,
    CASE WHEN ok THEN coalesce({_sql_last('TITLE: ')}, '') ELSE regexp_replace(name, '\\.[^./]*$', '') END AS title,
    CASE WHEN ok THEN nullif({_sql_last('DATE: ')}, '') END AS date,
    CASE WHEN ok THEN coalesce({_sql_last('SOURCE: ')}, '') ELSE name END AS source,
    CASE WHEN ok THEN {_sql_strip(f"substr(t, strpos(t, {sql_str(MARK)}) + {len(MARK)})")} ELSE t END AS content
  FROM (SELECT *, split_part(split_part(t, {sql_str(MARK)}, 1), {sql_str(fixed.REASONING_START)}, 1) AS hdr,
               strpos(t, {sql_str(MARK)}) > 0 AS ok
        FROM (SELECT doc_id, replace(source, '.pdf', '.txt') AS name,
                     CASE WHEN doc_id % 10 = 0 THEN substr(framed, strpos(framed, {sql_str(MARK)}) + {len(MARK)}) ELSE framed END AS t
              FROM s))"""


@query("parse_processed", with_views("SELECT * FROM pp", pd=V.press_documents_sql(), s=SER_VIEW, pp=PARSE_SQL))
def q_parse(spark, sf):
    """S7 framed text parse (every tenth file lacks the frame -> fallback)"""
    f = framed(spark, sf)
    body = F.col("framed").substr(F.locate(MARK, F.col("framed")) + len(MARK), F.lit(1 << 30))
    t = F.when(F.col("doc_id") % 10 == 0, body).otherwise(F.col("framed"))
    name = F.replace(F.col("source"), F.lit(".pdf"), F.lit(".txt"))
    p = f.select("doc_id", FM.parse_processed(t, name).alias("p"))
    return p.select("doc_id", "p.title", "p.date", "p.source", "p.content")


#: So many files are listed at once; the number of folders grows with the table.
FILES_PER_FOLDER = 1000


@query(
    "processed_text_files",
    with_views(
        "SELECT regexp_replace(title, '\\A\\s+|\\s+\\z', '', 'g') AS title, "
        "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '2024-01-01' END AS date, source, "
        "md5(regexp_replace(text, '\\A\\s+|\\s+\\z', '', 'g')) AS content_md5 FROM pd",
        pd=V.press_documents_sql(),
    ),
)
def q_processed_files(spark, sf):
    """S6/S7 file form: framed texts written one file per document, read back whole"""
    f = framed(spark, sf).withColumn("name", F.replace(F.col("source"), F.lit(".pdf"), F.lit(".txt")))
    directory = S.write_files(f, shared_dir(spark, "processed"), "name", "framed", folders=f.count() // FILES_PER_FOLDER + 1)
    back = S.read_text_files(spark, directory)
    p = back.select(FM.parse_processed("value", "file_name").alias("p"))
    return p.select("p.title", "p.date", "p.source", F.md5("p.content").alias("content_md5"))


@query("sink_splits", with_views("SELECT * FROM sp WHERE split = 'eval'", **PREPARED_VIEWS, sp=sql_split_on("ex", "source_pdf")))
def q_sink_splits(spark, sf):
    """S8 split dataset as partitioned Parquet; eval split read with partition pruning"""
    path = S.write_splits(prepared_no_filter(spark, sf), shared_dir(spark, "splits"))
    return S.read_split(spark, path, "eval")


@query("sink_jsonl", PREPARED_SQL)
def q_sink_jsonl(spark, sf):
    """S9 JSON lines per split (nulls kept), read back"""
    examples = prepared_no_filter(spark, sf)
    return spark.read.schema(examples.schema).json(S.write_jsonl(examples, shared_dir(spark, "jsonl")))


@query(
    "sink_rejects",
    with_views("SELECT source, title, reason_ AS reason, reasoning_ AS reasoning, 'run-1' AS run_id FROM v WHERE rejected", **_filtered_views()),
)
def q_sink_rejects(spark, sf):
    """S10 reject log partitioned by run"""
    from quarry.plans.q_filter import filtered_phase

    _, rej = filtered_phase(spark, sf)
    path = shared_dir(spark, "rejects")
    S.write_rejects(rej, path, "run-1")
    return spark.read.schema(rej.withColumn("run_id", F.lit("")).schema).json(path)


@query(
    "sink_summary",
    with_views(
        "SELECT count(*) AS total_processed, count(*) FILTER (WHERE split = 'train') AS train_samples, "
        "count(*) FILTER (WHERE split = 'eval') AS eval_samples, CAST(coalesce(sum(word_count), 0) AS BIGINT) AS total_words, "
        "'instruct' AS format_style, false AS llm_filtered, CAST(0 AS BIGINT) AS rejected_count FROM sp",
        **PREPARED_VIEWS,
        sp=sql_split_on("ex", "source_pdf"),
    ),
)
def q_sink_summary(spark, sf):
    """S11 one-row run summary as a single JSON file"""
    summary = T.run_summary(prepared_no_filter(spark, sf), "instruct", llm_filtered=False)
    return spark.read.schema(summary.schema).json(S.write_summary(summary, shared_dir(spark, "summary")))


# ------------------------------------------------------------------- I1
@query(
    "incremental_clean",
    with_views(
        f"SELECT doc_id, source, md5(c) AS text_md5 FROM (SELECT doc_id, source, {SQ.clean_text('raw_text')} AS c "
        "FROM pd WHERE raw_text <> '')",
        pd=V.press_documents_sql(),
    ),
)
def q_incremental(spark, sf):
    """I1 cleaning as an availableNow stream over two arriving batches of files"""
    pd = V.press_documents(spark, sf).select("doc_id", "source", "raw_text")
    inbox, out, ckpt = shared_dir(spark, "inbox"), shared_dir(spark, "clean-out"), shared_dir(spark, "clean-ckpt")
    first = pd.filter(F.col("doc_id") % 2 == 0)
    second = pd.filter(F.col("doc_id") % 2 == 1)
    first.write.parquet(f"{inbox}/batch=1")
    I.run_incremental_clean(spark, inbox, pd.schema, out, ckpt)
    second.write.parquet(f"{inbox}/batch=2")
    I.run_incremental_clean(spark, inbox, pd.schema, out, ckpt)  # only the new files are processed
    return I.read_output(spark, out).select("doc_id", "source", F.md5("cleaned").alias("text_md5"))


@query(
    "incremental_filter",
    with_views(
        "SELECT source, title, CASE WHEN NOT rejected THEN date END AS date, md5(content) AS content_md5, CASE WHEN rejected THEN reason_ END AS reason FROM v",
        **{k: v for k, v in _filtered_views().items() if k not in ("acc", "ex")},
    ),
)
def q_incremental_filter(spark, sf):
    """I1 filter phase as an availableNow stream with foreachBatch (accepted + reject log)"""
    from quarry.plans.q_prepare import regex_phase

    rx = regex_phase(spark, sf).select("source", "title", "date", "lang", F.col("cleaned").alias("text"))
    inbox, acc, rej, ckpt = (shared_dir(spark, n) for n in ("rx-inbox", "accepted", "rejected", "filter-ckpt"))
    rx.write.parquet(f"{inbox}/batch=1")
    I.run_incremental_filter(spark, inbox, rx.schema, acc, rej, ckpt, max_files=4)
    none = F.lit(None).cast("string")
    good = spark.read.parquet(acc).select("source", "title", "date", F.md5("content").alias("content_md5"), none.alias("reason"))
    return good.unionByName(spark.read.parquet(rej).select("source", "title", none.alias("date"), none.alias("content_md5"), "reason"))


# ------------------------------------------- I1: known ids as a stream's state
@query(
    "stream_new_ids",
    with_views(
        "SELECT id, page_id, pos, slug FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page_id % 2 DESC, page_id, pos) AS k FROM l WHERE page_id % 4 <> 0) "
        "WHERE k = 1 AND id NOT IN (SELECT id FROM l WHERE page_id % 4 = 0)",
        l=LINKS_SQL,
    ),
)
def q_stream_new_ids(spark, sf):
    """C5 as a stream: known ids and two arriving batches of links; a restart between them adds nothing"""
    place = F.struct("page_id", "pos")  # order of rows that arrive together
    lk = links(spark, sf).select("id", "page_id", F.col("pos").cast("bigint").alias("pos"), "slug", (F.col("page_id") % 4 == 0).alias("known"))
    lk = materialize(lk.withColumn("place", F.format_string("%020d %020d", place["page_id"], place["pos"])), "links")
    inbox, out, ckpt = (shared_dir(spark, n) for n in ("links-inbox", "new-ids", "new-ids-ckpt"))
    run = lambda: D.run_new_ids(spark, inbox, lk.schema, out, ckpt)
    for batch in ("known", "not known and page_id % 2 = 1", "not known and page_id % 2 = 0"):
        lk.filter(batch).write.parquet(f"{inbox}/{uuid.uuid4().hex}")
        run()
        run()
    return spark.read.schema(lk.schema).parquet(out).select("id", "page_id", "pos", "slug")


@query(
    "stream_pending",
    with_views("SELECT idx, article_id, url FROM p", cat=CAT, outs=OUTPUTS_SQL, p=PENDING_SQL),
)
def q_stream_pending(spark, sf):
    """C11 as a stream: outputs on disk first, then the catalog in two batches"""
    none = lambda t: F.lit(None).cast(t)
    done = outputs(spark, sf).select(C.output_id("name").alias("id")).filter("id is not null").distinct()
    done = done.select(none("bigint").alias("idx"), "id", none("string").alias("article_id"), none("string").alias("url"), none("boolean").alias("scraped"), F.lit(True).alias("known"))
    cat = V.catalog(spark, sf).select("idx", C.article_id_of("article_id", "url").alias("id"), "article_id", "url", "scraped", F.lit(False).alias("known"))
    inbox, out, ckpt = (shared_dir(spark, n) for n in ("catalog-inbox", "pending", "pending-ckpt"))
    for batch in (done, cat.filter("idx % 2 = 0"), cat.filter("idx % 2 = 1")):
        batch.write.parquet(f"{inbox}/{uuid.uuid4().hex}")
        D.run_pending(spark, inbox, cat.schema, out, ckpt)
    return spark.read.schema(cat.schema).parquet(out).select("idx", "article_id", "url")


@query(
    "stream_fetch_plan",
    with_views(
        f"SELECT idx, file_name, CASE WHEN file_name IN (SELECT file_name FROM t WHERE idx % 5 = 0) OR k > 1 THEN 'skipped' ELSE 'fetch' END AS action "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY idx % 2, idx) AS k FROM t)",
        cat=CAT,
        t="SELECT idx, regexp_replace(coalesce(nullif(pdf_url, ''), url), '^.*/', '') || '.pdf' AS file_name FROM cat",
    ),
)
def q_stream_fetch(spark, sf):
    """A3 as a stream: files on disk first, then targets in two batches; a name that comes again is skipped"""
    name = F.concat(F.regexp_replace(F.coalesce(F.nullif(F.col("pdf_url"), F.lit("")), F.col("url")), "^.*/", ""), F.lit(".pdf"))
    t = materialize(V.catalog(spark, sf).select("idx", name.alias("file_name"), F.lit(False).alias("known")), "targets")
    inbox, out, ckpt = (shared_dir(spark, n) for n in ("targets-inbox", "fetch-plan", "fetch-ckpt"))
    for batch in (t.filter("idx % 5 = 0").withColumn("known", F.lit(True)), t.filter("idx % 2 = 0"), t.filter("idx % 2 = 1")):
        batch.write.parquet(f"{inbox}/{uuid.uuid4().hex}")
        D.run_fetch_plan(spark, inbox, t.schema, out, ckpt)
    return spark.read.schema("idx bigint, file_name string, action string").parquet(out)
