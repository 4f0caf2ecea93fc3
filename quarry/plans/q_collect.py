"""Queries for discovery/catalog (C) and page content (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import sql_str
from quarry.operators import discover as C
from quarry.operators import pages as P
from quarry.plans import views as V
from quarry.plans.registry import query, with_views
from quarry.plans.sqlfrag import W

# The fixture pages link to '/word' targets; (id, slug) = (word, rest of href).
LINK_PATTERN = r'<a href="/([^",]+)([^"]*)"'
TARGET = 200
SCRAPED_AT = "2024-06-01T00:00:00+00:00"
CAT = V.catalog_sql()


def rr(e, p, r=""):
    return f"regexp_replace({e}, {sql_str(p)}, {sql_str(r)}, 'g')"


# ------------------------------------------------------------------- C1-C5
LINKS_SQL = f"""SELECT page_id, unnest(range(len(ids))) AS pos, unnest(ids) AS id, unnest(slugs) AS slug FROM (
    SELECT page_id, regexp_extract_all(html, {sql_str(LINK_PATTERN)}, 1) AS ids,
           regexp_extract_all(html, {sql_str(LINK_PATTERN)}, 2) AS slugs FROM pages)"""


def links(spark, sf, pages=None):
    p = pages if pages is not None else V.table(spark, sf, "pages")
    return C.extract_links(p, pattern=LINK_PATTERN)


@query("extract_links", LINKS_SQL)
def q_links(spark, sf):
    """C1 link extraction with positions"""
    return links(spark, sf).select("page_id", F.col("pos").cast("bigint").alias("pos"), "id", "slug")


EMB_SQL = f"nullif(regexp_extract(html, {sql_str('(?s)' + fixed.EMBEDDED_JSON_PATTERN)}, 1), '')"
# items of the embedded list; a list that is no valid JSON has none
N_EMB_SQL = f"coalesce(CASE WHEN json_valid({EMB_SQL}) THEN json_array_length({EMB_SQL}) END, 0)"
PP = V.press_pages_sql()


@query(
    "extract_embedded_json",
    with_views(
        f"SELECT page_id, CAST({N_EMB_SQL} AS BIGINT) AS n_items, CASE WHEN {N_EMB_SQL} > 0 THEN "
        f"json_extract_string({EMB_SQL}, '$[0].id') END AS first_id FROM pp",
        pp=PP,
    ),
)
def q_embedded(spark, sf):
    """C2 embedded-JSON link list per page (bad or absent -> 0 items)"""
    p = V.press_pages(spark, sf).select("page_id", C.embedded_links("html").alias("e"))
    return p.select("page_id", F.coalesce(F.size("e"), F.lit(0)).cast("bigint").alias("n_items"), F.try_element_at("e", F.lit(1))["id"].alias("first_id"))


N_DETAIL_SQL = f"len(regexp_extract_all(html, {sql_str(fixed.ARTICLE_LINK_PATTERN)}, 1))"


@query(
    "link_fallback",
    with_views(
        f"""SELECT page_id,
          CASE WHEN page_id % 7 = 3 THEN 'js' WHEN {N_EMB_SQL} > 0 THEN 'embedded' WHEN {N_DETAIL_SQL} > 0 THEN 'regex' ELSE 'none' END AS src,
          CAST(CASE WHEN page_id % 7 = 3 THEN 1 WHEN {N_EMB_SQL} > 0 THEN {N_EMB_SQL} ELSE {N_DETAIL_SQL} END AS BIGINT) AS n_links,
          CASE WHEN page_id % 7 = 3 THEN 'T' || CAST(page_id AS VARCHAR) || 'EN'
               WHEN {N_EMB_SQL} > 0 THEN json_extract_string({EMB_SQL}, '$[0].id')
               ELSE list_extract(regexp_extract_all(html, {sql_str(fixed.ARTICLE_LINK_PATTERN)}, 1), 1) END AS first_id
        FROM pp""",
        pp=PP,
    ),
)
def q_fallback(spark, sf):
    """C3 link source chain: script result (every seventh page), embedded JSON, default link pattern, none"""
    p = V.press_pages(spark, sf)
    live = F.struct(F.concat(F.lit("T"), F.col("page_id").cast("string"), F.lit("EN")).alias("id"), F.lit("live").alias("slug"))
    js = F.when(F.col("page_id") % 7 == 3, F.array(live))
    chosen = C.link_fallback(js, C.embedded_links("html"), C.regex_links("html"))
    return p.select("page_id", chosen.alias("c")).select(
        "page_id", F.col("c.src").alias("src"), F.size("c.links").cast("bigint").alias("n_links"), F.try_element_at("c.links", F.lit(1))["id"].alias("first_id")
    )


@query(
    "dedup_keep_first",
    with_views("SELECT page_id, id, min(pos) AS pos, arg_min(slug, pos) AS slug FROM l GROUP BY page_id, id", l=LINKS_SQL),
)
def q_dedup(spark, sf):
    """C4 first occurrence of each id within a page"""
    d = C.dedup_keep_first(links(spark, sf), ["page_id"], ["pos"])
    return d.select("page_id", "id", F.col("pos").cast("bigint").alias("pos"), "slug")


NEW_SQL = with_views(
    "SELECT id, page_id, pos, slug FROM g WHERE id NOT IN (SELECT id FROM l WHERE page_id % 4 = 0)",
    l=LINKS_SQL,
    g="SELECT id, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos, "
    "arg_min(slug, (page_id, pos)) AS slug FROM l WHERE page_id % 4 <> 0 GROUP BY id",
)


def new_links(spark, sf):
    lk = links(spark, sf)
    existing = lk.filter(F.col("page_id") % 4 == 0).select("id")
    fresh = C.dedup_keep_first(lk.filter(F.col("page_id") % 4 != 0), [], ["page_id", "pos"])
    return C.new_ids_anti(fresh, existing).select("id", "page_id", F.col("pos").cast("bigint").alias("pos"), "slug")


@query("new_ids_anti", NEW_SQL)
def q_new_ids(spark, sf):
    """C5 ids not seen in the previous run (pages with page_id % 4 = 0), kept first globally"""
    return new_links(spark, sf)


@query(
    "article_id_of",
    with_views("SELECT idx, coalesce(nullif(article_id, ''), list_extract(string_split(url, '/'), -2)) AS aid FROM cat", cat=CAT),
)
def q_article_id(spark, sf):
    """C6 id accessor with URL fallback"""
    return V.catalog(spark, sf).select("idx", C.article_id_of("article_id", "url").alias("aid"))


def sql_norm_url(id_, slug):
    return f"{sql_str(fixed.ARTICLE_URL_BASE)} || {id_} || '/' || split_part(split_part({slug}, '?', 1), '#', 1)"


def _new_views():
    return dict(
        l=LINKS_SQL,
        g="SELECT id, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos, "
        "arg_min(slug, (page_id, pos)) AS slug FROM l WHERE page_id % 4 <> 0 GROUP BY id",
        n="SELECT id, page_id, pos, slug FROM g WHERE id NOT IN (SELECT id FROM l WHERE page_id % 4 = 0)",
    )


@query("normalize_url", with_views(f"SELECT id, {sql_norm_url('id', 'slug')} AS url FROM n", **_new_views()))
def q_norm_url(spark, sf):
    """C7 canonical URL from id and slug"""
    return new_links(spark, sf).select("id", C.normalize_url("id", "slug").alias("url"))


@query(
    "catalog_stub",
    with_views(
        f"SELECT id AS article_id, {sql_norm_url('id', 'slug')} AS url, CAST(NULL AS VARCHAR) AS title, "
        "CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS pdf_url, false AS scraped FROM n",
        **_new_views(),
    ),
)
def q_stub(spark, sf):
    """C8 stub rows for new ids"""
    return C.catalog_stub(new_links(spark, sf)).drop("page_id", "pos")


def _n_existing(spark, sf):
    return links(spark, sf).filter(F.col("page_id") % 4 == 0).select("id").distinct().count()


LIMIT_SQL_VIEWS = dict(
    **_new_views(),
    ne="SELECT count(DISTINCT id) AS k FROM l WHERE page_id % 4 = 0",
    t=f"""SELECT n.* FROM (SELECT n.*, row_number() OVER (ORDER BY page_id, pos) AS rn FROM n) n, ne
          WHERE ne.k < {TARGET} AND rn <= greatest(1, {TARGET} - ne.k)""",
)


@query("target_limit", with_views("SELECT id, page_id, pos FROM t", **LIMIT_SQL_VIEWS))
def q_target(spark, sf):
    """C9 new ids until existing + new reaches the target (200)"""
    t = C.target_limit(new_links(spark, sf), _n_existing(spark, sf), TARGET, ["page_id", "pos"])
    return t.select("id", "page_id", "pos")


@query(
    "catalog_append",
    with_views(
        "SELECT idx, article_id, url, scraped FROM cat UNION ALL "
        f"SELECT (SELECT count(*) FROM cat) + row_number() OVER (ORDER BY page_id, pos) - 1 AS idx, id AS article_id, "
        f"{sql_norm_url('id', 'slug')} AS url, false AS scraped FROM t",
        cat=CAT,
        **LIMIT_SQL_VIEWS,
    ),
)
def q_append(spark, sf):
    """C10 catalog + new stubs, positions continue"""
    cat = V.catalog(spark, sf)
    n_cat = cat.count()
    new = C.catalog_stub(C.target_limit(new_links(spark, sf), _n_existing(spark, sf), TARGET, ["page_id", "pos"]))
    out = C.catalog_append(cat, new, n_cat, ["page_id", "pos"])
    return out.select("idx", "article_id", "url", "scraped")


def sql_safe_title(e, n=50):
    return f"substr({rr(e, '[^' + W[1:-1] + '\\-]', '_')}, 1, {n})"


def sql_scraped_name(idx, aid, title):
    return (
        f"CASE WHEN {title} IS NOT NULL AND {title} <> '' THEN printf('%03d_%s_%s.json', {idx}, {aid}, {sql_safe_title(title)}) "
        f"ELSE printf('%03d_%s.json', {idx}, {aid}) END"
    )


def sql_pdf_name(idx, title):
    safe = sql_safe_title(f"coalesce({title}, 'Untitled')")
    return f"printf('%03d_%s.pdf', {idx}, {safe})"


UNTITLED = "coalesce(title, 'Untitled')"
AID = "coalesce(nullif(article_id, ''), list_extract(string_split(url, '/'), -2))"
OUTPUTS_SQL = f"SELECT {sql_scraped_name('idx', AID, 'title')} AS name FROM cat WHERE idx % 6 = 0"
PENDING_SQL = f"""SELECT * FROM cat WHERE NOT coalesce(scraped, false) AND {AID} NOT IN (
    SELECT nullif(regexp_extract(name, '^\\d+_(T\\d+EN)(?:_|\\.json$)', 1), '') FROM outs
    WHERE nullif(regexp_extract(name, '^\\d+_(T\\d+EN)(?:_|\\.json$)', 1), '') IS NOT NULL)"""


def outputs(spark, sf):
    cat = V.catalog(spark, sf)
    return cat.filter(F.col("idx") % 6 == 0).select(
        C.scraped_filename("idx", C.article_id_of("article_id", "url"), "title").alias("name")
    )


def pending(spark, sf):
    return C.pending_scrape(V.catalog(spark, sf), outputs(spark, sf))


@query("pending_scrape", with_views("SELECT idx, article_id, url FROM p", cat=CAT, outs=OUTPUTS_SQL, p=PENDING_SQL))
def q_pending(spark, sf):
    """C11 catalog rows still to scrape (exact id match against outputs)"""
    return pending(spark, sf).select("idx", "article_id", "url")


@query(
    "safe_filename",
    with_views(
        f"SELECT idx, {sql_scraped_name('idx', AID, 'title')} AS scraped_name, "
        f"printf('%03d_%s.pdf', idx, {sql_safe_title(UNTITLED)}) AS pdf_name FROM cat",
        cat=CAT,
    ),
)
def q_safe_filename(spark, sf):
    """C14 output file names"""
    cat = V.catalog(spark, sf)
    return cat.select(
        "idx",
        C.scraped_filename("idx", C.article_id_of("article_id", "url"), "title").alias("scraped_name"),
        C.pdf_filename("idx", "title").alias("pdf_name"),
    )


# -------------------------------------------------------------------- P1-P8
def sql_html_blocks(e):
    t = rr(e, r"(?s)<!--.*?-->", " ")
    for tag in ("script", "style", *fixed.PAGE_EXCLUDED_TAGS):
        t = rr(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    for k in range(1, 7):
        t = rr(t, rf"(?i)<h{k}\b[^>]*>", "\n\n" + "#" * k + " ")
        t = rr(t, rf"(?i)</h{k}\s*>", "\n\n")
    t = rr(t, rf"(?i)</?(?:{P.BLOCK_TAGS})\b[^>]*>", "\n\n")
    t = rr(t, r"<[^>]*>", "")
    return t


def sql_decode_references(e):
    names = P.named_characters()
    known = f"MAP([{', '.join(sql_str(n) for n in names)}], [{', '.join(sql_str(c) for c in names.values())}])"
    low = f"[{', '.join(sql_str(c) for c in P.low_characters())}]"
    code = f"CASE WHEN regexp_matches(p, {sql_str(P.NUMBER)}) THEN TRY_CAST(substr(p, 3, length(p) - 3) AS BIGINT) ELSE CAST('0x' || substr(p, 4, length(p) - 4) AS BIGINT) END"
    char = f"""CASE WHEN {code} = 160 THEN ' ' WHEN {code} BETWEEN 128 AND 159 THEN list_extract({low}, {code} - 127)
        WHEN ({code} > 0 AND {code} < 55296) OR ({code} > 57343 AND {code} <= 1114111) THEN chr(CAST({code} AS INTEGER)) ELSE {sql_str(P.UNKNOWN)} END"""
    one = f"""CASE WHEN NOT starts_with(p, '&') THEN p WHEN regexp_matches(p, {sql_str(P.NUMBER)}) OR regexp_matches(p, {sql_str(P.HEX_NUMBER)}) THEN {char}
        WHEN regexp_matches(p, {sql_str(P.NAME)}) THEN coalesce({known}[substr(p, 2, length(p) - 2)], p) ELSE p END"""
    whole = f"array_to_string(list_transform(regexp_extract_all(t, {sql_str(P.PIECE)}), lambda p: {one}), '')"
    return f"list_extract(list_transform([{e}], lambda t: CASE WHEN contains(t, '&') THEN {whole} ELSE t END), 1)"


REFS = "&eacute;&amp;lt;&unknown; &#8217;&#x27;&nbsp;&#160;&; &rsquo &#150;&#0;&#xD800;"


@query(
    "decode_references",
    f"""SELECT page_id, md5(r) AS text_md5, substr(r, 1, 40) AS start FROM (SELECT page_id, {sql_decode_references('x')} AS r FROM (
          SELECT page_id, '&#' || CAST(page_id * 37 % 70000 AS VARCHAR) || ';&#x' || to_hex(page_id * 11 + 33) || '; ' || {sql_str(REFS)} || html AS x FROM pages))""",
)
def q_decode_references(spark, sf):
    """P1 named, decimal and hexadecimal references over whole pages, with numbers from all ranges"""
    p = V.table(spark, sf, "pages")
    pid = F.col("page_id")
    x = F.concat(F.lit("&#"), (pid * 37 % 70000).cast("string"), F.lit(";&#x"), F.hex(pid * 11 + 33), F.lit("; " + REFS), F.col("html"))
    r = p.select("page_id", P.decode_references(x).alias("r"))
    return r.select("page_id", F.md5("r").alias("text_md5"), F.substring("r", 1, 40).alias("start"))


def sql_html_to_text(e, threshold=fixed.PAGE_WORD_THRESHOLD):
    blocks = f"string_split_regex({sql_decode_references(sql_html_blocks(e))}, '\\n\\s*\\n')"
    norm = f"list_transform({blocks}, lambda b: trim(regexp_replace(b, '\\s+', ' ', 'g')))"
    keep = (
        f"list_filter({norm}, lambda b: b <> '' AND (starts_with(b, '#') OR "
        f"(length(b) - length(replace(b, ' ', '')) + 1) >= {threshold}))"
    )
    return f"array_to_string({keep}, chr(10) || chr(10))"


MD_SQL = f"SELECT page_id, url, html, {sql_html_to_text('html')} AS markdown FROM pages"


def sql_strip_sections(e):
    from quarry.functions.regex import re2

    for p in fixed.PAGE_SECTION_RULES:
        r = re2(p, "is")
        e = rr(e, r.pattern, r.replacement)
    return e


def sql_title(e):
    return f"coalesce(nullif(regexp_extract({e}, '(?m)^#\\s+(.+)$', 1), ''), 'Untitled')"


def sql_collapse(e):
    return rr(rr(e, r"\n{3,}", "\n\n"), r"\A\s+|\s+\z")


def sql_attachment(text, html):
    p = sql_str(fixed.ATTACHMENT_PATTERN)
    return f"coalesce(nullif(regexp_extract({text}, {p}), ''), nullif(regexp_extract({html}, {p}), ''))"


def sql_pub_date(e):
    p1, p2, p3 = (sql_str("(?i)" + fixed.DATE_DAY_MONTH_YEAR), sql_str(fixed.DATE_DOTTED), sql_str("(?i)" + fixed.DATE_MONTH_DAY_YEAR))
    m1, m2, m3 = f"regexp_extract({e}, {p1}, 0)", f"regexp_extract({e}, {p2}, 0)", f"regexp_extract({e}, {p3}, 0)"
    s1 = f"concat_ws(' ', regexp_extract({m1}, {p1}, 1), regexp_extract({m1}, {p1}, 2), regexp_extract({m1}, {p1}, 3))"
    s3 = f"concat_ws(' ', regexp_extract({m3}, {p3}, 1), regexp_extract({m3}, {p3}, 2), regexp_extract({m3}, {p3}, 3))"
    ts = (
        f"coalesce(CASE WHEN {m1} <> '' THEN try_strptime({s1}, '%d %B %Y') END, "
        f"CASE WHEN {m2} <> '' THEN try_strptime({m2}, '%d.%m.%Y') END, "
        f"CASE WHEN {m3} <> '' THEN try_strptime({s3}, '%B %d %Y') END)"
    )
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00')"


def markdown(spark, sf):
    p = V.table(spark, sf, "pages")
    return p.select("page_id", "url", "html", F.explode(F.array(P.html_to_text("html"))).alias("markdown"))


@query("html_to_text", with_views("SELECT page_id, markdown FROM md", md=MD_SQL))
def q_html(spark, sf):
    """P1 HTML to block text (excluded tags cut, 50-word blocks, headings kept)"""
    return markdown(spark, sf).select("page_id", "markdown")


@query("page_success", with_views("SELECT page_id FROM md WHERE markdown IS NOT NULL AND length(markdown) > 0", md=MD_SQL))
def q_success(spark, sf):
    """P2 pages that produced text"""
    return P.page_success(markdown(spark, sf)).select("page_id")


PRESS_MD_SQL = f"SELECT page_id, url, html, {sql_html_to_text('html')} AS markdown FROM ({PP})"


def press_markdown(spark, sf):
    return V.press_pages(spark, sf).select("page_id", "url", "html", F.explode(F.array(P.html_to_text("html"))).alias("markdown"))


@query("attachment_url", with_views(f"SELECT page_id, {sql_attachment('markdown', 'html')} AS pdf_url FROM md", md=PRESS_MD_SQL))
def q_attach(spark, sf):
    """P3 attachment link from text, else HTML"""
    return press_markdown(spark, sf).select("page_id", P.attachment_url("markdown", "html").alias("pdf_url"))


@query("strip_sections", with_views(f"SELECT page_id, {sql_strip_sections('markdown')} AS content FROM md", md=PRESS_MD_SQL))
def q_sections(spark, sf):
    """P4 trailing-section removal"""
    return press_markdown(spark, sf).select("page_id", P.strip_sections("markdown").alias("content"))


@query("page_title", with_views(f"SELECT page_id, {sql_title(sql_strip_sections('markdown'))} AS title FROM md", md=PRESS_MD_SQL))
def q_title(spark, sf):
    """P5 first '# ' heading after section removal"""
    return press_markdown(spark, sf).select("page_id", P.page_title(P.strip_sections("markdown")).alias("title"))


@query("collapse_blank", with_views(f"SELECT page_id, {sql_collapse(sql_strip_sections('markdown'))} AS content FROM md", md=PRESS_MD_SQL))
def q_collapse(spark, sf):
    """P6 blank-line collapse and strip"""
    return press_markdown(spark, sf).select("page_id", P.collapse_blank(P.strip_sections("markdown")).alias("content"))


@query("parse_pub_date", with_views(f"SELECT doc_id, {sql_pub_date('content')} AS date FROM dt", dt=V.dated_text_sql()))
def q_pub_date(spark, sf):
    """P7 publication date from a dateline (three forms, invalid falls through)"""
    d = V.dated_text(spark, sf)
    return d.select("doc_id", P.iso_utc(P.parse_pub_date("content")).alias("date"))


ARTICLE_SQL = f"""SELECT url, {sql_title(sql_strip_sections('markdown'))} AS title, {sql_pub_date('markdown')} AS date,
    {sql_attachment('markdown', 'html')} AS pdf_url, {sql_collapse(sql_strip_sections('markdown'))} AS content,
    '{SCRAPED_AT}' AS scraped_at FROM md WHERE markdown IS NOT NULL AND length(markdown) > 0"""


@query("article_record", with_views("SELECT * FROM a", md=PRESS_MD_SQL, a=ARTICLE_SQL))
def q_article(spark, sf):
    """P8 article record per page (P1..P7)"""
    return P.article_records(V.press_pages(spark, sf), F.lit(SCRAPED_AT))


# --------------------------------------------------------------- C12, C13
FIRST_PAGES_SQL = "SELECT * FROM pages WHERE page_id IN (SELECT min(page_id) FROM pages GROUP BY url)"
UPSERT_SQL = f"""SELECT c.idx, c.article_id, c.url,
    CASE WHEN a.idx IS NOT NULL THEN a.title ELSE c.title END AS title,
    CASE WHEN a.idx IS NOT NULL THEN a.date ELSE c.date END AS date,
    CASE WHEN a.idx IS NOT NULL THEN a.pdf_url ELSE c.pdf_url END AS pdf_url,
    CASE WHEN a.idx IS NOT NULL THEN true ELSE c.scraped END AS scraped,
    a.scraped_at AS scraped_at
  FROM cat c LEFT JOIN (SELECT p.idx, a.* FROM p JOIN a ON a.url = p.url) a ON a.idx = c.idx"""


def scrape_results(spark, sf):
    """Scrape of every pending catalog row: the page first stored for its URL."""
    pend = pending(spark, sf).select("idx", "url")
    pages = V.table(spark, sf, "pages")
    first = pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    pages = pages.join(first, ["url", "page_id"], "left_semi").join(pend.select("url"), "url", "left_semi")
    rec = P.article_records(pages, F.lit(SCRAPED_AT))
    return rec.join(pend, "url")


@query(
    "catalog_upsert",
    with_views(
        "SELECT * FROM u",
        cat=CAT,
        outs=OUTPUTS_SQL,
        p=PENDING_SQL,
        md=MD_SQL.replace("FROM pages", f"FROM ({FIRST_PAGES_SQL})"),
        a=ARTICLE_SQL,
        u=UPSERT_SQL,
    ),
)
def q_upsert(spark, sf):
    """C12 catalog update from scrape results (failures untouched)"""
    cat = V.catalog(spark, sf).withColumn("scraped_at", F.lit(None).cast("string"))
    return C.catalog_upsert(cat, scrape_results(spark, sf))


@query(
    "index_lookup",
    with_views(
        "SELECT i.id, CAST(coalesce(min(cat.idx), 0) AS BIGINT) AS idx FROM i LEFT JOIN cat ON cat.article_id = i.id GROUP BY i.id",
        cat=CAT,
        **_new_views(),
        i=f"SELECT id FROM n UNION SELECT {AID} AS id FROM cat WHERE scraped",
    ),
)
def q_index_lookup(spark, sf):
    """C13 catalog position of ids (new link ids miss -> 0; ids of scraped rows hit)"""
    cat = V.catalog(spark, sf)
    known = cat.filter("scraped").select(C.article_id_of("article_id", "url").alias("id"))
    items = new_links(spark, sf).select("id").unionByName(known).distinct()
    return C.index_lookup(items, cat.select("article_id", "idx"), "id").select("id", "idx")
