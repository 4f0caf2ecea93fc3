"""Fixed values.

Everything in this module must equal the values of the pipeline whose
results we reproduce: regular expressions (written in Python ``re``
syntax, applied with DOTALL | IGNORECASE | MULTILINE unless said
otherwise), delimiters and text templates. They are kept here, in their
natural order, as plain data. ``quarry.functions.regex`` turns each pattern
into its Java form (Spark) and its RE2 form (DuckDB oracle).
"""

from __future__ import annotations

# --- Fixed values: text-cleaning rules, applied in this order ------------------
# (group, pattern)
BOILERPLATE_RULES: list[tuple[str, str]] = [
    # image reference codes
    ("image_codes", r"\bP90\d{6}\b"),
    # page markers
    ("page_markers", r"\nPage\s+\d+"),
    ("page_markers", r"\bPage\s+\d+\b"),
    ("page_markers", r"\bSeite\s+\d+\b"),
    # corporate headers
    ("corporate_headers", r"(?:^|\n)\s*CORPORATE\s+COMMUNICATIONS\s*(?:\n|\s)"),
    ("corporate_headers", r"(?:^|\n)\s*Corporate\s+Communications\s*(?:\n|$)"),
    ("corporate_headers", r"Corporate\s+Communication\s+Media\s+Information\s+.*?\d{4}\s*"),
    ("corporate_headers", r"BMW\s+Corporate\s+Communications\s*\n?"),
    ("corporate_headers", r"PRESSE-?\s*UND\s*ÖFFENTLICHKEITSARBEIT\s*\n?"),
    # press / media information headers, subject and date lines
    ("media_headers", r"(?:^|\n)\s*Media\s+[Ii]nformation\s+(?:BMW\s+)?.*?\d{4}\s*(?:Subject\s*)?"),
    ("media_headers", r"(?:^|\n)\s*Media\s+[Ii]nformation\s*\n\s*\d+\s+\w+\s+\d{4}\s*\n?"),
    ("media_headers", r"(?:^|\n)\s*MEDIA\s+INFORMATION\s+.*?\d{4}\s*"),
    ("media_headers", r"Media\s+Information\s+Date\s+.*?(?=\n\n|\n[A-Z])"),
    ("media_headers", r"Presse\s+Information\s*\n"),
    ("media_headers", r"Datum\s+\d+.*?\d{4}\s*\n"),
    ("media_headers", r"Subject\s+.*?(?=\n\n)"),
    ("media_headers", r"Thema\s+.*?(?=\n\n)"),
    # contact blocks
    ("contacts", r"Media\s+Contact\..*?(?=\n\n|\Z)"),
    ("contacts", r"Bitte\s+wenden\s+Sie\s+sich\s+bei\s+Rückfragen.*?(?=\n\n|\Z)"),
    ("contacts", r"(?:Telefon|Phone|T\s*elephone):\s*\+?\d[\d\s\-()]+\s*\n?"),
    ("contacts", r"E-?[Mm]ail:\s*[\w\.\-]+@[\w\.\-]+\s*\n?"),
    ("contacts", r"Fax\s+\+?\d[\d\s\-]+\s*\n?"),
    ("contacts", r"Press\s+Officer.*?(?=\n\n|\Z)"),
    ("contacts", r"Spokesperson.*?(?=\n\n|\Z)"),
    ("contacts", r"Head\s+of\s+.*?Communications.*?(?=\n\n|\Z)"),
    # company address blocks
    ("addresses", r"Firma\s+Bayerische.*?(?=\n\n)"),
    ("addresses", r"Postanschrift\s+BMW\s+AG.*?(?=\n\n)"),
    ("addresses", r"Company\s+Bayerische\s+Motoren.*?(?=\n\n)"),
    ("addresses", r"Bayerische\s+Motoren\s*\nAktiengesellschaft.*?(?=\n\n|\Z)"),
    # social media and website blocks
    ("web", r"(?:LinkedIn|YouTube|Instagram|Facebook|X|Twitter):\s*https?://[^\s]+\s*\n?"),
    ("web", r"www\.(?:facebook|instagram|twitter|x)\.com/[^\s]+\s*\n?"),
    ("web", r"↗\s*www\.[^\s]+\s*\n?"),
    ("web", r"Internet:\s*www\.[\w\.]+\s*\n?"),
    ("web", r"(?:Media\s+)?Website\.?\s*\n?.*?www\.[\w\.\-/]+\s*\n?"),
    ("web", r"BMW\s+M\s+Motorsport\s+on\s+the\s+Web\..*?(?=\n\n|\Z)"),
    # company "about" boilerplate
    ("about", r"The\s+BMW\s+Group\s+With\s+its\s+four\s+brands.*?useful\s+life\.?"),
    ("about", r"Die\s+BMW\s+Group\s+ist\s+mit\s+ihren.*?Nutzungsphase.*?Produkte\.?"),
    ("about", r"The\s+BMW\s+Group\s*\n\s*With\s+its\s+four\s+brands.*?(?=\n\n|\Z)"),
    # confidentiality marker
    ("confidential", r"CONFIDENTIAL\s*"),
    # regulatory disclaimers
    ("disclaimers", r"(?:Die|The)\s+(?:Angaben|information).*?(?:WLTP|NEFZ).*?(?=\n\n|\Z)"),
    ("disclaimers", r"www\.bmw\.de/wltp.*?(?=\n)"),
    (
        "disclaimers",
        r"(?:Weitere\s+)?(?:Informationen|Information).*?(?:Kraftstoffverbrauch|fuel\s+consumption).*?unentgeltlich\s+erhältlich.*?(?=\n\n|\Z)",
    ),
    # published-by / contacts / investor sections
    ("sections", r"PUBLISHED\s+BY\s*\n.*?(?=\n\n|\Z)"),
    ("sections", r"CONTACTS?\s*\n.*?(?=\n\n|\Z)"),
    ("sections", r"BUSINESS\s+AND\s+FINANCE\s+PRESS.*?(?=\n\n|\Z)"),
    ("sections", r"INVESTOR\s+RELATIONS.*?(?=\n\n|\Z)"),
    ("sections", r"THE\s+BMW\s+GROUP\s+ON\s+THE\s+INTERNET.*?(?=\n\n|\Z)"),
]

# --- Fixed values: scraped-page section removal (DOTALL | IGNORECASE) --------
PAGE_SECTION_RULES: list[str] = [
    r"#### Press Contact\.\n.*?(?=\n####|\n\n[A-Z]|\Z)",
    r"#### Author\.\n.*?(?=\n####|\n\n[A-Z]|\Z)",
    r"#### Downloads\.\n.*?(?=\n####|\n\n[A-Z]|\Z)",
    r"#### This article in other PressClubs\n.*?(?=\n####|\n\n[A-Z]|\Z)",
    r"#### Article Offline Attachments\.\n.*?(?=\n####|\n\n[A-Z]|\Z)",
    r"#### Article Media Material\.\n.*?(?=\n####|\Z)",
]

# --- Fixed values: link discovery and attachment patterns -------------------
ARTICLE_LINK_PATTERN = r"/global/article/detail/(T\d+EN)/([^\"'<>\s?]+)"
ARTICLE_URL_BASE = "https://www.press.bmwgroup.com/global/article/detail/"
ATTACHMENT_PATTERN = r"https://www\.press\.bmwgroup\.com/global/article/attachment/T\d+EN/\d+"
EMBEDDED_JSON_PATTERN = r"window\.collectedArticles\s*=\s*(\[.*?\]);"

# --- Fixed values: publication-date patterns (IGNORECASE) -------------------
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE_DAY_MONTH_YEAR = r"(\d{1,2})\s+(" + MONTHS + r")\s+(\d{4})"
DATE_DOTTED = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
DATE_MONTH_DAY_YEAR = r"(" + MONTHS + r")\s+(\d{1,2}),?\s+(\d{4})"

# --- Fixed values: processed-text framing -----------------------------------
METADATA_START = "--- METADATA ---"
REASONING_START = "--- REASONING ---"
CONTENT_START = "--- CONTENT ---"

# --- Fixed values: training-text templates ----------------------------------
SYSTEM_MESSAGE = (
    "You are a BMW automotive expert assistant. "
    "Provide accurate, detailed information about BMW vehicles, technology, and company news."
)
INSTRUCT_USER_PREFIX = "Tell me about: "
ARTICLE_HEADING_PREFIX = "### BMW Press Release: "
QA_QUESTION_PREFIX = "What is the latest news about "
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
THINK_TOKEN = "/think "
NO_THINK_TOKEN = "/no_think "

# --- Fixed values: content-filter protocol ----------------------------------
FILTER_SYSTEM_PROMPT = """You are a document cleaning assistant for BMW press releases. Your task is to clean the text content extracted from PDF.

Instructions:
1. FIND the article title in the content and REMOVE everything before it (headers like "Topic", "Media Information", "Press Information", "MINI", "Company", company headers, dates, etc.)
2. REMOVE any remaining boilerplate: contact info, social media links, page numbers, "If you have any questions" sections, spokesperson info, repeated headers
3. REMOVE pdf header/footer patterns like random appearance of "Topic xxx" "Subject xxx" "Date xxx" "Page xxx" in the content
4. VALIDATE the content is:
   - Not empty or just bullet points (like "• \\n• \\n• \\n•")
   - Not garbled/corrupted text (random unicode, encoding errors)
   - In the expected language (English for English titles, German for German titles)
   - Has meaningful content (more than just a few words)

If content is VALID after cleaning, return ONLY the cleaned text, nothing else.
If content is INVALID after cleaning, return exactly: REJECT: [reason]
"""
FILTER_USER_TEMPLATE = """Title: {title}

Raw Content:
{content}
"""
REASONING_MARKER = "analysis"
ANSWER_MARKER = "assistantfinal"
REJECT_PREFIX = "REJECT:"
EMPTY_REASON = "Empty content"
FILTER_MAX_INPUT_CHARS = 8000
FILTER_BATCH_SIZE = 14

# --- Fixed values: pipeline limits and defaults -----------------------------
TEXT_LENGTH_THRESHOLD = 1_000_000
DEFAULT_TRAIN_RATIO = 0.9
DEFAULT_SEED = 42
DEFAULT_MAX_LENGTH = 4096
PADDING_LABEL = -100
ENTAILMENT_THRESHOLD = 0.8
COSINE_EPS = 1e-8
HISTOGRAM_BINS = 50
PERCENTILES = (90, 95, 99)
PAGE_WORD_THRESHOLD = 50
PAGE_EXCLUDED_TAGS = ("nav", "footer", "header", "aside")
