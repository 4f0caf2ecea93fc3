"""SQL (DuckDB) fragments mirroring the column expressions, for the oracle.

Each function takes a SQL expression string and returns one. They mirror
``quarry.operators`` one for one; the oracle queries are built from them so
that the rule table exists once.
"""

from __future__ import annotations

from quarry.functions import fixed
from quarry.functions.regex import PY_DIGIT, PY_SPACE, PY_WORD, re2, sql_str

W = f"[{PY_WORD}]"
SPACE, DIGIT = f"[{PY_SPACE}]", f"[{PY_DIGIT}]"


def rr(expr: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({expr}, {sql_str(pattern)}, {sql_str(repl)}, 'g')"


def fix_hyphens(e: str) -> str:
    return rr(e, f"({W})-\\n({W})", r"\1\2")


def norm_spaces(e: str) -> str:
    return rr(e, r"[ \t]+", " ")


def trim_lines(e: str) -> str:
    return rr(e, r"(?m)^[ \t]+|[ \t]+$")


def norm_paragraphs(e: str) -> str:
    return rr(e, r"\n{3,}", "\n\n")


def drop_page_numbers(e: str) -> str:
    return rr(e, f"(?m)^{DIGIT}+{SPACE}*$")


def apply_rule(e: str, pattern: str, flags: str = "ims") -> str:
    r = re2(pattern, flags)
    return rr(e, r.pattern, r.replacement)


def strip_boilerplate(e: str, rules=fixed.BOILERPLATE_RULES, skip_groups=()) -> str:
    for group, pattern in rules:
        if group not in set(skip_groups):
            e = apply_rule(e, pattern)
    return e


def strip_ws(e: str) -> str:
    return rr(e, f"\\A{SPACE}+|{SPACE}+\\z")


def strip_and_collapse(e: str) -> str:
    return norm_paragraphs(strip_ws(e))


def clean_text(e: str, rules=fixed.BOILERPLATE_RULES, skip_groups=()) -> str:
    t = drop_page_numbers(norm_paragraphs(trim_lines(norm_spaces(fix_hyphens(e)))))
    return strip_and_collapse(strip_boilerplate(t, rules, skip_groups))


def word_count(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, '[^{PY_SPACE}]+')) AS BIGINT)"


def idx_from_name(e: str) -> str:
    return f"CAST(nullif(regexp_extract({e}, '^(\\d+)_', 1), '') AS BIGINT)"


def rnd(e: str, places: int = 6) -> str:
    return f"round(CAST({e} AS DOUBLE), {places})"
