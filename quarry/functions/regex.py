"""One place where rule patterns get their engine-specific form.

Rules are stored in Python ``re`` syntax (see ``fixed.py``). Spark runs Java
regular expressions, the DuckDB oracle runs RE2. The differences that matter
for the rules are handled here and nowhere else:

* ``\\Z`` (Python: end of text) is ``\\z`` in Java and RE2; Java's ``\\Z``
  would also stop before a final newline.
* Python's ``\\w``/``\\d``/``\\s`` in str patterns are Unicode classes. They
  are spelled out explicitly (letters, numbers and underscore; decimal
  digits; Python's whitespace set), so Java and RE2 read the same class.
* IGNORECASE with Unicode case folding is ``(?iu)`` in Java (``(?i)`` in RE2).
* ``(?d)`` makes Java treat only ``\\n`` as a line end, like Python.
* RE2 has no look-ahead. The rules only use a trailing look-ahead; it is
  rewritten as a capture group that the replacement puts back (``\\1``).
  This is equivalent because no rule starts with a newline or assertion.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

PY_WORD = r"\p{L}\p{N}_"
PY_DIGIT = r"\p{Nd}"
PY_SPACE = r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Those of ``PY_SPACE`` that Java's ``\s`` without flags lacks.
RARE_SPACE = [chr(x) for x in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_CLASSES = {"w": PY_WORD, "d": PY_DIGIT, "s": PY_SPACE}


def _spell_classes(p: str) -> str:
    """Replace ``\\w``, ``\\d``, ``\\s`` (inside or outside brackets) by explicit classes."""
    out: list[str] = []
    i = 0
    in_class = False
    while i < len(p):
        ch = p[i]
        if ch == "\\" and i + 1 < len(p):
            cls = _CLASSES.get(p[i + 1])
            if cls is not None:
                out.append(cls if in_class else f"[{cls}]")
            else:
                out.append(p[i : i + 2])
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def jre(pattern: str, flags: str = "imsdu") -> str:
    """Java form of a Python-syntax pattern with inline flags."""
    body = _spell_classes(pattern.replace(r"\Z", r"\z"))
    return f"(?{flags}){body}" if flags else body


SPACE = jre(r"\s", "")
#: A whole text in its middle, group 1, and the white space around it: read to the end once and back over the trailing run.
#: ``\A\s+|\s+\z`` would try every place of the text, and every run of white space once for each of its characters.
STRIPPED = jre(r"\A\s*(.*[^\s])?\s*\Z", "s")


def strip_space(t):
    """Without the white space at both ends, as Python's ``str.strip``; the pattern runs only where an end has some."""
    from pyspark.sql import functions as F

    loose = lambda x: F.substring(x, 1, 1).rlike(SPACE) | F.right(x, F.lit(1)).rlike(SPACE)
    strip = lambda x: F.when(loose(x), F.regexp_replace(x, STRIPPED, "$1")).otherwise(x)
    return F.element_at(F.transform(F.array(t), strip), 1)  # a lambda, so that ``t`` is evaluated once


@dataclass(frozen=True)
class Re2Rule:
    pattern: str
    replacement: str


def re2(pattern: str, flags: str = "ims") -> Re2Rule:
    """RE2 form of a Python-syntax pattern for ``regexp_replace(.., 'g')``."""
    body = _spell_classes(pattern.replace(r"\Z", r"\z"))
    replacement = ""
    if body.endswith(")") and "(?=" in body:
        start = body.rfind("(?=")
        # only a trailing look-ahead group is supported
        depth = 0
        for j in range(start, len(body)):
            if body[j] == "(" and body[j - 1 : j] != "\\":
                depth += 1
            elif body[j] == ")" and body[j - 1 : j] != "\\":
                depth -= 1
                if depth == 0:
                    break
        if j == len(body) - 1:
            body = body[:start] + "(" + body[start + 3 :]
            replacement = r"\1"
    if "(?=" in body or "(?!" in body or "(?<" in body:
        raise ValueError(f"pattern needs look-around RE2 lacks: {pattern}")
    prefix = f"(?{flags})" if flags else ""
    return Re2Rule(prefix + body, replacement)


def sql_str(s: str) -> str:
    """SQL string literal (standard quoting; backslashes stay literal)."""
    return "'" + s.replace("'", "''") + "'"


def required_words(pattern: str) -> list[list[str]]:
    """What every match of a Python-syntax pattern holds: of each list at least one lower-case ASCII word.

    Read off the parsed pattern: the runs of three and more plain characters that
    no quantifier, class or look-around makes optional, and for an alternation
    one word per branch. A text that lacks all words of one list (see
    ``probe_text``) has no match.
    """
    import re._constants as sre  # the standard library's own parser, so that no syntax is read twice
    import re._parser as parser

    def of(items) -> list[list[str]]:
        found, run = [], ""
        for op, arg in [*items, (None, None)]:
            if op is sre.LITERAL and arg < 128:
                run += chr(arg).lower()
                continue
            if len(run) >= 3:
                found.append([run])
            run = ""
            if op is sre.SUBPATTERN:
                found += of(arg[-1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                found += of(arg[2])
            elif op is sre.BRANCH:
                each = [of(b) for b in arg[1]]
                if all(each):  # of each branch the list with the longest words
                    found.append([w for b in each for w in max(b, key=lambda o: min(map(len, o)))])
        return found

    return [list(x) for x in dict.fromkeys(tuple(x) for x in of(list(parser.parse(pattern, re_flags()))))]


def re_flags() -> int:
    import re

    return re.IGNORECASE | re.MULTILINE | re.DOTALL


#: Letters beyond ASCII that a pattern's folding takes for ASCII ones, and those.
FOLDED = {"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"}


def probe_text(t):
    """What ``required_words`` are looked up in: lower case, after the four letters that a pattern's folding takes for ASCII ones."""
    from pyspark.sql import functions as F

    rare = functools.reduce(operator.or_, [t.contains(x) for x in FOLDED])  # letter by letter only where there are any
    return F.lower(F.when(rare, F.translate(t, "".join(FOLDED), "".join(FOLDED.values()))).otherwise(t))
