"""Measures of texts, as expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a number as it stands in a cell, with currency, brackets and up to three letters behind.
NUMERIC = r"^[\s(\[]*[-+$€£¥]?\s*\d[\d,.\s]*\s*[%)\]a-zA-Z]{0,3}\s*$"
#: Letters of scripts other than Latin, in the order in which they are tried, and from which share of all letters on.
SCRIPTS = {"ar": "[\u0600-\u06ff]", "cjk": "[\u4e00-\u9fff]", "ja": "[\u3040-\u30ff]", "ko": "[\uac00-\ud7af]", "el": "[\u0370-\u03ff]", "cy": "[\u0400-\u04ff]", "hi": "[\u0900-\u097f]", "he": "[\u0590-\u05ff]", "th": "[\u0e00-\u0e7f]"}
SCRIPT_SHARE = 0.3
# Fixed values of the form score: pattern and weight of each sign, and the most that count; key phrases count once each.
FILL, BOX, LABEL = r"_{3,}|\.{6,}|…{2,}", r"[☐☑☒□■▢◻◼○●]|\[\s?\]|\(\s?\)", r"^\s*[A-Z][A-Za-z /&().'-]{1,40}:\s*$"
PHRASES = r"(?i)\b(signature|date signed|print name|name of|address|city|state|zip|telephone|phone|ssn|social security|ein|employer identification|omb no|form [a-z]?-?\d|part [ivx]+\b|section [a-z\d]\b|check (?:one|all|the box|if)|yes\s+no|for office use|applicant|signature of|title|amount|total)\b"
WEIGHTS = {"fills": (0.08, 20), "boxes": (0.06, 20), "phrases": (0.09, 15), "labels": (0.04, 20)}
SHORT_LINE, PROSE_LINE = (4, 0.8), (14, -1.2)


def words(text: Column) -> Column:
    """Number of words between white space; 0 for null or blank."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " ")))


def is_numeric(text: Column) -> Column:
    return F.trim(text).rlike(NUMERIC)


def script(text: Column) -> Column:
    """The first script other than Latin that has more than three tenths of the letters, else "latin"; "none" without letters."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]+", "")
    least = F.length(letters) * SCRIPT_SHARE
    out = F.when(letters == "", "none")
    for name, pattern in SCRIPTS.items():
        out = out.when(F.regexp_count(letters, F.lit(pattern)) > least, name)
    return out.otherwise("latin")


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")


def form_score(text: Column) -> Column:
    """How much a text reads like a form: blanks to fill, boxes, key phrases, labels and short lines speak for it, lines of prose against. 0 without lines.
    Lines are split once and their words counted once."""
    bare = F.coalesce(text, F.lit(""))

    def score(lines: Column) -> Column:
        phrases = F.size(F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(PHRASES), 1), lambda x: F.lower(x))))
        labels = F.size(F.filter(lines, lambda x: x.rlike(LABEL)))
        signs = {"fills": F.regexp_count(bare, F.lit(FILL)), "boxes": F.regexp_count(bare, F.lit(BOX)), "phrases": phrases, "labels": labels}
        total = F.lit(0.0)
        for name, (weight, most) in WEIGHTS.items():
            total = total + F.least(signs[name], F.lit(most)) * weight
        # The shares of short lines and of lines of prose from one pass over the numbers of words.
        share = F.aggregate(F.transform(lines, words), F.lit(0.0), lambda a, n: a + F.when(n <= SHORT_LINE[0], SHORT_LINE[1]).when(n >= PROSE_LINE[0], PROSE_LINE[1]).otherwise(0.0))
        return F.when(F.size(lines) == 0, 0.0).otherwise(total + F.try_divide(share, F.size(lines)))

    return F.transform(F.array(filled_lines(text)), score)[0]


def shingles(text: Column, width: int = 5) -> Column:
    """Distinct runs of ``width`` words of ASCII letters and digits, in lower case."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), 1)

    def runs(words: Column) -> Column:
        n = F.size(words) - (width - 1)
        return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(words, i, width), " ")))).otherwise(F.array().cast("array<string>"))

    # As the variable of an outer lambda the tokens are found once, not once per run.
    return F.transform(F.array(tokens), runs)[0]


def html_text(html: Column) -> Column:
    """Tags become spaces, then the five entities of XML and the no-break space are resolved, then white space is collapsed."""
    out = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)href\s*=\s*["']([^"'#]+)"""), 1)


def last_section(text: Column) -> Column:
    """The last part between semicolons that isn't empty, with single spaces; null if there is none."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    return F.try_element_at(parts, F.lit(-1))


def latest_year(text: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"((?:18|19|20)\d{2})"), 1), lambda x: x.cast("int")))


def size_in_bytes(text: Column) -> Column:
    """"12KB", "3.5 MB" and the like in bytes; null if there is no such number."""
    number, unit = F.regexp_extract(text, r"(?i)([0-9.]+)\s*([KMG])B", 1), F.upper(F.regexp_extract(text, r"(?i)([0-9.]+)\s*([KMG])B", 2))
    factor = F.when(unit == "K", 1024).when(unit == "M", 1024**2).when(unit == "G", 1024**3)
    return (number.try_cast("double") * factor).cast("long")


def robots_pattern(rule: Column) -> Column:
    """A path rule with * as a pattern that matches from the start."""
    return F.concat(F.lit("^"), F.replace(F.regexp_replace(rule, r"([.+?()\[\]{}|^\\])", r"\\$1"), F.lit("*"), F.lit(".*")))
