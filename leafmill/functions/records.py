"""Small rules for fields of discovery records: identifiers, addresses, titles, sizes, stamps and outcomes of a fetch."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def https(url: Column) -> Column:
    return F.regexp_replace(url, "^http://", "https://")


def allowed(url: Column, hosts: list[str]) -> Column:
    """Whether a URL is https and at one of the hosts (or below one); false for what is no URL."""
    h = F.lower(F.try_parse_url(url, F.lit("HOST")))
    below = [h == x for x in hosts] + [h.endswith("." + x) for x in hosts]
    found = F.lit(False)
    for c in below:
        found = found | c
    return F.coalesce((F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == "https") & found, F.lit(False))


def decade(number: Column) -> Column:
    """"1970s" for what begins with a year, else "undated"."""
    return F.when(number.rlike(r"^\d{4}"), F.concat(F.substring(number, 1, 3), F.lit("0s"))).otherwise("undated")


def labelled_title(title: Column) -> Column:
    """Product and labeller of "product [labeller]"; without brackets the whole is the product."""
    return F.struct(F.trim(F.regexp_replace(title, r"\s*\[[^\]]*\]\s*$", "")).alias("product"), F.nullif(F.regexp_extract(title, r"\[([^\]]*)\]\s*$", 1), F.lit("")).alias("labeller"))


def page_file(page_no: Column) -> Column:
    return F.format_string("%05d.pdf", page_no)


def first_text(values: Column) -> Column:
    """The first element of a list that isn't blank."""
    return F.try_element_at(F.filter(values, lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""), F.lit(1))


def whole_number(text: Column) -> Column:
    return F.trim(text).try_cast("long")


def page_ranges(text: Column) -> Column:
    """"0-2,9" as [0, 1, 2, 9]; parts that aren't numbers or ranges are left out."""
    parts = F.filter(F.split(F.regexp_replace(text, r"\s", ""), ","), lambda x: x.rlike(r"^\d+(-\d+)?$"))
    end = lambda x, i: F.try_element_at(F.split(x, "-"), F.lit(i)).cast("int")
    return F.flatten(F.transform(parts, lambda x: F.when(end(x, 1) <= end(x, -1), F.sequence(end(x, 1), end(x, -1))).otherwise(F.array().cast("array<int>"))))


def strict_date(text: Column) -> Column:
    """A date only if it is written yyyy-mm-dd and exists."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def stamp(text: Column, zone: str = "Asia/Hong_Kong") -> Column:
    """dd/MM/yyyy HH:mm of a zone, or Mon dd, yyyy, as a timestamp; null for anything else."""
    local = F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm")), zone)
    return F.coalesce(local, F.try_to_timestamp(text, F.lit("MMM d, yyyy")))


def role_score(name: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the patterns found in a file name."""
    text = F.lower(F.coalesce(name, F.lit("")))
    total = F.lit(0)
    for pattern, weight in weights.items():
        total = total + F.when(text.rlike(pattern), weight).otherwise(0)
    return total


def fetch_outcome(status: Column, content_type: Column, refused: Column) -> Column:
    """ok, transient or permanent: a refusal (by marker in the body) or a busy server may pass, a missing file or another kind of content won't."""
    pdf = F.lower(F.coalesce(content_type, F.lit(""))).contains("pdf")
    return (
        F.when(F.coalesce(refused, F.lit(False)) | status.isNull() | status.isin(202, 403, 406, 408, 425, 429) | (status >= 500), "transient")
        .when((status == 200) & pdf, "ok")
        .otherwise("permanent")
    )


def bare(text: Column) -> Column:
    """Lower-case ASCII letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "")


def shard_path(root: str, sha: Column, suffix: str = "pdf") -> Column:
    """Where a content lies: two folders of two digits of its hash."""
    return F.concat(F.lit(f"{root}/"), F.substring(sha, 1, 2), F.lit("/"), F.substring(sha, 3, 2), F.lit("/"), sha, F.lit(f".{suffix}"))


def is_pdf(head: Column) -> Column:
    """Whether a content (its first 1,024 bytes are looked at) begins as a PDF, after white space; null isn't one."""
    return F.coalesce(F.decode(F.substring(head, 1, 1024), "ISO-8859-1").rlike(r"^\s*%PDF-"), F.lit(False))


def clamped_pages(pages: Column, n_pages: Column) -> Column:
    """Selected pages once each, in order, within 1 to the number of pages."""
    return F.array_sort(F.array_distinct(F.filter(pages, lambda p: (p >= 1) & (p <= n_pages))))


#: The fields of ``extra`` that make a title, by source; all that are filled are joined, for the last three the first one is taken.
TITLE_FIELDS = {"edinet": ["filer_name", "doc_description"], "sec_edgar": ["company_name", "form_type", "filing_date"], "municipal_acfr": ["entity", "entity_type", "fiscal_year"], "bis": ["institution", "series", "doc_id"]}
FIRST_FIELD = {"courtlistener": ["case_name", "description"], "govdocs1": ["zip_member"], "safedocs_ccmain": ["file_name"]}
OTHER_FIELDS = ["title", "search_title"]


def title_of(source: Column, extra: Column, source_id: Column, most: int = 160) -> Column:
    """The line by which a document is told in a list: from the fields of its source, else its id there; at most ``most`` characters."""
    filled = lambda names: [F.nullif(F.get_json_object(extra, f"$.{n}"), F.lit("")) for n in names]
    out = F.when(F.lit(False), F.lit(""))
    for name, fields in TITLE_FIELDS.items():
        out = out.when(source == name, F.concat_ws(" · ", *filled(fields)))
    for name, fields in FIRST_FIELD.items():
        out = out.when(source == name, F.coalesce(*filled(fields), F.lit("")))
    return F.substring(F.coalesce(F.nullif(out.otherwise(F.coalesce(*filled(OTHER_FIELDS), F.lit(""))), F.lit("")), source_id), 1, most)


# What differs by source in what an answer means. Marked bodies are refusals (or, of un_digital_library, challenges); "strict" sources take an answer that is no PDF
# for permanent whatever its status, "body" ones have the status in the body, "second" ones have another address to try after a permanent failure.
STRICT, IN_BODY, SECOND = ["sec_edgar", "municipal_acfr", "un_digital_library"], ["edinet"], ["eurlex", "fraser"]


def outcome_of(source: Column, status: Column, content_type: Column, refused: Column, body_status: Column) -> Column:
    """ok, transient, permanent or second (try the other address), by the rules of the source."""
    pdf = F.lower(F.coalesce(content_type, F.lit(""))).contains("pdf")
    shared = fetch_outcome(status, content_type, refused)
    marked = F.coalesce(refused, F.lit(False))
    return (
        F.when((source == "un_digital_library") & (status == 202), F.when(marked, "transient").otherwise("permanent"))
        .when(source.isin(STRICT) & (status == 200) & ~pdf & ~marked, "permanent")
        .when(source.isin(IN_BODY) & (status == 200) & ~pdf, F.when(body_status.isin(400, 404), "permanent").otherwise("transient"))
        .when((source == "state_bills") & (status == 404), "permanent")
        .when(source.isin(SECOND) & (shared == "permanent"), "second")
        .otherwise(shared)
    )


@pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Tags to spaces, then every entity of HTML resolved, then white space collapsed."""
    return text.map(lambda t: None if t is None else " ".join(html.unescape(re.sub(r"<[^>]*>", " ", t)).split()))


@pandas_udf(StringType())
def blake_order(text: pd.Series) -> pd.Series:
    """Eight bytes of BLAKE2b in hex: the pseudo-random order that some sources are walked in."""
    return text.map(lambda t: None if t is None else hashlib.blake2b(t.encode(), digest_size=8).hexdigest())


@pandas_udf(StringType())
def plain_query(text: pd.Series) -> pd.Series:
    """A search text for comparison: entities resolved, brackets around the whole removed, white space collapsed, lower case."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = " ".join(html.unescape(t).split())
        while len(t) > 1 and t[0] == "(" and t[-1] == ")" and _closes_last(t):
            t = t[1:-1].strip()
        return t.lower()

    return text.map(one)


def _closes_last(t: str) -> bool:
    depth = 0
    for k, c in enumerate(t):
        depth += (c == "(") - (c == ")")
        if not depth:
            return k == len(t) - 1
    return False
