"""Spellings: names of sources, hosts and hashes as one form each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of ASCII and the no-break space.
_SPACE = r"[\s ]"


def source_key(column: Column) -> Column:
    """One spelling per source: lower case, no white space around, one underscore between words. Null stays null."""
    return F.regexp_replace(F.lower(F.regexp_replace(column, f"^{_SPACE}+|{_SPACE}+$", "")), r"[\s _-]+", "_")


def host(domain: Column, url: Column) -> Column:
    """The domain, or the host of the url where there is none: lower case, without user, port, leading www. or final dot."""
    from_url = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    bare = F.lower(F.trim(F.coalesce(domain, from_url)))
    return F.nullif(F.regexp_replace(F.regexp_replace(bare, r":[0-9]*$", ""), r"^www\.|\.+$", ""), F.lit(""))
