"""Tiers of licence texts: commercial, restricted or unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers of the tiers, the restricted ones first.
RESTRICTED = ["-nc", "noncommercial", "non-commercial", "not for redistribution", "no derivative", "-nd", "research only", "research-only", "all rights reserved"]
COMMERCIAL = ["public domain", "publicdomain", "public-domain", "us government work", "cc0", "cc-by", "cc by", "pdl-1.0", "pdl 1.0", "apache", "mit"]
EXACT = {"public-domain": "commercial", "cc0": "commercial", "cc-by": "commercial", "cc-by-sa": "commercial", "pdl-1.0": "commercial", "non-commercial": "restricted", "no-derivatives": "restricted", "research-only": "restricted"}


def _pattern(words: list[str], strict: bool) -> str:
    body = "|".join(w.replace(".", "[.]") for w in words)
    return rf"(^|[^a-z0-9])({body})($|[^a-z0-9])" if strict else f"({body})"


def licence_tier(text: Column, strict: bool = False) -> Column:
    """Exact names, then restricted markers, then commercial ones; anything else, null or empty is unknown. By default a marker
    counts inside longer words too ("submitted" holds "mit"); strict asks for word borders and reads spaces as hyphens."""
    bare = F.lower(F.trim(text))
    tier = F.when(bare.isNull() | (bare == ""), "unknown")
    for name, value in EXACT.items():
        tier = tier.when(bare == name, value)
    seen = F.regexp_replace(bare, "[ _/]+", "-") if strict else bare
    restricted = [w.strip("-").replace(" ", "-") for w in RESTRICTED] if strict else RESTRICTED
    commercial = [w.replace(" ", "-") for w in COMMERCIAL] if strict else COMMERCIAL
    return tier.when(seen.rlike(_pattern(restricted, strict)), "restricted").when(seen.rlike(_pattern(commercial, strict)), "commercial").otherwise("unknown")


def tier_sql(column: str) -> str:
    exact = " ".join(f"when lower(trim({column})) = '{k}' then '{v}'" for k, v in EXACT.items())
    return f"case when {column} is null or trim({column}) = '' then 'unknown' {exact} when regexp_matches(lower(trim({column})), '{_pattern(RESTRICTED, False)}') then 'restricted' when regexp_matches(lower(trim({column})), '{_pattern(COMMERCIAL, False)}') then 'commercial' else 'unknown' end"
