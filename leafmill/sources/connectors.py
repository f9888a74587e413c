"""What distinguishes the catalogued sources: shape of paging, page size, hard limits, rate, and where the fields of a record lie.

Network addresses are options of a read, not part of this table. Records are JSON unless the shape says otherwise; ``fields`` are dotted paths.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Connector:
    name: str
    shape: str  # archive, offset, cursor, window, sitemap, seeds, generated, single
    page: int = 100  # records of a full answer; 0: an answer is whole, however many it holds
    most: int = 10_000  # offset: rows that can be reached; window: records of one; seeds: pages followed of each; generated: numbers of a key; else unused
    per_second: float = 1.0
    items: str = "items"
    fields: dict = field(default_factory=lambda: {"source_id": "id", "url": "url", "license": "license"})
    licence: str = "unknown"
    accept_terms: bool = False
    xml: str = ""


def _make(rows: list[tuple]) -> dict[str, Connector]:
    return {r[0]: Connector(r[0], r[1], **r[2]) for r in rows}


# The sources.
CONNECTORS = _make(
    [
        ("govdocs1", "archive", {"licence": "public-domain-usgov"}),
        ("safedocs_ccmain", "archive", {"licence": "third-party-web-content"}),
        ("internet_archive", "cursor", {"page": 1000, "per_second": 2.0, "most": 1_000_000}),
        ("arxiv", "offset", {"page": 100, "per_second": 0.34, "most": 30_000, "xml": "entry"}),
        ("pmc_oa", "cursor", {"page": 1000, "per_second": 2.5, "most": 9_999}),
        ("govinfo", "sitemap", {"per_second": 0.8, "licence": "public-domain", "most": 1_000_000}),
        ("sec_edgar", "window", {"page": 0, "per_second": 1.5, "most": 1_000_000}),
        ("bis", "sitemap", {"licence": "non-commercial", "most": 1_000_000}),
        ("boe", "seeds", {}),
        ("boj", "seeds", {}),
        ("openalex", "cursor", {"page": 200, "per_second": 5.0, "most": 10_000}),
        ("eurlex", "window", {"page": 2000, "licence": "EU-reuse", "most": 1_000_000}),
        ("worldbank", "offset", {"page": 100, "per_second": 2.0, "most": 100_000}),
        ("ntrs", "window", {"page": 100, "per_second": 0.5, "most": 10_000}),
        ("fraser", "sitemap", {"per_second": 0.1, "most": 1_000_000}),
        ("municipal_acfr", "window", {"page": 0, "most": 1_000_000}),
        ("edinet", "window", {"page": 0, "licence": "pdl-1.0", "most": 1_000_000}),
        ("dailymed", "offset", {"page": 100, "per_second": 2.0, "licence": "public-domain", "most": 1_000_000}),
        ("eric", "offset", {"page": 200, "per_second": 2.0, "most": 1_000_000}),
        ("hkex", "window", {"accept_terms": True, "most": 10_000}),
        ("courtlistener", "cursor", {"licence": "us-court-record", "most": 1_000_000}),
        ("state_bills", "generated", {"per_second": 1.5, "licence": "government-public-record", "most": 2_500}),
        ("idl", "offset", {"page": 200, "licence": "ucsf-idl", "most": 1_000_000}),
        ("magazine_archives", "seeds", {"per_second": 2.0, "most": 400}),
        ("exa", "single", {"page": 100, "per_second": 2.0, "licence": "third-party-web-content"}),
        ("firecrawl", "single", {"page": 100, "per_second": 2.0, "licence": "third-party-web-content"}),
        ("serpapi", "offset", {"page": 10, "most": 100, "per_second": 2.0, "licence": "third-party-web-content"}),
        ("un_digital_library", "cursor", {"per_second": 0.2, "most": 1_000_000, "xml": "record"}),
    ]
)
