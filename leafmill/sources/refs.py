"""Discovery records as a Spark data source: spark.read.format("leafmill_refs").option("connector", ...).load().

One reader per shape of paging; the connectors differ in configuration. A partition is one slice of the source (an archive, a range of
offsets, a window of dates, a sitemap file); what a reader doesn't do (dedupe, caps, quotas, turns) are DataFrame operators.

Options: connector; url (a template with {offset}, {cursor}, {start}, {end}; windows may have {offset} too); recorded (folder of recorded answers) or user_agent; total (known
number of records), start, end (dates), step (year, month or day), seeds (file), archives (glob), keys (values by comma per {name} of the
template; without them {number} runs from 1 to the connector's most), limit (rows per partition; all, if it isn't given), page (records
of a full answer within a window, if the URL asks for another number than the connector's; 0: an answer is whole), query, accept_terms.
"""

from __future__ import annotations

import glob
import io
import itertools
import json
import math
import re
import urllib.parse
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .connectors import CONNECTORS, Connector
from .transport import Transport, is_pdf

SCHEMA = "source string, source_id string, url string, license string, discovery_query string, extra string"


class Slice(InputPartition):
    def __init__(self, **values):
        super().__init__(json.dumps(values))

    @property
    def values(self) -> dict:
        return json.loads(self.value)


def at(record, path: str):
    """The value at a dotted path; of a list the first."""
    for step in path.split("."):
        if isinstance(record, list):
            record = record[0] if record else None
        record = record.get(step) if isinstance(record, dict) else None
    return record[0] if isinstance(record, list) and record else record


def from_xml(body: bytes, tag: str) -> list[dict]:
    """Elements of a name, whatever their namespace, as dicts of their children's texts and attributes."""
    bare = lambda t: t.rpartition("}")[2]
    out = []
    for e in ET.fromstring(body).iter():
        if bare(e.tag) == tag:
            record: dict = {}
            for child in e.iter():
                if child is not e:
                    record.setdefault(bare(child.tag), (child.text or "").strip() or child.attrib.get("href"))
            out.append(record)
    return out


def windows(start: date, end: date, step: str) -> Iterator[tuple[date, date]]:
    """Windows [low, high], newest first, cut to the range."""
    edges = [start]
    while edges[-1] <= end:
        d = edges[-1]
        edges.append(date(d.year + 1, 1, 1) if step == "year" else date(d.year + d.month // 12, d.month % 12 + 1, 1) if step == "month" else d + timedelta(1))
    for low, high in reversed(list(itertools.pairwise(edges))):
        yield low, min(high - timedelta(1), end)


class RefsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = dict(options)
        if self.o.get("connector") not in CONNECTORS:
            raise ValueError(f"connector must be one of {sorted(CONNECTORS)}")
        self.c: Connector = CONNECTORS[self.o["connector"]]
        if self.c.accept_terms and self.o.get("accept_terms", "").lower() != "true":
            raise ValueError(f"{self.c.name} asks for its terms to be accepted: option accept_terms")
        self.limit = int(self.o["limit"]) if self.o.get("limit") else None
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit can't be negative")
        self.page = int(self.o.get("page") or self.c.page)
        if self.page < 0:
            raise ValueError("page can't be negative")

    def partitions(self) -> list[InputPartition]:
        o, c = self.o, self.c
        if c.shape == "archive":
            return [Slice(path=p) for p in sorted(glob.glob(o["archives"]))]
        if c.shape == "offset" and o.get("total"):
            return [Slice(offset=k) for k in range(0, min(int(o["total"]), c.most), c.page)]
        if c.shape == "window":
            return [Slice(start=str(a), end=str(b)) for a, b in windows(date.fromisoformat(o["start"]), date.fromisoformat(o["end"]), o.get("step", "year"))]
        if c.shape == "sitemap":
            return [Slice(url=u) for u in o["url"].split(",")]
        if c.shape == "seeds":
            with open(o["seeds"], encoding="utf-8") as f:
                return [Slice(line=x.strip()) for x in f if x.strip() and not x.startswith("#")]
        return [Slice()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        records = getattr(self, f"_{self.c.shape}")(partition.values)
        yield from itertools.islice(records, self.limit)

    def _transport(self) -> Transport:
        return Transport(self.o.get("recorded"), self.o.get("user_agent"), self.c.per_second)

    def _row(self, record: dict, **more) -> tuple:
        f = self.c.fields
        url = at(record, f["url"])
        key = at(record, f["source_id"])
        return (self.c.name, str(key if key is not None else url), url, at(record, f["license"]) or self.c.licence, self.o.get("query"), json.dumps(record | more, sort_keys=True, ensure_ascii=False, default=str))

    def _records(self, body: bytes) -> tuple[list[dict], dict]:
        if self.c.xml:
            token = re.search(rb"<(?:\w+:)?resumptionToken[^>]*>([^<]*)<", body)
            return from_xml(body, self.c.xml), {"next": token[1].decode() if token and token[1] else None}
        answer = json.loads(body)
        if isinstance(answer, list):
            return answer, {}
        found = answer.get(self.c.items)
        if found is None:
            raise ValueError(f"an answer of {self.c.name} has no {self.c.items}")  # no answer isn't an empty answer
        return found, answer

    def _archive(self, s: dict) -> Iterator[tuple]:
        with zipfile.ZipFile(s["path"]) as z:
            for m in z.infolist():
                if m.filename.lower().endswith(".pdf") and 5 <= m.file_size <= 64 << 20:
                    with z.open(m) as f:
                        if is_pdf(f.read(1024)):
                            stem = m.filename.rpartition("/")[2][:-4]
                            yield (self.c.name, stem, f"zip:{s['path']}!{m.filename}", self.c.licence, self.o.get("query"), json.dumps({"n_bytes": m.file_size}))

    def _offset(self, s: dict) -> Iterator[tuple]:
        transport, offset = self._transport(), s.get("offset", 0)
        while offset < self.c.most:
            found, _ = self._records(transport.get(self.o["url"].format(offset=offset)))
            yield from map(self._row, found)
            offset += self.c.page
            if "offset" in s or len(found) < self.c.page:
                return

    def _cursor(self, s: dict) -> Iterator[tuple]:
        transport, cursor, seen = self._transport(), self.o.get("cursor", ""), set()
        while cursor not in seen:
            seen.add(cursor)
            found, answer = self._records(transport.get(self.o["url"].format(cursor=urllib.parse.quote(cursor))))
            yield from map(self._row, found)
            cursor = answer.get("next")
            if not cursor:
                return

    def _window(self, s: dict) -> Iterator[tuple]:
        """A window's pages by offset, if the URL has one, to its total or (without total) to a page that isn't full. A window that can't be
        had whole, as it holds more than the source's most or than one answer without offset, is halved; if it is a single day, that is an
        error."""
        transport, url = self._transport(), self.o["url"]
        get = lambda low, high, offset: self._records(transport.get(url.format(start=low, end=high, offset=offset)))
        todo = [(date.fromisoformat(s["start"]), date.fromisoformat(s["end"]))]
        while todo:
            low, high = todo.pop()
            found, answer = get(low, high, 0)
            total = int(answer["total"]) if answer.get("total") is not None else None
            rows, enough = list(found), math.inf if self.limit is None else self.limit
            more = lambda: len(rows) < total if total is not None else 0 < self.page <= len(found)  # noqa: E731, B023
            while "{offset}" in url and found and more() and max(len(rows), total or 0) <= self.c.most and len(rows) < min(self.c.most, enough):
                found, _ = get(low, high, len(rows))
                rows += found
            if more() and len(rows) < enough:
                if low == high:
                    raise ValueError(f"{self.c.name}: {low} alone holds more records than can be had: {len(rows)} of {'an unknown number' if total is None else total}")
                middle = low + (high - low) // 2
                todo += [(low, middle), (middle + timedelta(1), high)]
                continue
            yield from (self._row(r, window=f"{low}/{high}") for r in rows)

    def _sitemap(self, s: dict) -> Iterator[tuple]:
        for e in from_xml(self._transport().get(s["url"]), "url"):
            if e.get("loc", "").lower().endswith(".pdf"):
                yield self._row({"id": e["loc"].rpartition("/")[2][:-4], "url": e["loc"], "modified": e.get("lastmod")})

    def _seeds(self, s: dict) -> Iterator[tuple]:
        """url | licence | label | follow=pattern | max=n"""
        url, licence, label, *rest = [*(x.strip() for x in s["line"].split("|")), "", ""][:5]
        more = dict(x.split("=", 1) for x in rest if "=" in x)
        transport, most = self._transport(), int(more.get("max", 1_000_000))
        link = re.compile(r"""(?i)href\s*=\s*["']([^"']+)""")
        pages, seen, given = [url], set(), 0
        for k, page in enumerate(pages):
            for x in link.findall(transport.get(page).decode("utf-8", "replace")):
                full = urllib.parse.urldefrag(urllib.parse.urljoin(page, x))[0]
                if full in seen:
                    continue
                seen.add(full)
                if urllib.parse.urlsplit(full).path.lower().endswith(".pdf"):
                    if given >= most:
                        return
                    given += 1
                    yield (self.c.name, full, full, licence or "publisher-site", self.o.get("query") or label, json.dumps({"page": page}))
                elif k == 0 and "follow" in more and re.search(more["follow"], full) and len(pages) <= self.c.most:
                    pages.append(full)

    def _generated(self, s: dict) -> Iterator[tuple]:
        names = re.findall(r"{(\w+)}", self.o["url"])
        given = lambda n: map(str, range(1, self.c.most + 1)) if n == "number" and n not in self.o else self.o[n].split(",")
        for values in itertools.product(*map(given, names)):
            yield self._row({"id": "-".join(values), "url": self.o["url"].format(**dict(zip(names, values)))})

    def _single(self, s: dict) -> Iterator[tuple]:
        found, _ = self._records(self._transport().get(self.o["url"]))
        yield from (self._row(r) for r in found if str(at(r, "url")).lower().split("?")[0].endswith(".pdf"))


class Refs(DataSource):
    """Discovery records of a connector."""

    @classmethod
    def name(cls) -> str:
        return "leafmill_refs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RefsReader(self.options)


def members(path: str, name: str) -> bytes:
    """A member of an archive, by the address that the archive shape gives."""
    with zipfile.ZipFile(path) as z:
        return io.BytesIO(z.read(name)).getvalue()
