"""Requests under every connector: retries, a gap per host, a size cap, and recorded answers in place of the network."""

from __future__ import annotations

import hashlib
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
from pathlib import Path

# Answers worth another try, and the longest wait between tries in seconds.
RETRY = {406, 408, 425, 429, 500, 502, 503, 504}
LONGEST_WAIT = 30.0


class TransientError(Exception):
    """Another try later may succeed."""


class PermanentError(Exception):
    """Trying again is of no use."""


class Transport:
    """Gets URLs, either from a folder of recorded answers (``recorded``: a file named by the SHA-1 of the URL) or over the network.

    Over the network a User-Agent must be given. The gap between two requests to a host holds within one task, so rows must be
    partitioned by host (see :func:`leafmill.sources.fetch.fetch`): then more executors never raise the rate at a host.
    """

    def __init__(self, recorded: str | None = None, user_agent: str | None = None, per_second: float = 1.0, tries: int = 4, most: int = 128 << 20, robots: bool = True):
        if not recorded and not user_agent:
            raise ValueError("a user_agent is needed for the network")
        self.recorded, self.user_agent, self.gap, self.tries, self.most, self.robots = recorded, user_agent, 1 / per_second, tries, most, robots
        self.next: dict[str, float] = {}
        self.rules: dict[str, urllib.robotparser.RobotFileParser | None] = {}

    @staticmethod
    def name(url: str) -> str:
        return hashlib.sha1(url.encode()).hexdigest()

    def get(self, url: str) -> bytes:
        if self.recorded:
            path = Path(self.recorded, self.name(url))
            if not path.exists():
                raise PermanentError(f"not recorded: {url}")
            return self._capped(path.read_bytes(), url)
        parts = urllib.parse.urlsplit(url)
        if parts.scheme not in ("http", "https") or not parts.hostname:
            raise PermanentError(f"no web address: {url}")
        if self.robots and not self._allowed(parts, url):
            raise PermanentError(f"robots.txt forbids {url}")
        for k in range(self.tries):
            self._wait(parts.hostname)
            try:
                request = urllib.request.Request(url, headers={"User-Agent": self.user_agent})
                with urllib.request.urlopen(request, timeout=60) as answer:
                    return self._capped(answer.read(self.most + 1), url)
            except urllib.error.HTTPError as e:
                if e.code not in RETRY:
                    raise PermanentError(f"{e.code} {url}") from e
            except OSError:
                pass
            time.sleep(random.uniform(0, min(LONGEST_WAIT, 2 * 2**k)))
        raise TransientError(url)

    def pdf(self, url: str) -> bytes:
        body = self.get(url)
        if not is_pdf(body):
            raise PermanentError(f"no PDF: {url}")
        return body

    def _capped(self, body: bytes, url: str) -> bytes:
        if len(body) > self.most:
            raise PermanentError(f"more than {self.most} bytes: {url}")
        return body

    def _wait(self, host: str) -> None:
        now = time.monotonic()
        at = max(now, self.next.get(host, 0.0))
        self.next[host] = at + self.gap
        time.sleep(at - now)

    def _allowed(self, parts, url: str) -> bool:
        if parts.netloc not in self.rules:
            rules = urllib.robotparser.RobotFileParser(f"{parts.scheme}://{parts.netloc}/robots.txt")
            try:
                rules.read()
            except OSError:
                rules = None  # unreachable rules forbid nothing
            self.rules[parts.netloc] = rules
        own = self.rules[parts.netloc]
        return own is None or own.can_fetch(self.user_agent, url)


def is_pdf(body: bytes) -> bool:
    return body[:1024].lstrip().startswith(b"%PDF-")
