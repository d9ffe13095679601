"""Documents fetched over HTTP as a Spark data source: anonymous, throttled, with retries and same-host redirects.

The transport is injected (``transport``: "module:function", a picklable name), so that everything but the socket can be
tested offline. Reading runs in one partition, as the pause between any two requests has to hold for the whole crawl.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vellumry.sources.files import backoff

# Seconds between requests, redirects followed, tries when told to wait and when the server or the network fails.
PAUSE, MOST_HOPS, TRIES_BUSY, TRIES_FAILED = 0.7, 5, 6, 4


@dataclass
class Reply:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


Transport = Callable[[str], Reply]


def urllib_transport(url: str) -> Reply:
    """One GET without cookies and without following redirects."""
    import urllib.error
    import urllib.request

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *_):
            return None

    try:
        with urllib.request.build_opener(Stay).open(url, timeout=60) as r:
            return Reply(r.status, r.read(), {k.lower(): v for k, v in r.headers.items()})
    except urllib.error.HTTPError as e:
        return Reply(e.code, e.read(), {k.lower(): v for k, v in e.headers.items()})


def retry_after(hint: str | None, now: float) -> float | None:
    """Seconds that a Retry-After header asks for: a number, or a date less now; None if it is neither."""
    if hint and hint.strip().replace(".", "", 1).isdigit():
        return float(hint)
    try:
        return max(0.0, parsedate_to_datetime(hint).timestamp() - now) if hint else None
    except ValueError:
        return None


@dataclass
class Client:
    """transport, and what makes time: both injectable."""

    transport: Transport = urllib_transport
    sleep: Callable[[float], None] = time.sleep
    now: Callable[[], float] = time.monotonic
    last: float | None = None
    wall: Callable[[], float] = time.time

    def once(self, url: str) -> Reply:
        """One request, PAUSE seconds after the one before at the earliest."""
        if self.last is not None and (wait := self.last + PAUSE - self.now()) > 0:
            self.sleep(wait)
        try:
            return self.transport(url)
        finally:
            self.last = self.now()

    def follow(self, url: str) -> Reply:
        """The reply behind redirects on the same host; a redirect elsewhere is the reply itself."""
        for _ in range(MOST_HOPS + 1):
            r = self.once(url)
            to = urljoin(url, r.headers.get("location", "")) if r.status in (301, 302, 303, 307, 308) else ""
            if not to or urlsplit(to).hostname != urlsplit(url).hostname or urlsplit(to).scheme not in ("http", "https"):
                return r
            url = to
        return Reply(310, b"", {})

    def fetch(self, url: str) -> tuple[Reply | None, str | None]:
        """(reply, error): tried again while the server asks to wait (429), fails (5xx), or the network does."""
        tries = 0
        while True:
            tries += 1
            try:
                r, error = self.follow(url), None
            except OSError as e:
                r, error = None, type(e).__name__
            busy = r is not None and r.status == 429
            if not busy and r is not None and r.status < 500:
                return r, None
            if tries >= (TRIES_BUSY if busy else TRIES_FAILED):
                return r, error
            self.sleep(backoff(tries, retry_after(r.headers.get("retry-after"), self.wall()) if r is not None else None))


class HttpSource(DataSource):
    """spark.read.format("vellumry_http").option("urls", "\\n"-separated).load() -> (url, status, content_type, content, error)."""

    @classmethod
    def name(cls) -> str:
        return "vellumry_http"

    def schema(self) -> str:
        return "url string, status int, content_type string, content binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.transport = options.get("transport")
        self.pause = options.get("sleep", "true") != "false"

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        transport: Transport = urllib_transport
        if self.transport:
            module, name = self.transport.split(":")
            transport = getattr(importlib.import_module(module), name)
        c = Client(transport, time.sleep if self.pause else lambda _: None)
        for url in self.urls:
            r, error = c.fetch(url)
            yield (url, r.status if r else None, r.headers.get("content-type") if r else None, r.body if r else None, error)
