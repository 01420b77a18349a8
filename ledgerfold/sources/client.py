"""A client for live sources: cache, pacing, retries with backoff, and a circuit breaker.  Driver side, standard library."""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlencode


class CircuitOpen(RuntimeError):
    """Too many calls in a row have failed; no more are made."""


def http_get(url: str) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "ledgerfold"}), timeout=60) as answer:
        return answer.read()


class Client:
    """get() answers from the cache first, even with an open circuit.  A call is up to `attempts` requests."""

    def __init__(self, source: str, transport: Callable[[str], bytes] = http_get, attempts: int = 3, backoff: float = 0.5, spacing: float = 0.6, cache: str | Path | None = None, threshold: int = 3, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.source, self.transport, self.attempts, self.backoff, self.spacing = source, transport, attempts, backoff, spacing
        self.cache, self.threshold, self.sleep, self.clock = Path(cache) if cache else None, threshold, sleep, clock
        self.failed_calls, self.requests, self.last_request = 0, 0, float("-inf")

    @property
    def is_open(self) -> bool:
        return self.failed_calls >= self.threshold

    def get(self, url: str) -> bytes:
        kept = self.cache / self.source / f"{hashlib.sha256(url.encode()).hexdigest()}.body" if self.cache else None
        if kept and kept.exists():
            return kept.read_bytes()
        if self.is_open:
            raise CircuitOpen(self.source)
        body = self._call(url)
        if kept:
            kept.parent.mkdir(parents=True, exist_ok=True)
            kept.write_bytes(body)
        return body

    def _call(self, url: str) -> bytes:
        error: Exception | None = None
        for attempt in range(self.attempts):
            if attempt == 0 and (wait := self.spacing - (self.clock() - self.last_request)) > 0:
                self.sleep(wait)
            self.last_request = self.clock()
            self.requests += 1
            try:
                body = self.transport(url)
            except Exception as e:  # any failure of a transport counts
                error = e
                self.sleep(self.backoff * 2**attempt)
            else:
                self.failed_calls = 0
                return body
        self.failed_calls += 1
        raise error if error else ValueError("attempts must be positive")


def paginate(client: Client, url: str, page_size: int = 1000, max_records: int = 5000) -> Iterator[dict]:
    """Records of skip/limit pages; ends with an empty page, a short one, or max_records."""
    for skip in range(0, max_records, page_size):
        page = json.loads(client.get(f"{url}{'&' if '?' in url else '?'}limit={page_size}&skip={skip}")).get("results") or []
        yield from page
        if len(page) < page_size:
            return


class Malformed(ValueError):
    """A key that can't be one.  The message never has the key itself."""


def checked_key(key: str | None) -> str:
    """A trimmed key of 32 lower-case letters or digits."""
    key = (key or "").strip()
    if not key:
        raise Malformed("no key is set")
    if not re.fullmatch(r"[a-z0-9]{32}", key):
        raise Malformed(f"the key is malformed: it has {len(key)} characters; 32 lower-case letters and digits are expected")
    return key


# Where the live sources are.
VINTAGES_URL = "https://api.stlouisfed.org/fred/series/observations"
SHORTAGES_URL = "https://api.fda.gov/drug/shortages.json?limit=1000"
RECALLS_URL = "https://api.fda.gov/drug/enforcement.json?limit=1000"
TARIFF_URL = "https://hts.usitc.gov/reststop/exportList"
SERIES_URL = "https://api.imf.org/external/sdmx/3.0/data/dataflow/IMF.STA/IMTS/+"
INDEX_URL = "https://www.newyorkfed.org/medialibrary/research/interactives/gscpi/downloads/gscpi_data.xlsx"


def fetch_vintages(client: Client, series: str, key: str | None, since: str = "2013-01-01") -> bytes:
    query = {"series_id": series, "api_key": checked_key(key), "file_type": "json", "output_type": 2, "realtime_start": since}
    return client.get(f"{VINTAGES_URL}?{urlencode(query)}")


def fetch_snapshot(client: Client, kind: str) -> bytes:
    return client.get({"shortages": SHORTAGES_URL, "recalls": RECALLS_URL}[kind])


def fetch_revision(client: Client, revision: str, form: str = "JSON") -> bytes:
    return client.get(f"{TARIFF_URL}?{urlencode({'from': '0100', 'to': '9999', 'format': form, 'styles': 'false', 'revision': revision})}")


def fetch_index(client: Client) -> bytes:
    return client.get(INDEX_URL)


def fetch_series(client: Client, key: str, last_n: int = 15) -> bytes:
    """One series of the bilateral reports; its dimensions are country, indicator, counterpart, frequency."""
    return client.get(f"{SERIES_URL}/{key}?{urlencode({'lastNObservations': last_n})}")
