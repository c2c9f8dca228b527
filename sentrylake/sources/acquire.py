"""Pulling feeds over HTTP into landing folders. Runs on the driver; how to fetch and to wait can be replaced."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from itertools import count
from pathlib import Path
from urllib.parse import urlencode
from urllib.request import Request, urlopen

#: Fixed values of the service: address, longest window, page size, seconds between requests without and with a key.
CVE_SERVICE = "https://services.nvd.nist.gov/rest/json/cves/2.0"
KEV_SERVICE = "https://www.cisa.gov/sites/default/files/feeds/known_exploited_vulnerabilities.json"
LONGEST_WINDOW, PAGE_SIZE, PAUSE, PAUSE_WITH_KEY = timedelta(days=120), 2000, 6.5, 0.7

Fetch = Callable[[str, str | None], dict]


def get_json(url: str, api_key: str | None = None, timeout: float = 90) -> dict:
    headers = {"User-Agent": "sentrylake"} | ({"apiKey": api_key} if api_key else {})
    with urlopen(Request(url, headers=headers), timeout=timeout) as response:
        return json.load(response)


def service_time(moment: datetime) -> str:
    """UTC, with milliseconds always zero."""
    moment = moment.astimezone(UTC) if moment.tzinfo else moment
    return f"{moment:%Y-%m-%dT%H:%M:%S}.000"


def windows(start: datetime, end: datetime, longest: timedelta = LONGEST_WINDOW) -> Iterator[tuple[datetime, datetime]]:
    """Consecutive windows from start to end, none too long for the service."""
    if start >= end:
        raise ValueError(f"end must be after start: {start} to {end}")
    pieces = -(-(end - start) // longest)
    for k in range(pieces):
        yield start + k * longest, min(start + (k + 1) * longest, end)


def page_url(start: datetime, end: datetime, index: int, size: int = PAGE_SIZE, service: str = CVE_SERVICE) -> str:
    return f"{service}?" + urlencode({"lastModStartDate": service_time(start), "lastModEndDate": service_time(end), "resultsPerPage": size, "startIndex": index})


def persistently(url: str, fetch: Fetch = get_json, api_key: str | None = None, retries: int = 4, first_wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Fetches, and on transport or decoding errors waits twice as long each time before the next of ``retries`` attempts."""
    for wait in [first_wait * 2**k for k in range(retries)]:
        try:
            return fetch(url, api_key)
        except (OSError, json.JSONDecodeError):  # URLError and timeouts are OSErrors
            sleep(wait)
    return fetch(url, api_key)


@dataclass
class Fetched:
    files: list[str] = field(default_factory=list)
    records: int = 0
    total_results: int = 0
    requests: int = 0

    @property
    def pages(self) -> int:
        return len(self.files)


def pages(first: datetime, last: datetime, ask: Callable[[str], dict], pause: Callable[[], None], size: int = PAGE_SIZE) -> Iterator[dict]:
    """The service's answers for one window, page by page, up to and with the first that is empty or reaches the announced total."""
    for k in count():
        if k:
            pause()
        page = ask(page_url(first, last, k * size, size))
        yield page
        if not page.get("vulnerabilities") or (k + 1) * size >= int(page.get("totalResults", 0)):
            return


def fetch_pages(start: datetime, end: datetime, folder: str | Path, api_key: str | None = None, fetch: Fetch = get_json, sleep: Callable[[float], None] = time.sleep, size: int = PAGE_SIZE) -> Fetched:
    """Writes every page of the window that holds records as page_<n>.json, numbered over all windows."""
    target, out = Path(folder), Fetched()
    target.mkdir(parents=True, exist_ok=True)
    wait = PAUSE_WITH_KEY if api_key else PAUSE
    for window in windows(start, end):
        answers = pages(*window, lambda url: persistently(url, fetch, api_key, sleep=sleep), lambda: sleep(wait), size)
        for k, page in enumerate(answers):
            out.requests += 1
            out.total_results += 0 if k else int(page.get("totalResults", 0))
            if held := page.get("vulnerabilities"):
                path = target / f"page_{out.pages:05d}.json"
                path.write_text(json.dumps(page), encoding="utf-8")
                out.files.append(str(path))
                out.records += len(held)
    return out


def fetch_catalog(folder: str | Path, fetch: Fetch = get_json, sleep: Callable[[float], None] = time.sleep) -> tuple[str, dict]:
    """Writes the catalog as catalog.json; returns its path and its header fields."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    catalog = persistently(KEV_SERVICE, fetch, sleep=sleep)
    path = target / "catalog.json"
    path.write_text(json.dumps(catalog), encoding="utf-8")
    return str(path), {"catalog_version": catalog.get("catalogVersion"), "records": len(catalog.get("vulnerabilities") or [])}
