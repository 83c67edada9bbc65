"""Landing raw bytes: one polite session on the driver. Executors never download; they scan what has landed."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable
from typing import Protocol
from urllib.parse import urlsplit

from tidemark import specs
from tidemark.errors import FetchError

_AGAIN = frozenset({429, 500, 502, 503, 504})


class Fetcher(Protocol):
    def get(self, url: str) -> bytes: ...


def spacing(host: str) -> float:
    """Least seconds between two requests: the first suffix that fits the host."""
    return next((s for suffix, s in specs.HOST_SPACING if host == suffix or host.endswith("." + suffix)), specs.DEFAULT_SPACING)


def _open(url: str, agent: str, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, headers={"User-Agent": agent})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, response.read()
    except urllib.error.HTTPError as e:
        return e.code, b""


class PoliteSession:
    """Spaces requests per host; tries again, up to four times in all, on network errors and passing statuses."""

    def __init__(self, agent: str, attempts: int = 4, timeout: float = 60.0, opener: Callable = _open, clock: Callable = time.monotonic, sleep: Callable = time.sleep):
        self.agent, self.attempts, self.timeout = agent, attempts, timeout
        self.opener, self.clock, self.sleep, self.last = opener, clock, sleep, {}

    def _wait_turn(self, host: str) -> None:
        due = self.last.get(host, float("-inf")) + spacing(host)
        if (rest := due - self.clock()) > 0:
            self.sleep(rest)
        self.last[host] = self.clock()

    def get(self, url: str, ok: frozenset[int] = frozenset({200})) -> bytes:
        said = ""
        for attempt in range(self.attempts):
            self._wait_turn(urlsplit(url).hostname or "")
            try:
                status, body = self.opener(url, self.agent, self.timeout)
            except OSError as e:
                said = str(e)
            else:
                if status in ok:
                    return body
                if status == 404:
                    raise FetchError(f"{url}: not found", not_found=True)
                said = f"status {status}"
                if status not in _AGAIN:
                    break
            if attempt + 1 < self.attempts:
                self.sleep(min(2.0**attempt, 30.0))
        raise FetchError(f"{url}: {said}")
