"""Landing of files from the network: the one step that runs on the driver, before any table.

Requests are spaced, tried again with growing pauses, and refused if what comes is a challenge
page; a file is written whole or not at all, and one that is there is not fetched again.
"""

from __future__ import annotations

import hashlib
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path

from bondloom.sources.html import CHALLENGE, SNIFFED

# Seconds between requests and to wait for one, tries, first pause.
SPACING, TIMEOUT, TRIES, PAUSE = 1.5, 60, 4, 2

Answer = tuple[int, bytes]


def open_url(url: str) -> Answer:
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:  # noqa: S310 - the caller's own source
            return answer.status, answer.read()
    except urllib.error.HTTPError as error:
        return error.code, b""


class Fetcher:
    """Polite requests. ``opener``, ``clock`` and ``sleep`` may be replaced."""

    def __init__(self, opener: Callable[[str], Answer] = open_url, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.opener, self.clock, self.sleep = opener, clock, sleep
        self.last: float | None = None

    def get(self, url: str) -> bytes:
        """The content of ``url``; RuntimeError if no try brings any."""
        reason = ""
        for attempt in range(TRIES):
            if attempt:
                self.sleep(PAUSE * 2 ** (attempt - 1))
            if self.last is not None:
                self.sleep(max(0.0, SPACING - (self.clock() - self.last)))
            self.last = self.clock()
            try:
                status, content = self.opener(url)
            except OSError as error:
                reason = str(error)
                continue
            short = len(content) <= SNIFFED
            if status >= 300:
                reason = f"status {status}"
            elif short and any(mark.encode() in content for mark in CHALLENGE):
                reason = "a challenge page instead of the content"
            else:
                return content
        raise RuntimeError(f"{url}: {reason} after {TRIES} tries")

    def land(self, url: str, path: str | os.PathLike) -> str | None:
        """Writes the file if it is not there; its SHA-256, or None if it was."""
        target = Path(path)
        if target.exists():
            return None
        content = self.get(url)
        target.parent.mkdir(parents=True, exist_ok=True)
        part = target.with_name(f"{target.name}.part")
        part.write_bytes(content)
        part.replace(target)
        return hashlib.sha256(content).hexdigest()


def previewed(files):  # noqa: ANN001, ANN201
    """(path, length, format, head) of landed files as ``binaryFile`` gives them, by first bytes."""
    from pyspark.sql import functions as F

    marks = {"504B0304": "zipped workbook or archive", "D0CF11E0": "legacy workbook", "25504446": "portable document"}
    first = F.hex(F.substring("content", 1, 4))
    text = F.lower(F.decode(F.substring("content", 1, 256), "ISO-8859-1"))
    kind = F.coalesce(*[F.when(first == mark, name) for mark, name in marks.items()], F.when(text.contains("<html") | text.contains("<!doctype"), "page"), F.lit("other"))
    return files.select("path", "length", kind.alias("format"), F.substring(text, 1, 80).alias("head"))
