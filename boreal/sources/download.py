"""Downloads on the driver: a manifest's few remote texts, with a cache, retries and a status for each."""

from __future__ import annotations

import errno
import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Sequence
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from boreal.sources.writers import atomic

SCHEMA = "source_id string, url string, path string, status string, characters bigint, sha256 string, attempts int, error string"
#: Answers and errors after which another attempt makes sense. Fixed values.
TRANSIENT_STATUS = (429, 500, 502, 503, 504)
TRANSIENT_ERRNO = (errno.ENETUNREACH, errno.ECONNRESET, errno.ETIMEDOUT)


def transient(error: BaseException) -> bool:
    if isinstance(error, urllib.error.HTTPError):
        return error.code in TRANSIENT_STATUS
    reason = getattr(error, "reason", error)
    return isinstance(reason, TimeoutError) or getattr(reason, "errno", None) in TRANSIENT_ERRNO


def _open(url: str, timeout: float) -> bytes:
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310 - schemes are checked by the caller
        return answer.read()


def fetch(spark: SparkSession, sources: Sequence[tuple[str, str]], folder: str, attempts: int = 3, wait: float = 1.0, timeout: float = 30.0, fresh: bool = False, opener: Callable[[str, float], bytes] = _open) -> DataFrame:
    """A row for each ``(source_id, url)``: downloaded, cached (the file is there already, unless ``fresh``) or failed,
    with the text's size and hash. Transient errors are tried again after a growing wait; other schemes than http,
    https and file fail, as do texts that are no UTF-8. Files are complete or not there."""
    rows = []
    for source, url in sources:
        target = Path(folder, f"{source}.txt")
        row = {"source_id": source, "url": url, "path": str(target), "attempts": 0, "error": None}
        try:
            if urlparse(url).scheme not in ("http", "https", "file"):
                raise ValueError(f"scheme of {url}")
            if target.exists() and not fresh:
                text, status = target.read_text(encoding="utf-8"), "cached"
            else:
                text, status = _try(url, attempts, wait, timeout, opener, row), "downloaded"
                atomic(text, str(target))
            row |= {"status": status, "characters": len(text), "sha256": hashlib.sha256(text.encode("utf-8")).hexdigest()}
        except (OSError, ValueError) as error:
            row |= {"status": "failed", "characters": None, "sha256": None, "error": f"{type(error).__name__}: {error}"}
        rows.append(tuple(row[c.split()[0]] for c in SCHEMA.split(", ")))
    return spark.createDataFrame(rows, SCHEMA)


def _try(url: str, attempts: int, wait: float, timeout: float, opener: Callable[[str, float], bytes], row: dict) -> str:
    for n in range(1, attempts + 1):
        row["attempts"] = n
        try:
            return opener(url, timeout).decode("utf-8")
        except OSError as error:
            if n == attempts or not transient(error):
                raise
            time.sleep(wait * n)
    raise ValueError("no attempt")


def local_manifest(status: DataFrame) -> DataFrame:
    """``source_id, path, source_type`` of what is there now: the sources of an ingestion."""
    there = status.where(status["status"].isin("downloaded", "cached"))
    return there.selectExpr("source_id", "path", "'local_text' as source_type")
