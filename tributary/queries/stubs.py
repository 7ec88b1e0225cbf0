"""Deterministic stand-ins for services and models that queries and tests inject."""

from __future__ import annotations

from collections.abc import Iterator

TOTAL = 950


def pages_of_numbers(url: str, page: int = 1, page_size: int = 100, since: str | None = None) -> dict:
    """A paged service of the numbers below 950; with ``since`` what is greater, in one reply."""
    if since:
        return {"items": [{"n": i} for i in range(int(since) + 1, TOTAL)]}
    size = page_size
    lo = (page - 1) * size
    return {"data": [{"n": i} for i in range(lo, min(TOTAL, lo + size))], "next": lo + size < TOTAL}


def find_numbers(url: str, database: str, collection: str, since: str | None) -> Iterator[dict]:
    for i in range(int(since) + 1 if since else 0, 40):
        yield {"_id": i, "n": i}


def sizes(texts: list[str]) -> list[dict]:
    return [{"size": len(t)} for t in texts]
