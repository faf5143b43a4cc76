"""Spans of text as ``kind:start:end`` (code points, end exclusive), and their digests."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]
SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
