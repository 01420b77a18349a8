"""Identities made of contents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_key(prefix: str, *parts: Column) -> Column:
    """prefix:<16 hex digits of SHA-1> over the parts joined by bars; missing parts are empty, not left out."""
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])), 1, 16))


def content_digest(content: Column, digits: int = 12) -> Column:
    return F.substring(F.sha2(content, 256), 1, digits)


def is_ole(content: Column) -> Column:
    """Whether binary content starts like an old (OLE) workbook, not like a zipped one."""
    return F.substring(content, 1, 4) == F.unhex(F.lit("D0CF11E0"))
