"""The plain forms that results are compared with."""

from __future__ import annotations

import re


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df, *cols) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
