"""Header cleaning: any header text to a unique snake_case name."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable


def snake_case(header: str) -> str:
    text = header.replace("'", "").replace('"', "").replace("﻿", "")
    text = text.replace("%", " percent ").replace("#", " number ")
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def clean_names(headers: Iterable[str]) -> list[str]:
    """Snake-case all headers; repeats get _2, _3, ..."""
    seen: dict[str, int] = {}
    taken: set[str] = set()
    result = []
    for header in headers:
        base = snake_case(header)
        seen[base] = seen.get(base, 0) + 1
        name = base if seen[base] == 1 else f"{base}_{seen[base]}"
        while name in taken:
            seen[base] += 1
            name = f"{base}_{seen[base]}"
        taken.add(name)
        result.append(name)
    return result
