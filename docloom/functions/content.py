"""A document's recursive content, flattened."""

from __future__ import annotations

import json
from typing import Any

from docloom.functions.html import html_to_text, is_html, strip_attributes


def _title(block: dict[str, Any], delimiter: str | None) -> str:
    return f"\n{delimiter or ''}# {block['title']}\n" if block.get("title") else ""


def _plain(block: Any) -> str:
    return block if isinstance(block, str) else "" if block is None else json.dumps(block, ensure_ascii=False)


def full_text(block: Any, delimiter: str | None = None) -> str:
    """Titles and items in order; HTML items as text, tables as lists of their columns and rows, other values as JSON."""
    if isinstance(block, str):
        return (html_to_text(block) or "") if is_html(block) else block
    if isinstance(block, list):
        return "\n".join(full_text(x, delimiter) for x in block)
    if not isinstance(block, dict):
        return _plain(block)
    if "rows" in block:
        return f"{_title(block, delimiter)}{block.get('columns') or []}\n{block['rows']}"
    return _title(block, delimiter) + full_text(block.get("data") or [], delimiter)


def raw_text(block: Any) -> str:
    if isinstance(block, list):
        return "\n".join(raw_text(x) for x in block)
    if not isinstance(block, dict):
        return _plain(block)
    return f"{block.get('columns') or []}\n{block['rows']}" if "rows" in block else raw_text(block.get("data") or [])


def texts_of(content: Any, delimiter: str | None = None) -> dict[str, str]:
    """The content with titles, as it was written, and with its markup as text."""
    content = content or []
    content = content if isinstance(content, list) else [content]
    raw = strip_attributes(raw_text(content)) or ""
    return {"content_full": full_text(content, delimiter), "content_raw": raw, "html_content": (html_to_text(raw) or "") if is_html(raw) else raw}
