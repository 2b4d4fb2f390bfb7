"""Text splitters with a size bound."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

SEPARATORS = ("\n\n", "\n", " ", "")


def _with_overlap(parts: list[str], size: int, overlap: int, length: Callable[[str], int], joint: str) -> list[str]:
    """Windows over parts: as many as fit, the next window starting with the last ones that fit into the overlap."""
    out, window = [], []
    for part in parts:
        if window and length(joint.join([*window, part])) > size:
            out.append(joint.join(window))
            while window and (length(joint.join(window)) > overlap or length(joint.join([*window, part])) > size):
                window.pop(0)
        window.append(part)
    return [*out, joint.join(window)] if window else out


def recursive_split(text: str, size: int = 2000, overlap: int = 200, separators: Sequence[str] = SEPARATORS, length: Callable[[str], int] = len) -> list[str]:
    """Chunks of at most ``size`` cut at the first separator that occurs; longer parts are cut at the next ones."""
    if not text.strip():
        return []
    if length(text) <= size:
        return [text.strip()]
    at = next((i for i, s in enumerate(separators) if s and s in text), None)
    if at is None:
        if length is len:
            step = max(1, size - overlap)
            return [text[i : i + size] for i in range(0, max(1, len(text) - overlap), step)]
        return _with_overlap(list(text), size, overlap, length, "")
    separator, rest = separators[at], separators[at + 1 :]
    out: list[str] = []
    held: list[str] = []
    for part in text.split(separator):
        if length(part) <= size:
            held.append(part)
            continue
        out += _with_overlap(held, size, overlap, length, separator)
        held = []
        out += recursive_split(part, size, overlap, rest, length)
    out += _with_overlap(held, size, overlap, length, separator)
    return [c.strip() for c in out if c.strip()]


_SENTENCE = re.compile(r"(?<=[.!?…。！？])([\"')\]]*)\s+|\n{2,}")


def sentences(text: str) -> list[str]:
    """Sentences with the quotes and brackets that close them."""
    out, start = [], 0
    for end in _SENTENCE.finditer(text):
        out.append(text[start : end.start() if end[1] is None else end.end(1)])
        start = end.end()
    return [s.strip() for s in (*out, text[start:]) if s.strip()]


def sentence_split(text: str, size: int = 1000, overlap: int = 200, length: Callable[[str], int] = len) -> list[str]:
    """Chunks of whole sentences (ended by a mark and white space, or a blank line)."""
    return pack_sentences(sentences(text), size, overlap, length)


def pack_sentences(found: Sequence[str], size: int, overlap: int = 0, length: Callable[[str], int] = len) -> list[str]:
    """As many sentences a chunk as fit; a longer sentence is cut at spaces."""
    parts = [p for s in found for p in ([s] if length(s) <= size else recursive_split(s, size, 0, (" ", ""), length))]
    return _with_overlap(parts, size, overlap, length, " ")


@dataclass(frozen=True)
class Strategy:
    name: str = "default"
    text_splitter: str = "recursive"
    chunk_size: int = 2000
    chunk_overlap: int = 200
    separators: tuple[str, ...] = field(default=("PARAGRAPH DELIMITER", *SEPARATORS))
    paragraph_delimiter: str | None = "PARAGRAPH DELIMITER"


#: The shipped strategies.
STRATEGIES = {
    "default": Strategy(),
    "NLTK": Strategy("NLTK", "nltk", 1000, 200, SEPARATORS, None),
    "spaCy": Strategy("spaCy", "spacy", 1000, 200, SEPARATORS, None),
}


def strategy(name: str, more: dict[str, Strategy] | None = None) -> Strategy:
    """Unknown names mean the default."""
    known = STRATEGIES | (more or {})
    return known.get(name, known["default"])


def splitter(plan: Strategy, length: Callable[[str], int] = len) -> Callable[[str], list[str]]:
    kind = plan.text_splitter.lower()
    if kind == "recursive":
        return lambda text: recursive_split(text, plan.chunk_size, plan.chunk_overlap, plan.separators, length)
    if kind in ("nltk", "spacy"):
        return lambda text: sentence_split(text, plan.chunk_size, plan.chunk_overlap, length)
    if kind == "html":
        from docloom.functions.html import split_html

        return lambda text: split_html(text, plan.chunk_size, plan.chunk_overlap, length)
    raise ValueError(f"unknown text splitter: {plan.text_splitter}")
