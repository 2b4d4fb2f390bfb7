"""Token counts behind a replaceable counter, and greedy batches of bounded tokens."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

_TOKEN = re.compile(r"\w+|[^\w\s]")


def count_tokens(text: str | None) -> int:
    """Words and marks; a stand-in for a model's own encoding."""
    return len(_TOKEN.findall(text)) if text else 0


def count_message_tokens(messages: Iterable[dict[str, str]], counter: Callable[[str | None], int] = count_tokens) -> int:
    """Four for each message, one less if it is named, and two for the answer's start."""
    return 2 + sum(4 - ("name" in m) + sum(counter(v) for v in m.values()) for m in messages)


def token_batches(texts: Sequence[str], limit: int, counter: Callable[[str | None], int] = count_tokens) -> Iterator[list[str]]:
    """Greedy runs whose tokens stay within the limit; a text is always placed, alone if need be."""
    held: list[str] = []
    total = 0
    for text in texts:
        n = counter(text)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(text)
        total += n
    if held:
        yield held
