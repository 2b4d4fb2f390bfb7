"""Interfaces of external models, with deterministic local stand-ins. A worker makes its model once a partition."""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Protocol

from docloom.errors import ModelCallError


class Embedder(Protocol):
    dimensions: int

    def embed(self, texts: Sequence[str]) -> list[list[float] | None]: ...


class Chat(Protocol):
    def answer(self, prompts: Sequence[str]) -> list[str | None]: ...


@dataclass
class HashingEmbedder:
    """Signed hashing of words into a unit vector."""

    dimensions: int = 64
    most_dimensions: int = 4096

    def __post_init__(self) -> None:
        if self.dimensions > self.most_dimensions:
            raise ValueError(f"the model has {self.most_dimensions} dimensions at most")

    def embed(self, texts: Sequence[str]) -> list[list[float] | None]:
        out = []
        for text in texts:
            vector = [0.0] * self.dimensions
            for word in re.findall(r"\w+", text.lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                vector[h % self.dimensions] += 1.0 if h >> 63 else -1.0
            norm = math.sqrt(sum(x * x for x in vector))
            out.append([x / norm for x in vector] if norm else vector)
        return out


@dataclass
class TemplateChat:
    """Answers made by a function of the prompt."""

    reply: Callable[[str], str | None] = lambda prompt: json.dumps({"items": [{"question": "", "answer": prompt}]})

    def answer(self, prompts: Sequence[str]) -> list[str | None]:
        return [self.reply(p) for p in prompts]


@dataclass
class Throttle:
    """Spaces calls so that a partition keeps to its share of a quota; a refused call waits and is tried again."""

    requests_per_minute: float = math.inf
    tokens_per_minute: float = math.inf
    attempts: int = 5
    cool_down: float = 60.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    free_at: float = 0.0

    def call(self, make: Callable[[], object], tokens: int = 0) -> object | None:
        """None after the last failed attempt."""
        for _ in range(self.attempts):
            wait = self.free_at - self.clock()
            if wait > 0:
                self.sleep(wait)
            self.free_at = max(self.free_at, self.clock()) + 60 * max(1 / self.requests_per_minute, tokens / self.tokens_per_minute)
            try:
                return make()
            except ModelCallError:
                self.free_at = self.clock() + self.cool_down
        return None


    @property
    def bounded(self) -> bool:
        return not (math.isinf(self.requests_per_minute) and math.isinf(self.tokens_per_minute))

    def lease(self, part: int, of: int) -> Throttle:
        """One of ``of`` equal parts of the quota; the first calls of the parts are as far apart as calls of the whole may be."""
        first = self.clock() + part * 60 / self.requests_per_minute
        return replace(self, requests_per_minute=self.requests_per_minute / of, tokens_per_minute=self.tokens_per_minute / of, free_at=max(self.free_at, first))


@dataclass
class Deployed:
    """A maker of models with the quota of their deployment, which all calls of one table share."""

    make: Callable[[], object]
    throttle: Throttle

    def __call__(self) -> object:
        return self.make()


_SLOT = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def render(template: str, values: dict[str, object]) -> str:
    return _SLOT.sub(lambda m: "" if values.get(m[1]) is None else str(values[m[1]]), template)


#: Variables of each prompt and the columns (or else literals) that fill them.
PROMPTS = {
    "description": {"language": "chunk_language", "article_title": "title", "article": "translated_chunk"},
    "keywords": {"language": "chunk_language", "article_title": "title", "article": "translated_chunk"},
    "questions": {"language": "chunk_language", "article_title": "title", "article": "translated_chunk"},
    "semantic_chunk": {"title": "title", "article": "content", "output_language": "metadata_language"},
    "merge_questions": {"qnas": "qnas"},
    "qna_validation": {"question": "question", "answer": "answer", "document": "content", "id": "question_id"},
    "translation": {"target_language": "target_language", "source_language": "source_language", "text": "text"},
}

TEMPLATES = {
    "description": "Describe in {{ language }}, in two sentences, what this article is about.\n# {{ article_title }}\n{{ article }}",
    "keywords": "List in {{ language }} up to ten keywords of this article, separated by commas.\n# {{ article_title }}\n{{ article }}",
    "questions": "Write in {{ language }} the questions that this article answers, one a line.\n# {{ article_title }}\n{{ article }}",
    "semantic_chunk": "Turn the article into questions and answers in {{ output_language }}, as JSON: {\"items\": [{\"question\": ..., \"answer\": ...}]}.\n# {{ title }}\n{{ article }}",
    "merge_questions": "Join questions and answers that say the same, as JSON: {\"items\": [{\"question\": ..., \"answer\": ..., \"source_ids\": [...], \"sufficient_ids\": [...]}]}.\n{{ qnas }}",
    "qna_validation": "Rate the answer against the document as intrinsic, extrinsic or consistent, as JSON: {\"question_id\": \"{{ id }}\", \"rating\": ...}.\nQuestion: {{ question }}\nAnswer: {{ answer }}\n{{ document }}",
    "translation": "Translate from {{ source_language }} into {{ target_language }}.\n{{ text }}",
}
