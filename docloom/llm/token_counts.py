"""Token counts that follow edits.

A document's pre-tokens stand in the leaves of a segment tree whose nodes hold
the characters and tokens below them. An edit finds its leaves by the sums,
starts from the pre-token that a change there could reach (the pattern looks at
most one character past a match), and re-encodes until an old boundary behind
the edit comes up again: from there the same text splits the same way. Only the
sums above the touched leaves change.

Defined cases: a null text counts as empty; null edits are none; edits apply one
after the other, positions in code points of the text as it then is, and are cut
to its length; repeated rows are counted alike; other columns are not read but by
the edits; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.byte_bpe import in_batches, read_ranks

LEAF = 32
_REMEMBERED = 1_000_000
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


class Counter:
    """Pre-tokens and their numbers of tokens under a rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        self.split = regex.compile(pattern).findall
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        self.known: dict[str, int] = {}
        self.encoded_chars = 0

    def count(self, text: str) -> tuple[list[str], list[int]]:
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        words, known = self.split(text), self.known
        self.encoded_chars += len(text)
        for word in set(words).difference(known):
            known[word] = len(self.encoding.encode_ordinary(word))
        return words, [known[w] for w in words]


class TokenTree:
    """Leaves of up to LEAF pre-tokens; ``chars`` and ``tokens`` are sums in heap order, the root at 1."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self._build(*counter.count(text))

    def _build(self, words: list[str], counts: list[int]) -> None:
        self.leaves = [(words[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(words), LEAF)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        n = len(self.leaves)
        self.chars[self.size : self.size + n] = [sum(map(len, w)) for w, _ in self.leaves]
        self.tokens[self.size : self.size + n] = [sum(c) for _, c in self.leaves]
        level = self.size
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def text(self) -> str:
        return "".join(w for words, _ in self.leaves for w in words)

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf of a character and the characters before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position >= before + self.chars[node] and self.chars[node + 1]:
                before += int(self.chars[node])
                node += 1
        return node - self.size, before

    def _set_leaf(self, leaf: int, words: list[str], counts: list[int]) -> None:
        self.leaves[leaf] = (words, counts)
        node = leaf + self.size
        more = (sum(map(len, words)) - self.chars[node], sum(counts) - self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from start to end."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, before = self._leaf_at(max(start - 2, 0))
        # a leaf's first pre-token may be what the change reaches back from: pre-tokens before it end two characters earlier
        words, counts = self.leaves[first]
        kept, at = 0, before
        while kept < len(words) and at + len(words[kept]) < start - 1:
            at += len(words[kept])
            kept += 1
        last, _ = self._leaf_at(max(end - 1, 0))
        last = max(last, first)
        stop, extra = last, 1
        while True:
            stop = min(last + extra, len(self.leaves) - 1)
            tail = [w for i in range(first, stop + 1) for w in self.leaves[i][0]][kept:]
            tail_counts = [c for i in range(first, stop + 1) for c in self.leaves[i][1]][kept:]
            old = "".join(tail)
            region = old[: start - at] + new + old[end - at :]
            bounds = np.cumsum([len(w) for w in tail])
            shift = len(region) - len(old)
            changed = start - at + len(new)
            # try the shortest stretch first: up to an old boundary behind the edit and one pre-token more
            found = self._resplit(region, bounds + shift, changed, stop == len(self.leaves) - 1)
            if found:
                made, made_counts, sync = found
                break
            extra *= 4
        rest = int(np.searchsorted(bounds + shift, sync, side="right")) if len(bounds) else 0
        words, counts = words[:kept] + made + tail[rest:], counts[:kept] + made_counts + tail_counts[rest:]
        if len(words) > 8 * LEAF * (stop - first + 1):
            every = [x for i, x in enumerate(self.leaves) if i < first] + [(words, counts)] + self.leaves[stop + 1 :]
            self._build([w for ws, _ in every for w in ws], [c for _, cs in every for c in cs])
            return
        share = -(-len(words) // (stop - first + 1))
        for k, leaf in enumerate(range(first, stop + 1)):
            self._set_leaf(leaf, words[k * share : (k + 1) * share], counts[k * share : (k + 1) * share])

    def _resplit(self, region: str, bounds: np.ndarray, changed: int, whole: bool) -> tuple[list[str], list[int], int] | None:
        """Pre-tokens of the region up to an old boundary behind the edit that comes up again, and that boundary; None if none does."""
        behind = bounds[bounds >= changed]
        for reach in (2, 8, 32, len(behind)):
            limit = int(behind[min(reach, len(behind)) - 1]) if len(behind) else len(region)
            final = whole and limit == len(region)
            words, counts = self.counter.count(region[:limit])
            ends = np.cumsum([len(w) for w in words])
            # what touches the cut may split otherwise with the text behind it
            sure = ends if final else ends[ends < limit - 1]
            common = np.intersect1d(sure[sure >= changed], behind)
            if len(common):
                n = int(np.searchsorted(ends, common[0], side="right"))
                return words[:n], counts[:n], int(common[0])
            if final:
                return words, counts, len(region)
            if reach >= len(behind):
                break
        return None


_OPEN: dict[tuple[str, str], Counter] = {}


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = Counter(path, pattern)
    return _OPEN[path, pattern]


def edited_counts(docs: DataFrame, path: str, pattern: str, edits: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_tokens, n_tokens_edited, n_chars_edited, n_chars_encoded (again, for the edits). ``edits`` is an array of (start, end, text)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(edits, F.array()).cast(EDITS).alias("edits"))
    names = [id_col, "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, pattern)
        for batch in in_batches(batches, "text"):
            out = []
            for text, changes in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                tree = TokenTree(text or "", own)
                n, seen = tree.n_tokens, own.encoded_chars
                for change in changes:
                    tree.edit(change["start"], change["end"], change["text"] or "")
                out.append((n, tree.n_tokens, tree.n_chars, own.encoded_chars - seen))
            columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:]))
