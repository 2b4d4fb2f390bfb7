"""Byte-level BPE encoding and decoding inside per-partition DuckDB queries.

Encoding: every distinct pre-token of a batch becomes token-position rows; a
recursive query joins neighbouring rows with the merge table and contracts the
leftmost pair of minimum rank of each word until no pair of it can be merged.
Decoding: the ids join the vocabulary and an ordered aggregation concatenates
their bytes.

Defined cases: a null text is encoded as the empty text (no ids, decoded to
b""); rows with a null or repeated document id are encoded like any other, one
output row per input row; extra columns are dropped unless named in ``keep``; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docloom.llm.shared import give_back_memory

#: Words of at most this many bytes take the plain query, one merge a step.
SHORT_WORD_BYTES = 64
#: Distinct words contracted by one recursive query.
WORDS_PER_QUERY = 20_000
#: Words whose ids a Python worker remembers between batches, unless told otherwise; then it starts anew.
REMEMBERED_WORDS = 700_000
#: Token rows of all steps that one query for long words holds.
ROWS_PER_QUERY = 1_500_000
#: Characters of text handled at once; a longer single text is one batch.
CHARS_PER_BATCH = 2_000_000
#: Ids decoded by one query.
IDS_PER_QUERY = 300_000

#: One merge of each live word a step; a row is a word with the list of its tokens, and a word without a pair to merge is put
#: out once, done, and leaves.
_CONTRACT_SHORT = """
WITH RECURSIVE contracted(word, toks, done) AS (
    SELECT word, toks, false FROM start
  UNION ALL
    SELECT c.word,
           CASE WHEN best IS NULL THEN toks
                ELSE list_concat(toks[:(best & 255) - 1], [(best >> 8)::INTEGER], toks[(best & 255) + 2:]) END,
           best IS NULL
    FROM contracted AS c
    LEFT JOIN (
        SELECT word, min((m.id::BIGINT << 8) | pos) AS best
        FROM (SELECT word, unnest(toks) AS tok, unnest(toks[2:]) AS nxt, generate_subscripts(toks, 1) AS pos
              FROM contracted WHERE NOT done) AS p
        JOIN merges AS m ON m.l = p.tok AND m.r = p.nxt
        GROUP BY word
    ) AS b ON b.word = c.word
    WHERE NOT c.done
)
SELECT word, toks FROM contracted WHERE done ORDER BY word
"""

#: For long words: a step contracts every pair that is the leftmost of minimum rank among those up to the longest token's
#: bytes away, for what is merged before it further off cannot reach its tokens. A query ends after a bounded number of
#: steps and the next goes on from its last state, so that no more than these are held.
_CONTRACT_LONG = """
WITH RECURSIVE contracted(word, pos, tok, step) AS (
    SELECT word, pos, tok, 0 FROM start
  UNION ALL
    SELECT word, pos, CASE WHEN merge THEN (here >> 32)::INTEGER ELSE tok END, step + 1
    FROM (
        SELECT *, coalesce(lag(merge) OVER (PARTITION BY word ORDER BY pos), false) AS gone
        FROM (
            SELECT *, min(here) OVER (PARTITION BY word) AS best,
                   coalesce(here = min(here) OVER (PARTITION BY word ORDER BY pos
                                                   ROWS BETWEEN {reach} PRECEDING AND {reach} FOLLOWING), false) AS merge
            FROM (
                SELECT c.*, (m.id::BIGINT << 32) | c.pos AS here
                FROM (SELECT *, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt FROM contracted) AS c
                LEFT JOIN merges AS m ON m.l = c.tok AND m.r = c.nxt
            )
        )
    )
    WHERE best IS NOT NULL AND NOT gone AND step < {steps}
)
SELECT word, pos, tok, step FROM (
    SELECT *, max(step) OVER (PARTITION BY word) AS last FROM contracted
) WHERE step = last ORDER BY word, pos
"""

_DECODE = """
SELECT s.segment, string_agg(v.piece, '' ORDER BY s.pos) AS pieces
FROM ids AS s JOIN vocabulary AS v ON v.id = s.id
GROUP BY s.segment ORDER BY s.segment
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, a space, its rank, one token a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder of one rank file; holds one single-threaded DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.split = regex.compile(pattern).findall
        self.most = REMEMBERED_WORDS
        self.remembered: dict[str, bytes] = {}
        self.written = [str(i) for i in range(max(ranks.values(), default=0) + 1)]
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        left, right, merged = (np.array(x, np.int32) for x in (left, right, merged))
        self.reach = max(map(len, ranks), default=1)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "250MB"})
        self.con.execute("SET preserve_insertion_order = false")
        merges = pa.table({"l": left, "r": right, "id": merged})
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "piece": pa.array((t.hex() for t in ranks), pa.string())})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.con.register("rows_", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows_")
            self.con.unregister("rows_")

    def _contract_short(self, words: list[bytes]) -> list[np.ndarray]:
        ends = np.cumsum([0, *map(len, words)])
        toks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]))
        self.con.register("start", pa.table({"word": np.arange(len(words), dtype=np.int32), "toks": toks}))
        done = self.con.sql(_CONTRACT_SHORT).to_arrow_table().column("toks").combine_chunks()
        self.con.unregister("start")
        return np.split(done.flatten().to_numpy(), np.cumsum(done.value_lengths().to_numpy())[:-1])

    def _contract_long(self, words: list[bytes]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        start = pa.table({
            "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": (np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)).astype(np.int32),
            "tok": self.byte_ids[np.frombuffer(b"".join(words), np.uint8)],
        })
        while True:
            self.con.register("start", start)
            # so many steps that the states of a query stay within a bounded number of rows
            steps = max(1, ROWS_PER_QUERY // start.num_rows)
            done = self.con.execute(_CONTRACT_LONG.replace("{steps}", str(steps)).replace("{reach}", str(self.reach))).fetchnumpy()
            self.con.unregister("start")
            if not (done["step"] == steps).any():
                break
            start = pa.table({c: np.asarray(done[c], np.int32) for c in ("word", "pos", "tok")})
        cuts = np.searchsorted(done["word"], np.arange(1, len(words)))
        return np.split(np.asarray(done["tok"], np.int32), cuts)

    def learn(self, new: list[str]) -> None:
        """Contract words and remember their ids (little-endian int32)."""
        coded = [(w, w.encode("utf-8", "surrogatepass")) for w in new]
        for contract, part, size in (
            (self._contract_short, [x for x in coded if len(x[1]) <= SHORT_WORD_BYTES], WORDS_PER_QUERY),
            (self._contract_long, [x for x in coded if len(x[1]) > SHORT_WORD_BYTES], 64),
        ):
            for i in range(0, len(part), size):
                some = part[i : i + size]
                for (word, _), ids in zip(some, contract([b for _, b in some]), strict=True):
                    self.remembered[word] = ids.tobytes()

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, and the same as decimal numbers joined by one space."""
        if len(self.remembered) > self.most:
            self.remembered.clear()
        split = [self.split(t) for t in texts]
        known = self.remembered
        self.learn(list(set().union(*split).difference(known)))
        for words in split:
            ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)
            yield ids, " ".join(map(self.written.__getitem__, ids.tolist()))

    def decode_batch(self, many: list[np.ndarray]) -> Iterator[list[bytes]]:
        """The bytes of each id sequence, as a list of pieces in order."""
        segments, owner = [], []
        for i, ids in enumerate(many):
            for a in range(0, len(ids), IDS_PER_QUERY):
                segments.append(ids[a : a + IDS_PER_QUERY])
                owner.append(i)
        out: list[list[bytes]] = [[] for _ in many]
        group: list[int] = []
        size = 0
        for k in [*range(len(segments)), None]:
            if k is None or size + len(segments[k]) > IDS_PER_QUERY:
                for g, piece in zip(group, self._decode([segments[g] for g in group]), strict=True):
                    out[owner[g]].append(piece)
                group, size = [], 0
            if k is not None:
                group.append(k)
                size += len(segments[k])
        yield from out

    def _decode(self, segments: list[np.ndarray]) -> list[bytes]:
        if not segments:
            return []
        lengths = [len(s) for s in segments]
        ids = np.concatenate(segments)
        self.con.register("ids", pa.table({"segment": np.repeat(np.arange(len(segments), dtype=np.int32), lengths), "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        rows = self.con.execute(_DECODE).fetchall()
        self.con.unregister("ids")
        return [bytes.fromhex(pieces) for _, pieces in rows]


_OPEN: dict[tuple[str, str], ByteBpe] = {}


def close_all() -> None:
    for coder in _OPEN.values():
        coder.con.close()
    _OPEN.clear()
    give_back_memory()


def tokenizer(path: str, pattern: str) -> ByteBpe:
    """One tokenizer for each rank file and Python worker."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _OPEN[path, pattern]


def in_batches(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about CHARS_PER_BATCH bytes of text or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > CHARS_PER_BATCH:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = (), with_ids: bool = False, remember: int = REMEMBERED_WORDS, close: bool = False) -> DataFrame:
    """Per row: id_col, the columns of keep, n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256 (of the bytes the ids decode to), and with_ids the ids. ``remember``: words that a worker keeps, about 200 bytes each; ``close``: only until its task ends."""
    rows = docs.select(id_col, *keep, docs[text_col].alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text"), "n_tokens bigint, ids_sha256 string, decoded_sha256 string", *(["ids array<int>"] if with_ids else [])])

    def run(batches):
        coder = tokenizer(path, pattern)
        coder.most = remember
        for batch in in_batches(batches, "__text"):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            ids, shas = [], []
            for one, written in coder.encode_batch(texts):
                ids.append(one)
                shas.append(hashlib.sha256(written.encode()).hexdigest())
            decoded = []
            for pieces in coder.decode_batch(ids):
                digest = hashlib.sha256()
                for piece in pieces:
                    digest.update(piece)
                decoded.append(digest.hexdigest())
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            made = [pa.array([len(x) for x in ids], pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                made.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))))
            yield pa.RecordBatch.from_arrays([*kept, *made], [*names, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(kept) + len(made)])
        if close:
            close_all()

    return rows.mapInArrow(run, schema)
