r"""Line deduplication by a deletion-neighbourhood join.

A line's words are its runs without ASCII white space, lower-cased in A-Z. Lines
of ``EXACT_WORDS`` words and more are duplicates when all words agree; lines of
``NEAR_WORDS`` and more also when one word is replaced, inserted or deleted (in
shorter ones a word is a third of the line or more). A line goes when a line
earlier in (id, text hash, line number) is its duplicate, so the earliest of any
group of duplicates stays. Lines without a word stay.

Most lines have no duplicate: one edit leaves the first or the last half of a
line as it is, so a first pass over (lengths rounded to a power of two)
beginnings and ends marks those that occur twice in a bitmap of bounded size, and
only lines with a marked beginning or end go on. A crowded bitmap lets more lines
through and loses none.

Lines of the same words meet first, with their words: the earliest of them stands
for all, the others go. Each that is left emits the hash of its words (its full
variant) and of its words without the p-th, for every p. Lines with an equal
variant are candidates when both lack the word at the same p, or when one of them
is full; each is joined with the words of one earlier candidate and goes when one
edit at most tells them apart. Where the words are further apart two hashes were
equal by chance, and the lines of such pairs are looked at with other hashes until
none is left, so no hash decides.

Defined cases: a null text stays null and has no lines; rows of the same id and
text are not earlier than each other and lose the same lines; rows without an id
come first; other columns pass through, but those named n_lines or n_removed give
way to the new ones; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.jaccard_join import _Hashes, _blocks, mix
from docloom.llm.shared import cut, give_back_memory

EXACT_WORDS, NEAR_WORDS = 1, 4
#: Bits of the bitmap: 32 for each line, but at most this many (64 MB).
MOST_BITS_LOG2 = 29
#: Characters of all lines for each bucket; a bucket holds no more, however many lines go on.
CHARS_PER_BUCKET = 14_400_000
LINES_PER_ROW = 5_000
MOST_WORDS = 200_000
_FULL = np.uint32(0xFFFFFFFF)
_NO_ID = -(2**63)
_WORDS = _Hashes()


def line_words(text: str | None) -> list[list[bytes]]:
    return [] if text is None else [line.split() for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def _floor_power(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def end_keys(words: list[bytes]) -> list[int]:
    """Hashes of the beginnings and ends that a duplicate of the line must share one of; none for lines without a word."""
    import xxhash

    h, n = xxhash.xxh3_64_intdigest, len(words)
    if n < EXACT_WORDS:
        return []
    if n < NEAR_WORDS:
        return [h(b" ".join(words), 1)]
    keys = []
    # the second one is for lines of a word less
    for size in {_floor_power(n // 2), _floor_power(max(n - 1, NEAR_WORDS) // 2)}:
        keys += [h(b" ".join(words[:size]), 2), h(b" ".join(words[-size:]), 3)]
    return keys


def variants(lines: list[list[bytes]], seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lines of NEAR_WORDS or more, one after the other: hashes of their variants, the places of the missing words (_FULL for none), and the line of each."""
    import xxhash

    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    n = int(counts.sum())
    h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) if seed else _WORDS[w] for words in lines for w in words), np.uint64, n)
    line = np.repeat(np.arange(len(lines)), counts)
    ends = np.cumsum(counts)
    first, last = ends - counts, ends - 1
    place = np.arange(n) - first[line]
    at = mix(np.arange(counts.max(initial=0) + 1, dtype=np.uint64) + np.uint64(1))
    # sums over all lines wrap around; differences inside a line are right all the same
    here, moved = mix(h ^ at[place + 1]), mix(h ^ at[place])
    stay, move = np.cumsum(here), np.cumsum(moved)
    before = stay - here
    full = stay[last] - before[first]
    # the words before the missing one stay, those behind it move up by one place
    without = before - before[first][line] + move[last][line] - move
    sigs, places = np.empty(n + len(lines), np.uint64), np.full(n + len(lines), _FULL, np.uint32)
    sigs[first + np.arange(len(lines))] = mix(full ^ counts.astype(np.uint64))
    rest = np.arange(n) + line + 1
    sigs[rest], places[rest] = mix(without ^ (counts - 1).astype(np.uint64)[line]), place
    return sigs, places, np.repeat(np.arange(len(lines)), counts + 1)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))


def _marked_ends(source: DataFrame, lines: int, buckets: int):
    """Bitmap of the beginnings and ends that occur twice; each task of the second step fills a slice of it."""
    bits = min(MOST_BITS_LOG2, max(16, (32 * max(lines, 1)).bit_length()))

    def emit(batches):
        for block in _blocks(batches):
            keys = np.fromiter((k for t in block.column("text").to_pylist() for words in line_words(t) for k in end_keys(words)), np.uint64)
            keys, counts = np.unique(keys >> np.uint64(64 - bits), return_counts=True)
            part = (keys * np.uint64(buckets)) >> np.uint64(bits)
            for p in np.unique(part).tolist():
                own = part == p
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([keys[own].astype(np.uint32).tobytes()]), pa.array([np.packbits(counts[own] > 1).tobytes()])], ["part", "keys", "twice"])

    def gather(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.uint32)
                held.setdefault(row["part"], []).append((keys, np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(keys))))
        for p, rows in held.items():
            keys, seen = np.unique(np.concatenate([k for k, _ in rows]), return_counts=True)
            twice = np.union1d(keys[seen > 1], np.concatenate([k[t == 1] for k, t in rows]))
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([twice.astype(np.uint32).tobytes()])], ["part", "keys"])

    found = source.select("text").mapInArrow(emit, "part int, keys binary, twice binary").repartition(buckets, "part").mapInArrow(gather, "part int, keys binary")
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    # never more than the bitmap's bits, whatever the input
    for row in found.toLocalIterator(prefetchPartitions=True):
        keys = np.frombuffer(row["keys"], np.uint32)
        np.bitwise_or.at(bitmap, keys >> np.uint32(3), np.uint8(1) << (keys & np.uint32(7)).astype(np.uint8))
    return source.sparkSession.sparkContext.broadcast(bitmap), bits


_LINES = "bucket int, ids binary, ths binary, lines binary, words binary"
_ARROW_LINES = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "ths", "lines", "words"))])
_VARIANTS = "bucket int, ids binary, ths binary, lines binary, runs binary, sigs binary, places binary"
_ARROW_VARIANTS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "ths", "lines", "runs", "sigs", "places"))])
_KINDS = {"ids": np.int64, "ths": np.int64, "lines": np.int32}


def _line_row(bucket: int, places: list[tuple], words: list[bytes] | None) -> dict:
    """Places (id, th, line) with the words of each; words are null for lines that go."""
    return {"bucket": bucket, **{c: np.array(x, kind).tobytes() for (c, kind), x in zip(_KINDS.items(), zip(*places, strict=True), strict=True)}, "words": None if words is None else b"\n".join(words)}


def _places(row: dict) -> list[tuple]:
    return list(zip(*(np.frombuffer(row[c], kind).tolist() for c, kind in _KINDS.items()), strict=True))


def _emit_lines(bitmap, bits: int, buckets: int):
    """Lines with a marked beginning or end, equal ones of a block once, by the bucket of their words."""
    import xxhash

    def run(batches):
        marks = bitmap.value
        shift = 64 - bits
        for block in _blocks(batches):
            lines: dict[bytes, list[tuple]] = {}
            for i, th, text in zip(block.column("id").to_pylist(), block.column("th").to_pylist(), block.column("text").to_pylist()):
                for no, words in enumerate(line_words(text)):
                    for key in end_keys(words):
                        key >>= shift
                        if marks[key >> 3] >> (key & 7) & 1:
                            lines.setdefault(b" ".join(words), []).append((i, th, no))
                            break
            gone: list[tuple] = []
            parts: dict[int, list[tuple]] = {}
            for key, places in lines.items():
                first = min(places)
                gone += [p for p in places if p != first]
                parts.setdefault(xxhash.xxh3_64_intdigest(key, 4) % buckets, []).append((first, key))
            rows = [_line_row(b, [p for p, _ in own], [k for _, k in own]) for b, own in parts.items()]
            if gone:
                rows.append(_line_row(gone[0][0] % buckets, gone, None))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW_LINES)

    return run


def _first_lines(batches):
    """Of the lines of the same words the earliest, with its words, if it can have near ones; the others as lines that go."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["words"] is None:
                yield pa.RecordBatch.from_pylist([row], _ARROW_LINES)
            else:
                held.setdefault(row["bucket"], []).append(row)
    while held:
        bucket, rows = held.popitem()
        firsts: dict[bytes, tuple] = {}
        gone = []
        for row in rows:
            for place, key in zip(_places(row), row["words"].split(b"\n"), strict=True):
                other = firsts.setdefault(key, place)
                if place != other:
                    firsts[key] = min(place, other)
                    gone.append(max(place, other))
        stay = [(p, k) for k, p in firsts.items() if k.count(b" ") >= NEAR_WORDS - 1]
        for a in range(0, len(gone), LINES_PER_ROW):
            yield pa.RecordBatch.from_pylist([_line_row(bucket, gone[a : a + LINES_PER_ROW], None)], _ARROW_LINES)
        for a in range(0, len(stay), LINES_PER_ROW):
            part = stay[a : a + LINES_PER_ROW]
            yield pa.RecordBatch.from_pylist([_line_row(bucket, [p for p, _ in part], [k for _, k in part])], _ARROW_LINES)
    give_back_memory()


def _emit_variants(buckets: int, seed: int, hash_bits: int):
    """Packed variants by bucket."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sigs, places, owner = variants([key.split() for key in row["words"].split(b"\n")], seed)
                sigs >>= np.uint64(64 - hash_bits)
                bucket = (sigs % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                sigs, places, owner, bucket = (x[order] for x in (sigs, places, owner, bucket))
                # a run is a line's variants in a bucket
                heads = np.flatnonzero(np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(owner) != 0)]))
                runs = np.diff(heads, append=len(owner)).astype(np.uint32)
                columns = {c: np.frombuffer(row[c], kind)[owner[heads]] for c, kind in _KINDS.items()} | {"runs": runs}
                cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
                out = []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    i, j = np.searchsorted(heads, (a, b))
                    out.append({"bucket": int(bucket[a]), **{c: x[i:j].tobytes() for c, x in columns.items()}, "sigs": sigs[a:b].tobytes(), "places": places[a:b].tobytes()})
                yield pa.RecordBatch.from_pylist(out, _ARROW_VARIANTS)
            if len(_WORDS) > MOST_WORDS:
                _WORDS.clear()
        _WORDS.clear()
        give_back_memory()

    return run


def earlier_partners(rank: np.ndarray, sigs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variants whose hash shows an earlier line, and one of that line: the next earlier of the same missing place, else a full one, or any if the variant is full."""
    order = np.lexsort((rank, places, sigs))
    r, s, p = rank[order], sigs[order], places[order]
    head = np.concatenate([[True], s[1:] != s[:-1]])
    starts, group = np.flatnonzero(head), np.cumsum(head) - 1
    same = ~(head | np.concatenate([[True], p[1:] != p[:-1]]))
    full = p == _FULL

    def earliest(ranks):
        # the place of each group's smallest rank
        by = np.lexsort((ranks, group))[starts]
        return by[group]

    none = np.iinfo(np.int64).max
    by_full, by_any = earliest(np.where(full, r, none)), earliest(r)
    with_full, with_any = full[by_full] & (r > r[by_full]), full & (r > r[by_any])
    partner = np.where(same, np.arange(len(r)) - 1, np.where(with_full, by_full, by_any))
    found = np.flatnonzero(same | with_full | with_any)
    return order[found], order[partner[found]]


_PAIRS = [f"{side}{c}" for side in ("", "p_") for c in ("id", "th", "line")]


def _near_pairs(batches):
    """Candidates: a line and an earlier one that has a variant's hash in common with it."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["bucket"], []).append(row)
    while held:
        rows = held.popitem()[1]
        whole = lambda c, kind: np.frombuffer(b"".join(r[c] for r in rows), kind)  # noqa: E731, B023
        ids, ths, lines = (whole(c, kind) for c, kind in _KINDS.items())
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((lines, ths, ids))] = np.arange(len(ids))
        owner = np.repeat(np.arange(len(ids)), whole("runs", np.uint32))
        later, earlier = earlier_partners(rank[owner], whole("sigs", np.uint64), whole("places", np.uint32))
        if len(later):
            a, b = np.unique(np.stack([owner[later], owner[earlier]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x[side]) for side in (a, b) for x in (ids, ths, lines)], _PAIRS)
    give_back_memory()


def one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one word replaced, inserted or deleted at most makes one line of the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def _unpacked_lines(batches):
    for batch in batches:
        for row in batch.to_pylist():
            columns = [pa.array(np.frombuffer(row[c], kind)) for c, kind in _KINDS.items()]
            words = [] if row["words"] is None else [pa.array(row["words"].split(b"\n"), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *words], ["id", "th", "line", "words"][: 3 + len(words)])


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, th, line, near) of the lines that have a candidate: whether the words of one are at most one edit away."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("words").to_pylist(), batch.column("p_words").to_pylist()
            near = [one_edit(x.split(), y.split()) for x, y in zip(left, right, strict=True)]
            yield batch.select(["id", "th", "line"]).append_column("near", pa.array(near, pa.bool_()))

    rows = pairs.join(lines, ["id", "th", "line"]).join(lines.toDF("p_id", "p_th", "p_line", "p_words"), ["p_id", "p_th", "p_line"])
    compared = rows.select("id", "th", "line", "words", "p_words").mapInArrow(run, "id bigint, th bigint, line int, near boolean")
    return compared.groupBy("id", "th", "line").agg(F.max("near").alias("near"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """Rows (id, th, line) of the lines that go, id filled and th the hash of the text."""
    source = _source(docs, id_col, text_col)
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    chars, lines = source.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)), F.coalesce(F.sum(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1), F.lit(0))).first()
    bitmap, bits = _marked_ends(source, lines, max(parallel, -(-lines // 4_000_000)))
    buckets = max(parallel, -(-chars // CHARS_PER_BUCKET))
    firsts = cut(source.mapInArrow(_emit_lines(bitmap, bits, buckets), _LINES).repartition(buckets, "bucket").mapInArrow(_first_lines, _LINES))
    gone = firsts.where("words IS NULL").mapInArrow(_unpacked_lines, "id bigint, th bigint, line int")
    firsts = firsts.where("words IS NOT NULL")
    worded = firsts.mapInArrow(_unpacked_lines, "id bigint, th bigint, line int, words binary")
    # a line whose candidate was a chance of the hash alone may have missed its own: once more with other hashes
    unsettled, seed = None, 0
    while True:
        packed = firsts.mapInArrow(_emit_variants(buckets, seed, hash_bits), _VARIANTS).repartition(buckets, "bucket")
        tried = cut(_verified(packed.mapInArrow(_near_pairs, ", ".join(f"{c} {'int' if 'line' in c else 'bigint'}" for c in _PAIRS)), worded))
        gone = gone.unionAll(tried.where("near").select("id", "th", "line"))
        failed = tried.where("NOT near").select("id", "th", "line")
        unsettled = failed if unsettled is None else cut(unsettled.join(failed, ["id", "th", "line"], "left_semi"))
        if unsettled.isEmpty():
            return gone
        seed += 1


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """docs with the duplicate lines taken out of text_col, and n_lines, n_removed. ``hash_bits`` of a variant choose candidates."""
    gone = duplicate_lines(docs, id_col, text_col, hash_bits).groupBy("id", "th").agg(F.collect_set("line").alias("__gone"))
    gone = gone.withColumnRenamed("id", "__id").withColumnRenamed("th", "__th")
    rows = docs.join(gone, (F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)) == F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__th")), "left")
    rows = rows.withColumn("__lines", F.split(F.col(text_col), "\n"))
    kept = F.expr("if(__gone IS NULL, NULL, array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone), i -> get(__lines, i)), '\n'))")
    keep = [F.coalesce(kept, F.col(text_col)).alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return rows.select(*keep, F.coalesce(F.when(F.col(text_col).isNotNull(), F.size("__lines")), F.lit(0)).alias("n_lines"), F.coalesce(F.when(F.col("__gone").isNotNull(), F.size("__gone")), F.lit(0)).alias("n_removed"))
