"""Token ids in a content-addressed store.

Every document becomes the ids of its text and an end id. A rolling hash over
``WINDOW`` ids cuts this stream into chunks, at most ``MOST`` ids long, so equal
passages give equal chunks wherever they stand. The store is three Parquet
folders:

* ``chunks``: hash (128 bits), width (bytes an id), ids (packed, little-endian);
  a chunk is stored once, however many documents have it.
* ``recipes``: documents in ascending order of id (nulls first, then by hash of
  the recipe), with ``part`` (range of ids), ``start`` (ids of all documents
  before it), n_tokens, hashes and sizes of its chunks, ``leaf`` (their digest).
* ``manifest``: a Merkle tree: level 0 has a digest for every ``FAN`` documents
  of a part by their starts, each level above one for every ``FAN`` digests below,
  the last a single root; each with how many leaves and ids it stands for.

Reading makes every leaf anew from the recipe's hashes and sizes, the tree anew
from the leaves, and every chunk's hash from its ids; a difference is an error,
in ``read_store`` and in ``reconstruct``. A document's checksum comes from its
chunks': crc32 is linear, so each chunk's is shifted by the bytes behind it and
all are combined by exclusive or; no ids travel for that. ``reconstruct`` gives
the ids themselves.

Defined cases: a null text counts as empty, a document of the end id alone;
repeated rows are documents of their own, one after the other; strings of the
vocabulary's special tokens are encoded as the library does by default; other
columns are not read, whatever their names; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.jaccard_join import _blocks, mix
from docloom.llm.shared import cut

#: WINDOW and AVERAGE are powers of two.
WINDOW, AVERAGE, MOST = 8, 256, 4096
#: Children of a node of the Merkle tree.
FAN = 1024
END_ID = 1
_REMEMBERED = 1_130_000
#: Marks next to letters, from which the tokenizer's pattern always sets them apart: those of ASCII but the apostrophe.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANKS = b" \t\n\r\x0b\x0c"
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
#: Of bytes: 0 blank, 1 letter, 2 mark, 3 other. Of a byte's class and four times that of the one before it: 0 blank, 1 inside a word, 2 first of one.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_CLASS = bytes(_BLANK if b in _BLANKS else _LETTER if b in _LETTERS + _LETTERS.upper() else _MARK if b in _MARKS else _OTHER for b in range(256))
_PLACE = bytes(0 if b % 4 == _BLANK else 2 if b // 4 == _BLANK or {b // 4, b % 4} == {_LETTER, _MARK} else 1 for b in range(16)) + bytes(240)
_LOWER = bytes(range(256)).lower()
#: Words of letters of ASCII and Latin-1.
_LATIN_1 = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
_OPEN: dict = {}


def _latin(word: str) -> bool:
    """Whether a word is of Latin letters that stay letters when they are lowered (a dotted capital I becomes a letter and a mark)."""
    return word.isalpha() and max(word) < "\u0250" and word.lower().isalpha()


def _words(raw: bytes, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of texts that stand one after the other, lowered as far as single bytes tell, and where each text's words begin and end.

    Words end at ASCII white space, which is white space by any definition (other stays inside the words), and between letters
    of ASCII or Latin-1 and marks of ASCII. Nothing that the tokenizer does reaches over these places.
    """
    kinds, data = np.frombuffer(bytearray(raw.translate(_CLASS)), np.uint8), np.frombuffer(bytearray(raw.translate(_LOWER)), np.uint8)
    # letters of Latin-1 are two bytes, the first of which is C3
    wide = np.flatnonzero(data[:-1] == 0xC3)
    second = data[wide + 1]
    letter = (second & 0xC0 == 0x80) & (second & 0xDF != 0x97)
    wide, second = wide[letter], second[letter]
    kinds[wide] = kinds[wide + 1] = _LETTER
    data[wide[second < 0x9F] + 1] += 0x20
    pairs = kinds.copy()
    pairs[1:] += kinds[:-1] * np.uint8(4)
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    pairs[firsts] &= 3
    pairs = pairs.tobytes()
    places = np.frombuffer(pairs.translate(_PLACE), np.uint8)
    bounds = np.searchsorted(np.flatnonzero(places == 2), offsets)
    # the same without the blanks
    begins = np.flatnonzero(np.frombuffer(pairs.translate(_PLACE, bytes(range(0, 16, 4))), np.uint8) == 2)
    dense = data.tobytes().translate(None, _BLANKS)
    at = np.append(begins, len(dense)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(at), pa.py_buffer(dense)]).dictionary_encode(), bounds


def _values(column: pa.Array) -> list[bytes | None]:
    """Values of a column, by way of numpy, which is several times faster than Arrow's own way for short ones."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of texts by way of their words: the tokenizer joins nothing across white space nor from letters to marks, so each distinct word between these is encoded once.

    A word of letters is a single pre-token: it goes to the library's model with nothing but blanks to look for. Where the last
    token of a pre-token shows itself by a suffix, and as many show as there are words, nothing has to be told of where tokens stand.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # letters beyond ASCII are lowered, composed and spelled by their bytes, but not looked for by the pattern
        self.wide = Tokenizer(self.tokenizer.model)
        self.wide.normalizer = self.tokenizer.normalizer
        self.wide.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # texts with one of these go to the library as they are: a special token may reach over blanks and ends what stands before it
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # what each of them begins with that has no other case: a look for this alone says most often that there are none
        self.signs = {x[: next((i for i, c in enumerate(x) if c.isalpha() or c > "\x7f"), len(x))].encode() for x in self.special}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        # of bytes, letters are those of ASCII
        letters, wide, other = [w for w in words if w.isalpha()], [], []
        for word in words if len(letters) < len(words) else ():
            if not word.isalpha():
                (wide if _LATIN_1(word) or _latin(word.decode("utf-8", "replace")) else other).append(word)
        for some, tokenizer, learn in ((letters, self.letters, self._learn_letters), (wide, self.wide, self._learn_letters), (other, self.tokenizer, self._learn)):
            for i in range(0, len(some), 20_000):
                learn(some[i : i + 20_000], tokenizer)

    def _learn_letters(self, words: list[bytes], tokenizer) -> None:
        """Words of letters in one text, apart by blanks; each has one token at least that ends a pre-token."""
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(words).decode("utf-8", "replace")], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._learn(words, self.tokenizer)
        data, w = ids.tobytes(), self.width
        ends = (ends * w).tolist()
        self.known.update(zip(words, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _learn(self, words: list[bytes], tokenizer) -> None:
        """Words in one text, apart by blanks; their tokens are told apart by where they stand in it."""
        texts = [w.decode("utf-8", "replace") for w in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        found = tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(found.ids, self.kind)
        at = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        bounds = np.searchsorted(at, np.concatenate([[0], np.cumsum(lengths)])).tolist()
        data, w = ids.tobytes(), self.width
        for word, a, b in zip(words, bounds[:-1], bounds[1:], strict=True):
            self.known[word] = data[a * w : b * w]

    def encode_column(self, texts: pa.ChunkedArray, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end behind it, one after the other, and where each text's ids end."""
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        column = texts.cast(pa.large_binary()).combine_chunks().fill_null(b"")
        raw, offsets = self._bytes(column)
        behind = [end] * len(column)
        if any(sign in raw for sign in self.signs):
            whole = {i: t for i, t in enumerate(x.decode("utf-8", "replace") for x in column.to_pylist()) if any(x in low for low in (t.lower(),) for x in self.special)}
            for i, text in whole.items():
                behind[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes() + end
            raw, offsets = self._bytes(pa.array([b"" if i in whole else x for i, x in enumerate(column.to_pylist())], pa.large_binary()))
        words, bounds = _words(raw, offsets)
        different = _values(words.dictionary)
        found = list(map(self.known.get, different))
        new = [w for w, x in zip(different, found, strict=True) if x is None]
        if new:
            self.learn(new)
            learned = map(self.known.__getitem__, new)
            found = [next(learned) if x is None else x for x in found]
        # of each text its words and then what comes behind it
        extra = list(dict.fromkeys(behind))
        number = {x: len(different) + i for i, x in enumerate(extra)}
        pieces = [*found, *extra]
        order = np.insert(words.indices.to_numpy(), bounds[1:], [number[x] for x in behind])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.width
        starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(pieces), self.kind)
        each = sizes[order]
        upto = np.cumsum(each)
        ids = pool[np.repeat(starts[order] - (upto - each), each) + np.arange(upto[-1] if len(upto) else 0)]
        return ids, upto[bounds[1:] + np.arange(len(behind))]

    @staticmethod
    def _bytes(column: pa.LargeBinaryArray) -> tuple[bytes, np.ndarray]:
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        return (data[at[0] : at[-1]].to_pybytes() if data is not None else b""), at - at[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, ends = self.encode_column(pa.chunked_array([pa.array(texts, pa.string())]))
        return [x.tobytes() for x in np.split(ids, ends[:-1])] if texts else []


def encoder(path: str) -> WordEncoder:
    if path not in _OPEN:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]


def cuts(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of all chunks of several documents' ids, which stand one after the other and end at ``ends``."""
    # of many ids of two bytes, each different one is hashed once
    rolled = mix(np.arange(1, 2**16 + 1, dtype=np.uint64))[ids] if ids.itemsize == 2 and len(ids) > 2**16 else mix(ids.astype(np.uint64) + np.uint64(1))
    # the sum of a window's hashes, each shifted by its distance from the last: from one to two, four and so on of them
    for j in (1 << k for k in range(WINDOW.bit_length() - 1)):
        rolled[j:] += rolled[:-j] << np.uint64(j)
    found = np.flatnonzero(mix(rolled) & np.uint64(AVERAGE - 1) == 0)
    # a window that reaches over a document's start does not cut
    starts = np.concatenate([[0], ends])
    found = found[found - starts[np.searchsorted(starts, found, "right") - 1] >= WINDOW] + 1
    found = np.union1d(found, ends)
    sizes = np.diff(np.concatenate([[0], found]))
    if sizes.max(initial=0) > MOST:
        more = [np.arange(e - s + MOST, e, MOST) for e, s in zip(found[sizes > MOST], sizes[sizes > MOST], strict=True)]
        found = np.union1d(found, np.concatenate(more))
    return found.astype(np.int64)


_ROWS = "kind string, key bigint, id bigint, n_tokens bigint, hashes array<binary>, sizes array<int>, hash binary, width int, ids binary"
_SCHEMA = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("id", pa.int64()), ("n_tokens", pa.int64()), ("hashes", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("hash", pa.binary()), ("width", pa.int32()), ("ids", pa.binary())])


def _chunked(path: str):
    """Recipe rows of documents and rows of their chunks, a chunk once a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end = np.array([END_ID], coder.kind).tobytes()
        for block in _blocks(batches):
            tokens, ends = coder.encode_column(block.column("text"), end)
            at = cuts(tokens, ends)
            w, data = coder.width, tokens.tobytes()
            bounds = [0, *(at * w).tolist()]
            pieces = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            names = [hashlib.blake2b(x, digest_size=16).digest() for x in pieces]
            chunks = dict(zip(names, pieces, strict=True))
            n, m = len(ends), len(chunks)
            keys = np.concatenate([np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C1) % np.uint64(2**63), np.frombuffer(b"".join(chunks), "<u8")[::2]]).astype(np.int64)
            last = np.concatenate([[0], np.searchsorted(at, ends) + 1, np.full(m, len(at))]).astype(np.int32)
            own = pa.array(np.arange(n + m) >= n)
            lists = [pa.ListArray.from_arrays(pa.array(last), x, mask=own) for x in (pa.array(names, pa.binary()), pa.array(np.diff(at, prepend=0).astype(np.int32)))]
            blank, none = [None] * n, pa.nulls(m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["recipe"] * n + ["chunk"] * m), pa.array(keys), pa.concat_arrays([block.column("id").combine_chunks(), none]), pa.concat_arrays([pa.array(np.diff(ends, prepend=0)), none]),
                    *lists, pa.array([*blank, *chunks], pa.binary()), pa.array([*blank, *[w] * m], pa.int32()), pa.array([*blank, *chunks.values()], pa.binary()),
                ],
                schema=_SCHEMA,
            )

    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recipes as they are, each chunk once; equal chunks are in one partition."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for name in _values(batch.column("hash")):
            keep.append(name is None or name not in seen)
            if name is not None:
                seen.add(name)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _leaf() -> F.Column:
    """A recipe's digest: of id, sizes and hashes of its chunks."""
    written = F.array_join(F.transform(F.arrays_zip("hashes", "sizes"), lambda x: F.concat(F.hex(x["hashes"]), F.lit(":"), x["sizes"].cast("string"))), ",")
    return F.sha2(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), written), 256)


def _digests(rows: DataFrame) -> DataFrame:
    """From (part, node, place, digest, n_docs, n_tokens) a digest of every node, over its at most FAN children in the order of their places."""
    below = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"]), "")
    return rows.groupBy("part", "node").agg(F.sha2(below, 256).alias("digest"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def _tree(recipes: DataFrame, leaf: F.Column) -> DataFrame:
    """All nodes (level, part, node, digest, n_docs, n_tokens) over the leaves of recipes, the root last; no node has more than FAN children."""
    leaves = recipes.select("part", F.floor(F.col("number") / FAN).alias("node"), F.col("number").alias("place"), leaf.alias("digest"), F.lit(1).cast("bigint").alias("n_docs"), "n_tokens")
    level = cut(_digests(leaves).withColumn("level", F.lit(0)))
    out, depth = level, 0
    # the numbers of nodes and parts tell how many levels follow: first the nodes of each part become one, then the parts themselves
    nodes, parts = (x or 0 for x in level.agg(F.max("node"), F.max("part")).first())
    while nodes or parts:
        inside, depth = nodes > 0, depth + 1
        place, part = ("node", F.col("part")) if inside else ("part", F.floor(F.col("part") / FAN).cast("int"))
        rows = level.select(part.alias("part"), (F.floor(F.col("node") / FAN) if inside else F.lit(0).cast("bigint")).alias("node"), F.col(place).cast("bigint").alias("place"), "digest", "n_docs", "n_tokens")
        level = _digests(rows).withColumn("level", F.lit(depth))
        out = out.unionByName(level)
        nodes, parts = (nodes // FAN, parts) if inside else (0, parts // FAN)
    return out


def write_store(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(_chunked(path), _ROWS)
    raw = f"{folder}/raw"
    # chunks meet by their hash; recipes stay apart from them, dealt by their rows, so that copies do not meet in one task
    rows.repartition("key").mapInArrow(_once, _ROWS).write.partitionBy("kind").option("compression", "zstd").parquet(raw)
    spark = docs.sparkSession
    recipes = spark.read.schema(_ROWS).parquet(raw).where("kind = 'recipe'").select("id", "n_tokens", "hashes", "sizes")
    recipes = recipes.withColumn("leaf", _leaf())
    ranged = cut(recipes.repartitionByRange("id", "leaf").withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a part
    bases = totals.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    # equal rows have equal counts, so either order gives the same starts
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("id"), "leaf").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("number", (F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_first("id"), "leaf")) - 1).cast("bigint"))
    placed = ranged.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("within")).drop("base", "within")
    placed.write.option("compression", "zstd").parquet(f"{folder}/recipes")
    _tree(spark.read.parquet(f"{folder}/recipes"), F.col("leaf")).write.parquet(f"{folder}/manifest")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_ROWS).parquet(f"{folder}/raw").where("kind = 'chunk'").select("hash", "width", "ids")


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    """The recipes, if the tree made anew from them is the manifest's; a difference is an error."""
    recipes, manifest = (spark.read.parquet(f"{folder}/{x}") for x in ("recipes", "manifest"))
    keys, values = ["level", "part", "node"], ["digest", "n_docs", "n_tokens"]
    found = _tree(recipes, _leaf()).select(*keys, *(F.col(c).alias(f"found_{c}") for c in values))
    bad = manifest.join(found, keys, "full_outer").where(" OR ".join(f"NOT {c} <=> found_{c}" for c in values)).count()
    if bad:
        raise ValueError(f"{bad} nodes over the recipes of {folder} differ from the manifest")
    return recipes


def _zero_operators() -> np.ndarray:
    """Row k: the images of the 32 bits of a crc32 under 2**k zero bytes."""
    one = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint64)

    def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(32, np.uint64)
        for bit in range(32):
            out ^= np.where(b >> np.uint64(bit) & np.uint64(1), a[bit], np.uint64(0))
        return out

    op = one
    for _ in range(3):
        op = times(op, op)
    rows = [op]
    for _ in range(40):
        rows.append(times(rows[-1], rows[-1]))
    return np.stack(rows)


def shifted_crc(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """crc32 values of pieces as if so many more bytes followed, up to what those add themselves."""
    out = crc.astype(np.uint64)
    table = _zero_operators()
    for k in range(41):
        chosen = np.flatnonzero(n_bytes >> k & 1)
        if len(chosen):
            value, made = out[chosen], np.zeros(len(chosen), np.uint64)
            for bit in range(32):
                made ^= np.where(value >> np.uint64(bit) & np.uint64(1), table[k, bit], np.uint64(0))
            out[chosen] = made
    return out


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs, sizes = [], []
        for name, width, ids in zip(*(_values(batch.column(c)) for c in ("hash", "width", "ids")), strict=True):
            if hashlib.blake2b(ids, digest_size=16).digest() != name:
                raise ValueError(f"chunk {name.hex()} is damaged")
            wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
            crcs.append(zlib.crc32(wide.tobytes()))
            sizes.append(len(wide))
        yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int64())], ["hash", "crc", "size"])


def read_store(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id_col, start, n_tokens, ids_crc32 (of all its ids as little-endian unsigned 32-bit integers)."""
    recipes = _recipes(spark, folder)

    def placed(batches):
        # one row a chunk, with its size and the bytes of the ids behind it
        for batch in batches:
            starts, tokens, hashes, sizes = (batch.column(c) for c in ("start", "n_tokens", "hashes", "sizes"))
            counts = np.diff(hashes.offsets.to_numpy())
            size = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(size)
            ends = np.cumsum(counts)
            base = np.repeat(np.concatenate([[0], upto])[ends - counts], counts)
            behind = 4 * (np.repeat(tokens.to_numpy(), counts) - (upto - base))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(starts.to_numpy(), counts)), hashes.flatten(), pa.array(size), pa.array(behind)], ["start", "hash", "size", "behind"])

    uses = recipes.select("start", "n_tokens", "hashes", "sizes").mapInArrow(placed, "start bigint, hash binary, size bigint, behind bigint")
    stored = _chunks(spark, folder).mapInArrow(_checksums, "hash binary, crc bigint, size bigint").withColumnRenamed("size", "stored")

    def shift(batches):
        for batch in batches:
            made = shifted_crc(batch.column("crc").to_numpy(), batch.column("behind").to_numpy()).astype(np.int64)
            yield batch.select(["start", "stored"]).append_column("crc", pa.array(made))

    parts = uses.join(stored, "hash").where("size = stored").select("start", "stored", "crc", "behind").mapInArrow(shift, "start bigint, stored bigint, crc bigint")
    sums = parts.groupBy("start").agg(F.sum("stored").alias("found"), F.bit_xor("crc").alias("ids_crc32"))
    whole = recipes.select("id", "start", "n_tokens").join(sums, "start")
    checked = F.when(F.col("found") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a document lacks chunks")).cast("bigint"))
    return whole.select(F.col("id").alias(id_col), "start", checked.alias("n_tokens"), "ids_crc32")


def reconstruct(spark: SparkSession, folder: str, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, ids array<bigint>) of the documents whose ids a table lists."""
    wanted = _recipes(spark, folder).join(ids.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    uses = wanted.select("id", "start", F.posexplode("hashes").alias("at", "hash"), F.col("n_tokens")).join(_chunks(spark, folder), "hash", "left")

    def unpack(batches):
        for batch in batches:
            for name, ids in zip(batch.column("hash").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if hashlib.blake2b(ids, digest_size=16).digest() != name:
                    raise ValueError(f"chunk {name.hex()} is damaged")
            values = [np.frombuffer(x, f"<u{w}").astype(np.int64) for x, w in zip(batch.column("ids").to_pylist(), batch.column("width").to_pylist(), strict=True)]
            yield batch.select(["id", "start", "at"]).append_column("ids", pa.array(values, pa.list_(pa.int64())))

    present = F.when(F.col("ids").isNotNull(), F.col("ids")).otherwise(F.raise_error(F.lit("a document lacks chunks")).cast("binary"))
    rows = uses.select("id", "start", "at", "hash", "width", present.alias("ids")).mapInArrow(unpack, "id bigint, start bigint, at int, ids array<bigint>")
    return rows.groupBy("id", "start").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids")).withColumnRenamed("id", id_col)
