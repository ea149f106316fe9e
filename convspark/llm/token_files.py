"""Token ids in binary shards with Elias-Fano document boundaries."""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder, small_batches, table, whole_text
from .elias_fano import EliasFano

MAGIC = b"TEF1"
# Fixed value: the byte-level tokenizer's split of a text into words, from its public description.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte (as a Latin-1 character) to the character that stands for it in the vocabulary: printable ones for themselves.
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_SPACE, _ENDS = " ".translate(_BYTE_CHARS), frozenset(".,;:!?)")
#: White space on whose kind regular-expression libraries disagree; such texts take the library's own way.
_ODD = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
_TWO_SPACES, _CUT = re.compile(r"\s\s"), re.compile(r"(?<=\S) ")
#: Entries of a worker's tables of known pieces and of known words; what comes when one is full is encoded each time.
KNOWN_PIECES, KNOWN_WORDS = 400_000, 100_000


class Known(dict):
    """What ``make`` gives for the first ``size`` keys that were asked for."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.size:
            self[key] = value
        return value


class _Pieces:
    """Ids, as bytes, of pieces of text, for a byte-level tokenizer; ``spaced`` has those of a space and a piece."""

    def __init__(self, tokenizer, dtype):
        import regex

        self.split, self.model, self.code = regex.compile(WORDS).findall, tokenizer.model, "H" if dtype.itemsize == 2 else "I"
        self.words, self.spaced = Known(self._word, KNOWN_WORDS), Known(self._spaced, KNOWN_PIECES)

    def _ids(self, chars: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(chars)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _word(self, word: str) -> bytes:
        return self._ids(word.encode().decode("latin-1").translate(_BYTE_CHARS))

    def _spaced(self, piece: str) -> bytes:
        # Letters are one word, and a mark after them is another, so that most pieces needn't be split.
        if piece.isascii():
            if piece.isalpha():
                return self._ids(_SPACE + piece) if len(self.spaced) < self.spaced.size else self.words[" " + piece]
            if piece[-1:] in _ENDS and piece[:-1].isalpha():
                return self.spaced[piece[:-1]] + self.words[piece[-1]]
        words = self.split(" " + piece)
        # A piece that is one word is kept once, as a piece while there is room.
        return self._word(words[0]) if len(words) == 1 and len(self.spaced) < self.spaced.size else b"".join([self.words[w] for w in words])

    def of(self, piece: str) -> bytes:
        return b"".join([self.words[w] for w in self.split(piece)])


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    A plain byte-level tokenizer never joins a character that isn't white space with the space after it, so that a text
    can be cut there; pieces come from a table of those that the library has already encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = t = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if t.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.added = [x.content for x in t.get_added_tokens_decoder().values()]
        pre = t.pre_tokenizer
        self.pieces = _Pieces(t, self.dtype) if isinstance(pre, ByteLevel) and t.normalizer is None and pre.use_regex and not pre.add_prefix_space else None

    def encode(self, text: str) -> bytes:
        if self.pieces is None or _ODD.search(text) or any(x in text for x in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        first, *rest = _CUT.split(text) if _TWO_SPACES.search(text) else text.split(" ")
        spaced = self.pieces.spaced
        return self.pieces.of(first) + b"".join([spaced[p] for p in rest])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _shard(doc_ids: list[int | None], bodies: list[bytes], dtype: np.dtype) -> bytes:
    """magic, bytes an id, ids of null documents, smallest id, boundaries, document ids less the smallest, token ids."""
    nulls = sum(d is None for d in doc_ids)
    own = np.array(doc_ids[nulls:], np.int64)
    least = int(own[0]) if len(own) else 0
    bounds = np.concatenate([[0], np.cumsum([len(b) // dtype.itemsize for b in bodies])])
    return b"".join([MAGIC, struct.pack("<BIq", dtype.itemsize, nulls, least), EliasFano.encode(bounds).to_bytes(), EliasFano.encode(own.view(np.uint64) - np.uint64(least & (1 << 64) - 1)).to_bytes(), *bodies])


class Shard:
    """One written shard: ``shard.document(i)`` finds a document by two selects."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        width, self.nulls, self.least = struct.unpack_from("<BIq", data, 4)
        self.bounds, at = EliasFano.from_bytes(data, 4 + struct.calcsize("<BIq"))
        self.own, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, np.dtype(f"<u{width}"), offset=at)

    def __len__(self) -> int:
        return self.bounds.n - 1

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds[i] : self.bounds[i + 1]]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.own.decode() + np.uint64(self.least & (1 << 64) - 1)).view(np.int64).tolist()


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, shard_ids: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes whole texts, ends each by ``end_id`` and writes them in ascending order of the integer id to ``path``.

    The rows are dealt out by ranges of the id and sorted (equal ids by text, null ids first), so that shards follow
    each other by (part, shard). A row of the written table is a shard: a binary payload of about ``shard_ids`` ids (a
    longer document has one of its own), and the counts that readers need. Spark's writer commits whole tasks, so a lost
    executor leaves no part. Null and empty texts are just ``end_id``. No rows make an empty table.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    # Rows of one id, or of none, are told apart by how their texts begin, so that they needn't share a part.
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 32)).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def encode(batches):
        enc, part, shard, start = _encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], enc.dtype).tobytes()
        ids: list[int | None] = []
        bodies: list[bytes] = []
        size = 0

        def out():
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "start": pa.array([start], pa.int64()), "n_ids": pa.array([size], pa.int64()), "payload": pa.array([_shard(ids, bodies, enc.dtype)], pa.large_binary())})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = enc.encode(text.as_py()) + end
                n = len(body) // enc.dtype.itemsize
                if ids and size + n > shard_ids:
                    yield out()
                    shard, start, size, ids, bodies = shard + 1, start + size, 0, [], []
                ids.append(doc)
                bodies.append(body)
                size += n
        if ids:
            yield out()

    rows.mapInArrow(encode, "part int, shard int, start long, n_ids long, payload binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files in order: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    A part's base is the sum of the parts before it (a row a part); inside, boundaries come from the shards' codes.
    """
    shards = spark.read.schema("part int, shard int, start long, n_ids long, payload binary").parquet(path)
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def decode(batches):
        for batch in batches:
            for base, start, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = Shard(payload)
                bounds = s.bounds.decode().astype(np.int64)
                wide = memoryview(s.ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(s.doc_ids(), pa.int64()), "start": pa.array(bounds[:-1] + base + start), "n_tokens": pa.array(np.diff(bounds)), "ids_crc32": pa.array(crc, pa.int64())})

    return shards.join(F.broadcast(bases), "part").select("base", "start", "payload").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark, sf_dir):
    import public_tokenizers

    path = shared_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path)
