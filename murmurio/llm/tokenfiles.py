"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on the key.

Texts are cut into ranges of the key, sorted, encoded with the ``tokenizers`` library and written as
one ORC file per range, in ascending order of the key. Each row holds its token offset inside its
file; a manifest holds the number of tokens before each file. So a reader finds the place of any
document in the whole stream from the file it reads, stripes are read in parallel, and a look-up of
keys skips stripes by range and row groups by Bloom filter.

The tokenizer's word step is repeated only for words that a worker has not met: texts are cut at
spaces that begin a word and around single line ends, and the ids of such a piece come from the library's
model once; a word with one mark after it is the word's ids and the mark's.

Defined results: a null or empty text has the end token alone; null keys come first; rows that
repeat a key are ordered by a hash of their text; a table without rows gives files without rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmurio.session import scratch_path

from .batches import schema_with, small_batches
from .wordbpe import byte_characters, vocabulary_path

END = 2
CACHE = 600_000
STRIPE_BYTES = 32 << 20
INDEX_ROWS = 1000
_CUT = re.compile(r" (?=\S)")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_ASCII = re.compile(r"[\x00-\x7F]+")
_SEPARATORS = re.compile(r"[\x1C-\x1F]")  # white space here, but not in the library


class Known(dict):
    """Ids of pieces by a function, asked for once; emptied when full."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key: str) -> bytes:
        value = self.function(key)
        if len(self) >= CACHE:
            self.clear()
        self[key] = value
        return value


class Spaced(dict):
    """Ids of pieces after a space, as ``Known``; a piece that begins with ``\\0`` had none before it.

    A piece that no cut can leave, as it is empty or begins with white space, is a ``KeyError``.
    """

    def __init__(self, model, piece):
        super().__init__()
        self.tokenize, self.piece = model.tokenize, piece
        self.after = {c: self.word(c) for c in ".,;:!?)\""}  # marks that are words of their own after letters
        self.line = self.word("Ċ")

    def word(self, mapped: str) -> bytes:
        return array("i", [t.id for t in self.tokenize(mapped)]).tobytes()

    def __missing__(self, key: str) -> bytes:
        if key.isascii() and key.isalpha():
            value = array("i", [t.id for t in self.tokenize("Ġ" + key)]).tobytes()  # ASCII letters stand for themselves
        elif key[-1:] in self.after and key.isascii() and key[:-1].isalpha():
            value = self[key[:-1]] + self.after[key[-1]]
        elif key == "\0\n":
            value = self.line
        elif key[:1] == "\0" and key[1:2].strip():
            value = self.piece(key[1:])
        elif key[:1].strip("\0"):
            if key[0].isspace():
                raise KeyError(key)
            value = self.piece(" " + key)
        else:
            raise KeyError(key)
        if len(self) >= CACHE:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of texts by a byte-level file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.split = self.whole.model, self.whole.pre_tokenizer.pre_tokenize_str
        special = self.whole.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if special else None
        self.bytes = str.maketrans({i: c for i, c in enumerate(byte_characters())})
        # a piece after a space, and other words; pieces of one word are in the first alone
        self.spaced, self.words = Spaced(self.model, self._piece), Known(self._word)

    def _word(self, mapped: str) -> bytes:
        return array("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _mapped(self, word: str) -> str:
        """A word as the vocabulary spells it, a character for each byte."""
        return (word if word.isascii() else word.encode().decode("latin-1")).translate(self.bytes)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece of text that starts and ends where words do."""
        bare = piece[1:] if piece[:1] == " " else piece
        if bare.isalpha():
            return self._word(self._mapped(piece))
        others = "" if piece.isascii() else _ASCII.sub("", piece)
        if (not others or others.isalpha()) and not _SEPARATORS.search(piece):
            words = [self._mapped(w) for w in _WORDS.findall(piece)]
        else:
            words = [w for w, _ in self.split(piece)]
        # a word and the comma after it are two words, the first of which may be known
        return b"".join([self.spaced[w[1:]] if w[0] == "Ġ" and w[1:].isascii() and w[1:].isalpha() else self.words[w]
                         for w in words])

    def _plain(self, text: str, out: list[bytes]) -> None:
        if "\0" not in text:
            first, *rest = text.replace("\n", " \0\n \0").split(" ")
            try:
                found = [self._piece(first)] if first else []
                found += map(self.spaced.__getitem__, rest)
            except KeyError:  # a run of white space is one word
                pass
            else:
                out += found
                return
        first, *rest = _CUT.split(text)
        if first:
            out.append(self._piece(first))
        out += [self._piece(" " + piece) if piece[:1] == "\0" else self.spaced[piece] for piece in rest]

    def encode(self, text: str | None) -> bytes:
        """Ids as 32-bit integers of this machine."""
        out: list[bytes] = []
        parts = self.cut.split(text or "") if self.cut and "<|" in (text or "") else [text or ""]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(array("i", [self.special[part]]).tobytes())
            elif part:
                self._plain(part, out)
        return b"".join(out)


@functools.lru_cache(2)
def load(path: str | None) -> Encoder:
    return Encoder(path or vocabulary_path("byte_bpe_50k.json"))


def write(df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end: int = END,
          vocabulary: str | None = None) -> str:
    """Write (key, part, offset, n_tokens, ids) as ORC below ``path``/tokens and the manifest."""
    small_batches(df.sparkSession)
    rows = df.select(key, F.col(text).alias("_text"), F.xxhash64(text).alias("_tie"))
    rows = rows.repartitionByRange(key, "_tie").sortWithinPartitions(key, "_tie", "_text").drop("_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = load(vocabulary), TaskContext.get().partitionId(), 0
        tail = array("i", [end]).tobytes()
        for batch in batches:
            data = [encoder.encode(t) + tail for t in batch.column("_text").to_pylist()]
            n = np.array([len(d) // 4 for d in data], np.int64)
            stop = np.cumsum(n)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], stop]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(data), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(before + stop - n), pa.array(n), ids],
                names=[key, "part", "offset", "n_tokens", "ids"])
            before += int(stop[-1]) if len(stop) else 0

    encoded = rows.mapInArrow(run, schema_with(
        rows, "part int, offset bigint, n_tokens bigint, ids array<int>", drop=("_text",)))
    (encoded.write.option("orc.bloom.filter.columns", key).option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(INDEX_ROWS)).option("orc.stripe.size", str(STRIPE_BYTES))
     .option("compression", "zstd").orc(f"{path}/tokens"))
    spark = df.sparkSession
    files = (spark.read.schema(encoded.schema).orc(f"{path}/tokens").groupBy("part")
             .agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")))
    # one row per file
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.orc(f"{path}/manifest")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, with ``start``: tokens of all documents before."""
    files = spark.read.schema("part int, tokens bigint, documents bigint, before bigint").orc(
        f"{path}/manifest").select("part", "before")
    rows = spark.read.orc(f"{path}/tokens")
    return rows.join(files, "part").withColumn("start", F.col("before") + F.col("offset"))


def look_up(spark: SparkSession, path: str, keys: list, *, key: str = "doc_id") -> DataFrame:
    """The rows of a few keys; stripes and row groups without them are skipped."""
    return read(spark, path).where(F.col(key).isin(keys))


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ids_crc32 instead of ids: of the ids as little-endian unsigned 32-bit integers."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(crc, pa.int64())],
                                             names=names + ["ids_crc32"])

    return rows.mapInArrow(run, schema_with(rows, "ids_crc32 bigint", drop=("ids",)))


def round_trip(df: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files below the shared folder and read them back."""
    path = write(df, scratch_path(df.sparkSession, "token-files"), key=key, text=text)
    return read(df.sparkSession, path)
