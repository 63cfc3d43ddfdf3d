"""Byte-pair encoding and decoding of whole texts by batched numpy merge rounds.

The symbols of many words lie in one flat array. In every round the rank of each pair of neighbours
is found by binary search over the sorted pair keys of the merge list, each word merges its pair of
lowest rank, leftmost first, and words without a known pair leave the array.

The vocabulary is a public file of the ``tokenizers`` format whose words end in ``</w>``; it is read
on the executors. Texts are cut at its special tokens, normalised as the file says (NFC, white space,
lower case) and cut into words; every word is encoded once per batch and kept in a bounded cache.

Defined results: a null or empty text has no tokens, and decodes to an empty text; repeated rows
get equal ids; a text may be of any length.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .batches import extend, schema_with, small_batches

CACHE = 400_000  # chunks a worker remembers


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.id_text = [str(i) for i in range(self.size)]
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cache: dict[str, list[int]] = {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of non-empty words."""
        lengths = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        none = len(self.keys)
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            known = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], none), none)
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(rank, start)
            span = np.diff(np.append(start, len(word)))
            spread = np.repeat(lowest, span)
            active = spread < none
            for s, n, w in zip(start[lowest == none], span[lowest == none], word[start[lowest == none]]):
                out[w] = symbols[s:s + n]
            if not active.any():
                break
            here = np.flatnonzero((rank == spread) & active)
            # of overlapping occurrences in a run (a pair of equal symbols) every second one merges
            follows = np.concatenate([[False], here[1:] == here[:-1] + 1])
            if follows.any():
                head = np.maximum.accumulate(np.where(follows, 0, np.arange(len(here))))
                here = here[(np.arange(len(here)) - head) % 2 == 0]
            symbols[here] = self.merged[at[here]]
            keep = active
            keep[here + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out

    def _chunk_words(self, chunk: str) -> list[bytes]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # no final-sigma rule
        return [w.encode("utf-8", "replace") for w in self.words.findall(chunk.lower())]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks of text that the cache lacks."""
        new = [c for c in chunks if c not in self.cache]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = list(chunks)
        parts = [self._chunk_words(c) for c in new]
        words = list({w for p in parts for w in p})
        encoded: dict[bytes, list[int]] = {}
        for at in range(0, len(words), 50_000):
            some = words[at:at + 50_000]
            encoded.update(zip(some, (x.tolist() for x in self.merge(some))))
        for chunk, part in zip(new, parts):
            ids = encoded[part[0]] if len(part) == 1 else [i for w in part for i in encoded[w]]
            self.cache[chunk] = ids

    def pieces(self, text: str | None) -> list[str]:
        """The text cut at special tokens and single spaces; no word spans a cut."""
        text = text or ""
        if "<|" not in text:
            return text.split(" ")
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else part.split(" ")
        return out

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text."""
        out = []
        for at in range(0, len(texts), 200):
            pieces = [self.pieces(t) for t in texts[at:at + 200]]
            self.learn({p for ps in pieces for p in ps if p not in self.special})
            known = self.cache
            for ps in pieces:
                ids: list[int] = []
                for p in ps:
                    ids += known[p] if p not in self.special else [self.special[p]]
                out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by spaces, as a file without a decoder asks for."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


@functools.lru_cache(2)
def load(path: str | None) -> WordBpe:
    return WordBpe(path or vocabulary_path())


def encode(df: DataFrame, *, text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with ids (array of token ids)."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = bpe.encode_batch(batch.column(text).to_pylist())
            yield extend(batch, {"ids": pa.array(ids, pa.list_(pa.int32()))})

    return df.mapInArrow(run, schema_with(df, "ids array<int>"))


def decode(df: DataFrame, *, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with decoded (text of the ids)."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield extend(batch, {"decoded": pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema_with(df, "decoded string"))


def digests(df: DataFrame, *, text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` without its text, with n_tokens and the SHA-256 of the ids and of the decoded text.

    Encodes and decodes like ``encode`` and ``decode``, but ids and texts stay in the task.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            encoded = bpe.encode_batch(batch.column(text).to_pylist())
            numbers = bpe.id_text
            sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
            yield extend(batch, {
                "n_tokens": pa.array([len(x) for x in encoded], pa.int64()),
                "ids_sha256": pa.array([sha(" ".join([numbers[i] for i in x])) for x in encoded]),
                "decoded_sha256": pa.array([sha(bpe.decode(x)) for x in encoded])}, drop=(text,))

    return df.mapInArrow(run, schema_with(
        df, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", drop=(text,)))
