"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of symbol pairs.

A text starts as single characters. Neighbours whose join is a piece of the vocabulary lie on an
agenda ordered by the piece's score, the leftmost first among equals. The best pair is merged and
its new neighbours are put on the agenda, until it is empty; entries whose symbols have changed
meanwhile are passed over. Characters outside the vocabulary become byte pieces.

Pieces and scores come from a public model file, read on the executors. No merge crosses a place
where the two characters stand next to each other in no piece, so texts are cut there first: at
word starts, and between letters and other characters if the vocabulary never joins them. Such
words and parts are encoded once per worker and kept in bounded caches. After every Arrow batch the
``sentencepiece`` library encodes the words that the batch brought, and the texts that were not cut
into words; ids that differ are an error.

Defined results: a null or empty text has no tokens and decodes to an empty text; repeated rows get
equal ids; a text may be of any length; new columns replace columns of the same name.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import extend, schema_with, small_batches
from .wordbpe import vocabulary_path

SPACE = "▁"  # stands for a space inside pieces
PLACES = 40  # bits of a position in a text
LAST = (1 << PLACES) - 1
NONE = 1 << 2 * PLACES  # the entry of a pair that no piece joins
FEW = 64  # symbols up to which the agenda is a plain list
CACHE = 400_000  # words and parts in each generation of a worker's caches


class Remembered(dict):
    """Values of a function; of those not asked for lately, some are forgotten."""

    def __init__(self, function):
        super().__init__()
        self.function, self.old, self.new = function, {}, []

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
            self.new.append((key, value))
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceBpe:
    """Encoder and decoder of one model file of the merge type with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.bytes = {int(names[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        kept = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {names[i]: i for i in kept}
        # an agenda's entry is one number: the place of the piece's score, best first, and the position
        scores = {x: r for r, x in enumerate(sorted({sp.get_score(i) for i in kept}, reverse=True))}
        self.entry = {names[i]: scores[sp.get_score(i)] << PLACES for i in kept if len(names[i]) > 1}
        self.id_text = [str(i) for i in range(n)]
        joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)} - {SPACE * 2}
        if any(pair[1] == SPACE for pair in joined):
            raise ValueError("pieces of this vocabulary cross the start of a word")
        # of the word characters outside \d, those of the vocabulary that are no letters
        signs = "".join(sorted(c for c in set("".join(self.ids)) if re.match(r"[^\W\d_]", c) and not c.isalpha()))
        letters, others = rf"[^\W\d_{re.escape(signs)}]+", rf"(?:[^{SPACE}\w]|[\d_{re.escape(signs)}])+"
        apart = all(a.isalpha() == b.isalpha() for a, b in joined if a != SPACE)
        self.parts = re.compile(f"{SPACE}*{letters}|{SPACE}*{others}|{SPACE}+" if apart else
                                f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        text = {i: names[i].replace(SPACE, " ") for i in kept}
        text |= {i: chr(0xDC00 + b) if b > 127 else chr(b) for b, i in self.bytes.items()}
        text |= {i: " ⁇ " for i in range(n) if sp.is_unknown(i)}
        self.text = [text.get(i, "") for i in range(n)]
        self.spaced = {i for p, i in self.ids.items() if p[0] == SPACE}
        self.word_ids, self.part_ids = Remembered(self._word), Remembered(self.merge)
        self.uncut: list[tuple[str, list[int]]] = []  # texts that were not cut into words

    def merge(self, part: str) -> list[int]:
        """Token ids of a part by its agenda."""
        symbols = (self._merge_few if len(part) <= FEW else self._merge_many)(list(part))
        ids, out = self.ids, []
        for s in symbols:
            if s in ids:
                out.append(ids[s])
            else:
                out += [self.bytes[b] for b in s.encode("utf-8", "replace")]
        return out

    def _merge_few(self, symbols: list[str]) -> list[str]:
        """The agenda has one entry for each pair of neighbours; its best is found by looking at all."""
        entry = self.entry.get
        agenda = [entry(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            agenda.pop(i)
            if i < len(agenda):
                agenda[i] = entry(symbols[i] + symbols[i + 1], NONE)
            if i:
                agenda[i - 1] = entry(symbols[i - 1] + symbols[i], NONE)
        return symbols

    def _merge_many(self, symbols: list[str]) -> list[str]:
        """The agenda is a heap of scores with positions; outdated entries are passed over."""
        entry, n = self.entry.get, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = (entry(a + b, NONE) for a, b in zip(symbols, symbols[1:]))
        agenda = [e + i for i, e in enumerate(pairs) if e != NONE]
        heapify(agenda)
        while agenda:
            best = heappop(agenda)
            i = best & LAST
            j = after[i]
            if j >= n or not symbols[i] or entry(symbols[i] + symbols[j], NONE) + i != best:
                continue
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                new = entry(symbols[i] + symbols[k], NONE)
                if new != NONE:
                    heappush(agenda, new + i)
            if h >= 0:
                new = entry(symbols[h] + symbols[i], NONE)
                if new != NONE:
                    heappush(agenda, new + h)
        return [s for s in symbols if s]

    def _part(self, part: str) -> list[int]:
        word = part[1:]
        return self.word_ids[word] if part[0] == SPACE and word.isalpha() else self.part_ids[part]

    def _word(self, word: str) -> list[int]:
        """Ids of a word after a space."""
        if word.isalpha():
            return self.merge(SPACE + word)
        new, out = self.word_ids.new, []
        known = len(new)
        for part in self.parts.findall(SPACE + word):
            out += self._part(part)
        del new[known:]  # whoever checks the word checks its parts
        return out

    def encode(self, text: str | None) -> list[int]:
        """Token ids of one text."""
        given, out = text or "", []
        text = self.library.normalize(given)
        if text[:1] == SPACE and SPACE * 2 not in text:
            known = self.word_ids
            for word in text[1:].split(SPACE):
                out += known[word]
        else:
            for part in self.parts.findall(text):
                out += self._part(part)
            self.uncut.append((given, out))
        return out

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text, checked against the library."""
        out = [self.encode(t) for t in texts]
        words = self.word_ids.new
        self._check(" ".join([w for w, _ in words]), [i for _, ids in words for i in ids])
        for text, ids in self.uncut:
            self._check(text, ids)
        for seen in (self.word_ids.new, self.part_ids.new, self.uncut):
            seen.clear()
        return out

    def _check(self, text: str, ids: list[int]) -> None:
        if text and self.library.encode(text) != ids:
            raise ValueError(f"ids differ from the library's in {text[:200]!r}")

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the space that encoding puts before every text."""
        out = "".join(map(self.text.__getitem__, ids))
        if out.startswith(" ") and next(i for i in ids if self.text[i]) in self.spaced:
            out = out[1:]
        return out if out.isascii() else _BYTES.sub(_characters, out)


_BYTES = re.compile("[\udc80-\udcff]+")


def _characters(run: re.Match) -> str:
    """The characters of a run of bytes (as U+DC80 to U+DCFF); a byte that is part of none is U+FFFD."""
    data, out, at = bytes(ord(c) - 0xDC00 for c in run.group()), [], 0
    while at < len(data):
        for size in (2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            size = 1
        at += size
    return "".join(out)


@functools.lru_cache(2)
def load(path: str | None) -> PieceBpe:
    return PieceBpe(path or vocabulary_path("piece_bpe_32k.model"))


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
    """``df`` without its text, with n_tokens, the SHA-256 of the ids (joined by commas) and of the
    decoded text.

    Encodes and decodes like ``encode`` and ``decode``, but ids and texts stay in the task.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        numbers = bpe.id_text
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for batch in batches:
            encoded = bpe.encode_batch(batch.column(text).to_pylist())
            yield extend(batch, {
                "n_tokens": pa.array([len(x) for x in encoded], pa.int64()),
                "ids_sha256": pa.array([sha(",".join([numbers[i] for i in x])) for x in encoded], pa.string()),
                "decoded_sha256": pa.array([sha(bpe.decode(x)) for x in encoded], pa.string())},
                drop=(text,))

    return df.mapInArrow(run, schema_with(
        df, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", drop=(text,)))
