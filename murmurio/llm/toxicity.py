"""Toxicity by compression distance to two zstandard dictionaries.

One dictionary is trained on labelled toxic text and one on labelled ordinary text. A window of a
text that the toxic dictionary compresses better than the ordinary one speaks for toxicity.

A window is a run of five characters of a word, with the word's ends as characters of their own, as
insults are short, few and inflected. Short windows compress to little but frame overhead, so every
window is written as a 16-byte code: known to a dictionary it becomes a match of a few bytes,
unknown it stays 16 literals. What is compared are the lengths of the compressed codes.

Toxic texts consist mostly of ordinary words. So the toxic dictionary is trained on those of their
windows that occur more often in toxic texts than chance explains, also where many ordinary texts hold
them once, and what it knows beyond them is added to the ordinary dictionary. Then a logistic curve
over the occurrences of toxic windows in a document and their density gives the score; 0.5 is the
threshold. A word that occurs n times counts as often as n has binary digits, in training and in
scoring alike, so repetition speaks, and a line repeated many times does not decide alone.

The sample is bounded: about ``SAMPLE`` labelled documents of each class, drawn by a hash of their
key. Scoring reads whole texts, and needs nothing but the two dictionaries and three numbers.

Defined results: a null or empty text has no windows and gets the score of a text without toxic
windows; contradicting labels of a key count as toxic; labels that are null are ignored; without
labelled rows of both classes every score is the share of toxic ones, 0 if there are none; rows
that repeat a text get equal scores.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import extend, schema_with, small_batches

SAMPLE = 3000               # labelled documents of each class, about
WINDOW = 5                  # characters
TOXIC_BYTES, ORDINARY_BYTES = 112 << 10, 512 << 10
EVIDENCE = 20.0             # least log-likelihood ratio of a toxic window's occurrences in the two classes
RATIO = 8.0                 # least ratio of their rates, as languages may have unequal shares of the classes
GAIN = 4                    # bytes by which the toxic dictionary must be better
TRAIN_BYTES = 8 << 20       # of coded ordinary texts that the trainer sees; it needs many times as much
CACHE = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def windows(word: str) -> set[str]:
    ends = f"^{word}$"
    return {ends[i:i + WINDOW] for i in range(max(1, len(ends) - WINDOW + 1))}


def code(window: str) -> bytes:
    return hashlib.blake2b(window.encode("utf-8", "replace"), digest_size=16).digest()


def text_windows(text: str | None) -> tuple[Counter[str], int]:
    """Occurrences of the windows of a text, and of its words."""
    out: Counter[str] = Counter()
    total = 0
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        total += n.bit_length()
        for w in windows(word):
            out[w] += n.bit_length()
    return out, total


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # tables wide enough for every window of a dictionary
    form = zstandard.ZstdCompressionParameters.from_level(
        3, window_log=21, hash_log=20, chain_log=20, min_match=5,
        strategy=zstandard.STRATEGY_DFAST, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    kept.precompute_compress(compression_params=form)
    return zstandard.ZstdCompressor(dict_data=kept, compression_params=form)


def _train(samples: list[bytes], size: int) -> bytes:
    """Dictionary content; of samples too few for the trainer it is the samples themselves."""
    samples = [s for s in samples if s]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 4)), samples, k=16, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Classifier:
    """Two dictionaries and the curve that turns occurrences of toxic windows into a score."""

    def __init__(self, toxic: bytes, ordinary: bytes, curve: tuple[float, ...]):
        self.toxic, self.ordinary, self.curve = toxic, ordinary, curve
        self._ready = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def gain(self, window: str) -> int:
        """Bytes that the toxic dictionary saves more than the ordinary one, 0 if it knows nothing."""
        if self._ready is None:
            self._ready = _compressor(self.toxic), _compressor(self.ordinary)
        data = code(window)
        known = len(self._ready[0].compress(data))
        return len(self._ready[1].compress(data)) - known if known < len(data) else 0

    def score(self, toxic_windows: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(toxic_windows, words) @ np.array(self.curve), -700, 700)))


def _design(toxic_windows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Columns of the curve: 1, occurrences, occurrences in a thousand words."""
    density = 1000 * toxic_windows / np.maximum(1, words)
    return np.stack([np.ones(len(density)), np.log1p(toxic_windows), np.log1p(density)], axis=1)


def _logistic(design: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Intercept and slopes by Newton steps with a small penalty."""
    beta, penalty = np.zeros(3), np.array([0.01, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - y)) + penalty * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        beta -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return tuple(map(float, beta))


def _telling(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """Which windows occur ``bad`` times in toxic texts and ``good`` times in ordinary ones by no chance."""
    share = n_bad / (n_bad + n_good)
    part = lambda n, of: n * np.log(np.maximum(n, 1) / np.maximum(of, 1e-9))
    evidence = 2 * (part(bad, (bad + good) * share) + part(good, (bad + good) * (1 - share)))
    return (evidence >= EVIDENCE) & (bad * n_good >= RATIO * good * n_bad)


def train(toxic: list[str], ordinary: list[str], weight: float = 1.0) -> Classifier:
    """Fit on the texts of the two classes; an ordinary text stands for ``weight`` of them."""
    if not toxic or not ordinary:
        return Classifier(b"\0" * 16, b"\0" * 16, (30.0 if toxic else -30.0, 0.0, 0.0))
    index: dict[str, int] = {}

    def numbered(text: str) -> tuple[np.ndarray, np.ndarray, int]:
        counts, total = text_windows(text)
        return (np.array([index.setdefault(w, len(index)) for w in counts], np.int32),
                np.fromiter(counts.values(), np.int32, len(counts)), total)

    parts = [[numbered(t) for t in texts] for texts in (toxic, ordinary)]
    bad, good = ([p[0] for p in x] for x in parts)
    names = list(index)
    n_bad = np.bincount(np.concatenate(bad), minlength=len(names))
    occurrences = [np.bincount(np.concatenate([p[0] for p in x]), np.concatenate([p[1] for p in x]),
                               minlength=len(names)) for x in parts]
    # what recurs among toxic texts, not one text's rare words
    telling = (n_bad >= 3) & _telling(*occurrences, len(bad), len(good))
    codes = lambda numbers: b"".join([code(names[i]) for i in np.sort(numbers)])
    toxic_dict = _train([codes(s[telling[s]]) for s in bad], TOXIC_BYTES)
    known = _compressor(toxic_dict)
    missed = [i for i in np.flatnonzero(telling) if len(known.compress(code(names[i]))) >= 16]
    missed.sort(key=lambda i: (n_bad[i], names[i]), reverse=True)  # what the trainer left out
    toxic_dict += b"".join(code(names[i]) for i in missed[:max(0, TOXIC_BYTES - len(toxic_dict)) // 16])
    samples, size = [], 0
    for i in sorted(range(len(good)), key=lambda i: code(ordinary[i])):  # a draw, whatever the order of the texts
        samples.append(codes(good[i][~telling[good[i]]]))
        size += len(samples[-1])
        if size > TRAIN_BYTES:
            break
    ordinary_dict = _train(samples, ORDINARY_BYTES)
    del samples
    known = _compressor(toxic_dict)
    known = [i for i, w in enumerate(names) if len(known.compress(code(w))) < 16]
    alarms = [i for i in known if not telling[i]]
    for _ in range(5):
        ordinary_dict += b"".join(code(names[i]) for i in alarms)
        model = Classifier(toxic_dict, ordinary_dict, (0.0, 0.0, 0.0))
        alarms = [i for i in alarms if model.gain(names[i]) >= GAIN]
        if not alarms:
            break
    hit = np.zeros(len(names), bool)
    hit[[i for i in known if model.gain(names[i]) >= GAIN]] = True
    counts = np.array([n[hit[s]].sum() for x in parts for s, n, _ in x], float)
    totals = np.array([total for x in parts for *_, total in x], float)
    labels = np.array([1.0] * len(bad) + [0.0] * len(good))
    return Classifier(toxic_dict, ordinary_dict, _logistic(
        _design(counts, totals), labels, np.where(labels == 1, 1.0, weight)))


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Classifier:
    """Learn from a sample of the labelled documents that are not held out."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
             .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("_toxic")))
    counts = {r[0]: r[1] for r in marks.groupBy("_toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(1_000_000))
    share = F.lit(1_000_000.0 * sample) / F.when(
        F.col("_toxic") == 1, max(1, counts.get(1, 0))).otherwise(max(1, counts.get(0, 0)))
    drawn = marks.where(draw < share).limit(4 * sample)  # at most so many keys are broadcast
    rows = docs.select(key, text).join(F.broadcast(drawn), key).select(text, "_toxic").limit(8 * sample)
    small_batches(docs.sparkSession)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampled = [pair for batch in batches for pair in zip(*(c.to_pylist() for c in batch.columns))]
        texts = {1: [], 0: []}
        for body, toxic in sorted((r[0] or "", int(r[1] == 1)) for r in sampled):
            texts[toxic].append(body)
        shares = [counts.get(c, 0) / max(1, len(texts[c])) for c in (0, 1)]
        model = train(texts[1], texts[0], max(1.0, shares[0] / max(1.0, shares[1])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.toxic], pa.binary()), pa.array([model.ordinary], pa.binary()),
             pa.array([list(model.curve)], pa.list_(pa.float64()))], names=["toxic", "ordinary", "curve"])

    # one task holds the sample, whose windows take many times its size; the driver gets the model alone
    found = rows.coalesce(1).mapInArrow(learn, "toxic binary, ordinary binary, curve array<double>").collect()
    if not found:
        return train([], [])
    return Classifier(bytes(found[0].toxic), bytes(found[0].ordinary), tuple(found[0].curve))


def _counter(model: Classifier):
    """Function of a list of texts: occurrences of toxic windows and of words in each. A word is looked
    at once per worker."""
    by_word: dict[str, int] = {}
    gains: dict[str, bool] = {}

    def toxic(word: str) -> int:
        found = 0
        for w in windows(word):
            if w not in gains:
                gains[w] = model.gain(w) >= GAIN
            found += gains[w]
        return found

    def count(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        counts, totals = [], []
        for body in texts:
            found = total = 0
            for word, n in Counter(_WORD.findall((body or "").lower())).items():
                hits = by_word.get(word)
                if hits is None:
                    hits = by_word[word] = toxic(word)
                total += n.bit_length()
                found += hits * n.bit_length()
            counts.append(found)
            totals.append(total)
        for cache in (by_word, gains):
            if len(cache) > CACHE:
                cache.clear()
        return np.array(counts, np.int64), np.array(totals, np.int64)

    return count


def score(df: DataFrame, model: Classifier, *, text: str = "text") -> DataFrame:
    """``df`` with toxic_windows, score and predicted."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(sent.value)
        for batch in batches:
            counts, totals = count(batch.column(text).to_pylist())
            p = sent.value.score(counts, totals)
            yield extend(batch, {"toxic_windows": pa.array(counts, pa.int64()),
                                 "score": pa.array(p, pa.float64()),
                                 "predicted": pa.array((p >= 0.5).astype(np.int32), pa.int32())})

    return df.mapInArrow(run, schema_with(df, "toxic_windows bigint, score double, predicted int"))


def drop_toxic(df: DataFrame, model: Classifier, *, text: str = "text") -> DataFrame:
    """The documents that are not predicted to be toxic."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(sent.value)
        for batch in batches:
            keep = sent.value.score(*count(batch.column(text).to_pylist())) < 0.5
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
