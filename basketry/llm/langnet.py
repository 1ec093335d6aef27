"""Language identification by a convolutional network over bytes.

Filters of several widths run over the bytes of fixed-length windows; each
filter's largest response in the window is kept (max pooling, rectified) and a
softmax layer gives the languages.  The network is trained in numpy on a
bounded sample of windows of labelled texts and then applied, in batches, to
windows that cover every byte of every text; a text's language is the one with
the largest mean log-probability over its windows.

A filter's response is a sum of one weight per place and byte, so its weights
are tables indexed by byte; for scoring, the tables of two neighbouring places
are added up to one indexed by byte pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import batches, per_text, pick, raw_bytes, texts

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
PAD = 256           # stands after a text's last byte; has no weight
UNKNOWN = "und"


class Net:
    """Weights: ``taps[w]`` (place, byte, filter) and ``bias[w]`` for each
    width, ``out`` (pooled filter, language) and ``base`` (language)."""

    def __init__(self, languages: list[str], seed: int = 11):
        rnd = np.random.default_rng(seed)
        self.languages = languages
        self.taps = [rnd.normal(0, 0.1, (w, PAD + 1, FILTERS)).astype(np.float32) for w in WIDTHS]
        for t in self.taps:
            t[:, PAD] = 0
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rnd.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.base = np.zeros(len(languages), np.float32)
        self.pairs: list = []

    def weights(self) -> list[np.ndarray]:
        return [*self.taps, *self.bias, self.out, self.base]

    def log_softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.out + self.base
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy of windows ``x`` with languages ``y``."""
        n, rows, every = len(x), np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        places, pooled = [], []
        for taps, bias in zip(self.taps, self.bias):
            spots = x.shape[1] - len(taps) + 1
            response = sum(t[x[:, k:k + spots]] for k, t in enumerate(taps))
            best = response.argmax(axis=1)
            places.append(best)
            pooled.append(np.maximum(response[rows, best, every] + bias, 0))
        h = np.concatenate(pooled, axis=1)
        error = np.exp(self.log_softmax(h))
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.out.T) * (h > 0)
        d_taps, d_bias = [], []
        for k, (taps, best) in enumerate(zip(self.taps, places)):
            d = back[:, k * FILTERS:(k + 1) * FILTERS]
            # only the place of the largest response has a slope
            step = np.empty_like(taps)
            for place in range(len(taps)):
                at = x[rows, best + place].astype(np.int64) * FILTERS + every
                step[place] = np.bincount(at.ravel(), d.ravel(), (PAD + 1) * FILTERS).reshape(PAD + 1, FILTERS)
            step[:, PAD] = 0
            d_taps.append(step)
            d_bias.append(d.sum(axis=0))
        return [*d_taps, *d_bias, h.T @ error, error.sum(axis=0)]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 16, size: int = 64, rate: float = 0.01, seed: int = 12) -> None:
        """Adam over shuffled batches.  Half of the windows of each epoch are
        cut to a random shorter length, so short texts are known too."""
        rnd = np.random.default_rng(seed)
        weights = self.weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        for epoch in range(epochs):
            order = rnd.permutation(len(x))
            keep = np.where(rnd.random(len(x)) < 0.5, rnd.integers(8, WINDOW + 1, len(x)), WINDOW)
            for at in range(0, len(x), size):
                own = order[at:at + size]
                shown = np.where(np.arange(WINDOW)[None, :] < keep[own, None], x[own], PAD).astype(x.dtype)
                step += 1
                pace = rate * (1 - epoch / epochs) * math.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for w, g, m, v in zip(weights, self.gradients(shown, y[own]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        self.pairs = []

    def _tables(self) -> list:
        """Per width: tables by byte pair, and the odd last place's by byte."""
        if not self.pairs:
            for taps in self.taps:
                two = [(taps[k][:, None, :] + taps[k + 1][None, :, :]).reshape(-1, FILTERS) for k in range(0, len(taps) - 1, 2)]
                self.pairs.append((two, taps[-1] if len(taps) % 2 else None))
        return self.pairs

    def score(self, x: np.ndarray, at_once: int = 256) -> np.ndarray:
        """Log-probabilities of the languages for each window."""
        out = np.empty((len(x), len(self.languages)), np.float32)
        for a in range(0, len(x), at_once):
            own = x[a:a + at_once].astype(np.int32)
            two = own[:, :-1] * (PAD + 1) + own[:, 1:]
            pooled = []
            for width, bias, (tables, last) in zip(WIDTHS, self.bias, self._tables()):
                spots = WINDOW - width + 1
                response = tables[0].take(two[:, :spots], axis=0)
                for k, table in enumerate(tables[1:], 1):
                    response += table.take(two[:, 2 * k:2 * k + spots], axis=0)
                if last is not None:
                    response += last.take(own[:, width - 1:width - 1 + spots], axis=0)
                pooled.append(np.maximum(response.max(axis=1) + bias, 0))
            out[a:a + at_once] = self.log_softmax(np.concatenate(pooled, axis=1))
        return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover all bytes of each text (neighbours share one byte
    less than the widest filter, so no run of bytes is cut), each text's
    offsets into them, and the bytes each window holds."""
    stride = WINDOW - max(WIDTHS) + 1
    size = np.diff(offsets)
    count = np.where(size > 0, 1 + np.maximum(size - WINDOW + stride - 1, 0) // stride, 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    starts = np.repeat(offsets[:-1] - ends[:-1] * stride, count) + np.arange(ends[-1]) * stride
    held = np.minimum(np.repeat(offsets[1:], count) - starts, WINDOW)
    return fill(data, starts, held), ends, held


def fill(data: np.ndarray, starts: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The ``held`` bytes from each start, padded to a window."""
    if not len(starts):
        return np.zeros((0, WINDOW), np.uint16)
    places = np.arange(WINDOW)[None, :]
    at = np.minimum(starts[:, None] + places, len(data) - 1)
    return np.where(places < held[:, None], data[at], np.uint16(PAD)).astype(np.uint16)


def _held_out(id_col: F.Column, folds: int, fold: int) -> F.Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds == fold


def train(labelled: DataFrame, sample_windows: int = 6000, per_text_windows: int = 4, max_languages: int = 256) -> Net | None:
    """A network trained on rows (doc_id, text, lang) with a non-null language.

    The sample is bounded by ``sample_windows`` (expected number, shared evenly
    by the languages, at most ``per_text_windows`` of a text, at places drawn over
    the whole text) and by ``max_languages``, the most frequent ones.  Rows
    are drawn by a hash of id and text.  ``None`` without labelled texts that
    have a letter.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not found:
        return None
    quota = sample_windows / per_text_windows / len(found)
    share = F.create_map(*[F.lit(v) for r in found for v in (r["lang"], min(1.0, quota / r["n"]))])
    drawn = (F.xxhash64("doc_id", "text", F.lit(3)) / F.lit(2.0 ** 64) + 0.5) < F.try_element_at(share, F.col("lang"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=1):
            data, offsets = raw_bytes(texts(batch.column(1)))
            size = np.diff(offsets)
            n = np.minimum(per_text_windows, -(-size // WINDOW))
            own = np.repeat(np.arange(len(size)), n)
            # places by a hash of the draw's number and the text's size
            part = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0, np.int64)
            room = np.maximum(size[own] - WINDOW, 0) + 1
            shift = (part * 2654435761 + size[own] * 40503) % room
            starts = offsets[own] + shift
            x = fill(data, starts, np.minimum(offsets[own + 1] - starts, WINDOW))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array([w.tobytes() for w in x], pa.binary())],
                                             ["lang", "x"])

    rows = sorted(tuple(r) for r in labelled.where(drawn).select("lang", "text").mapInArrow(run, "lang string, x binary").collect())
    languages = sorted(r["lang"] for r in found)
    if not rows:
        return None
    number = {lang: k for k, lang in enumerate(languages)}
    net = Net(languages)
    net.train(np.stack([np.frombuffer(bytes(x), np.uint16) for _, x in rows]), np.array([number[lang] for lang, _ in rows]))
    return net


def identify(docs: DataFrame, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", **sample) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Training uses the rows whose crc32(id as text) modulo ``folds`` is not
    ``fold`` (a null id counts as an empty text) and that have a language;
    prediction reads the text alone, all of it.  ``score`` is the softmax
    probability of ``lang_pred``.  A null text, or one without a letter, is
    ``und`` with score 0, as is every text when there is nothing to learn from.
    Repeated rows get equal results; ties go to the first language by name.  An
    empty table gives an empty result.  Other columns are not read.
    """
    rows = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string", lang=f"{lang_col}:string")
    net = train(rows.where(~_held_out(F.col("doc_id"), folds, fold)), **sample)

    def run(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(batch_rows, text=2, max_bytes=4 << 20):
            n = batch.num_rows
            text = texts(batch.column(2))
            known = pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False)
            pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if net is not None and known.any():
                x, ends, held = windows(*raw_bytes(text))
                each = net.score(x) * held[:, None].astype(np.float64)
                sums = np.concatenate([np.zeros((1, each.shape[1])), np.cumsum(each, axis=0)])
                mean = (sums[ends[1:]] - sums[ends[:-1]])[known] / per_text(held, ends)[known][:, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                pred[known] = np.array(net.languages, object)[best]
                score[known] = p[np.arange(len(p)), best]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", _held_out(F.col("doc_id"), folds, fold).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
