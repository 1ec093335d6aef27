"""Document quality: counts of the text itself and n-gram perplexity bands.

The language model is an interpolated modified Kneser-Ney model of the
characters of running text, one per language: words are joined by single spaces
and contexts run across them, so the order of words is judged.  It is counted by
Spark over all distinct texts and stored in sorted hash arrays.  Every language gets lower and upper perplexity bounds
(per character and per word) from the quartiles of its own texts; a
document outside is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import charmodel
from basketry.llm.common import (batches, encode, materialise, mix, owners, per_text, pick, raw_bytes, split_words,
                                 texts)

DEPTH = 4
#: least quartile distances of the two log-perplexities, about half of those of ordinary text
FLOOR = {"char": 0.05, "word": 0.5}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: words handled at once, to bound the arrays
_RUN = 1 << 18
#: bytes of text handled at once
_TEXT = 4 << 20


def _groups(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    d = texts(column).dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def _running(words: pa.Array, offsets: np.ndarray, column: pa.Array) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Per language: its texts with words, their code points and offsets."""
    lang, names = _groups(column)
    for g, name in enumerate(names):
        some = np.flatnonzero((lang == g) & (np.diff(offsets) > 0))
        if len(some):
            yield name, some, *charmodel.running(words, offsets, some)


def count_grams(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(grp, gram, c) over the running texts of ``docs`` (text, lang), summed by Spark."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=0, max_bytes=_TEXT):
            for name, _, points, ends in _running(*split_words(texts(batch.column(0))), batch.column(1)):
                for _, grams, counts in charmodel.running_grams(points, ends, depth):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts)],
                        ["grp", "gram", "c"])

    return docs.select("text", "lang").mapInArrow(run, "grp string, gram string, c long").groupBy("grp", "gram").agg(
        F.sum("c").alias("c"))


def kneser_ney(grams: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Interpolated modified Kneser-Ney tables (grams, contexts) of ``charmodel``.

    The logarithms are floats, as in the hash arrays, so joins with the tables
    score alike.  Discounts come from the counts of counts of each group and order; where one
    is zero, half the count is taken off, and every discount stays inside
    (0, count).
    """
    below, grams_out, contexts_out = None, None, None
    for level in charmodel.level_counts(grams, depth, continuation=True):
        level = materialise(charmodel.split_gram(level), "level")
        n = [F.sum((F.col("c") == k).cast("double")) for k in (1, 2, 3, 4)]
        stats = level.groupBy("grp").agg(*(x.alias(f"n{k + 1}") for k, x in enumerate(n)))
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        discounts = [F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0),
                            k - (k + 1) * y * F.col(f"n{k + 1}") / F.when(F.col(f"n{k}") > 0, F.col(f"n{k}")))
                     for k in (1, 2, 3)]
        stats = stats.select("grp", *(F.least(F.greatest(F.coalesce(d, F.lit(k / 2)), F.lit(0.1)), F.lit(k - 0.1)).alias(f"d{k}")
                                      for k, d in enumerate(discounts, 1)))
        own = level.join(stats, "grp").withColumn(
            "d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        context = own.groupBy("grp", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("off")).select(
            "grp", "ctx", "total", (F.col("off") / F.col("total")).alias("w"))
        joined = own.select("grp", "ctx", "sym", "c", "d").join(context, ["grp", "ctx"])
        if below is None:
            lower = joined.withColumn("p", F.lit(1.0 / charmodel.CODE_POINTS))
        else:
            lower = joined.withColumn("short", F.expr("substring(ctx, 2)")).join(
                below.select("grp", F.col("ctx").alias("short"), "sym", "p"), ["grp", "short", "sym"])
        below = materialise(lower.select("grp", "ctx", "sym", (
            (F.col("c") - F.col("d")) / F.col("total") + F.col("w") * F.col("p")).alias("p")), "probabilities")
        one = below.select("grp", "ctx", "sym", F.log10("p").cast("float").alias("logp"))
        two = context.select("grp", "ctx", F.log10("w").cast("float").alias("logw"))
        grams_out = one if grams_out is None else grams_out.union(one)
        contexts_out = two if contexts_out is None else contexts_out.union(two)
    return materialise(grams_out, "grams"), materialise(contexts_out, "contexts")


def _repeated(codes: np.ndarray, offsets: np.ndarray, size: int = 5) -> np.ndarray:
    """Per text: words in windows of ``size`` words that stand twice or more in it."""
    out, a = [np.zeros(0, np.int64)], 0
    while a < len(offsets) - 1:  # runs of texts with about _RUN words, or one longer text
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _RUN, side="right")) - 1)
        out.append(_repeated_run(codes[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size))
        a = b
    return np.concatenate(out)


def _repeated_run(codes: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    n = len(codes)
    if n < size:
        return np.zeros(len(offsets) - 1, np.int64)
    own = owners(offsets)
    h = mix(codes.astype(np.uint64) + np.uint64(1))
    key = mix(own[:n - size + 1].astype(np.uint64) + np.uint64(0x51ED270B))
    for k in range(size):
        key = key * _STEP + h[k:n - size + 1 + k]
    at = np.flatnonzero(own[:n - size + 1] == own[size - 1:])
    _, inverse, counts = np.unique(mix(key[at]), return_inverse=True, return_counts=True)
    hit = at[counts[inverse] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return per_text((np.cumsum(edge[:-1]) > 0).astype(np.int64), offsets)


def _repeated_lines(text: pa.Array) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    lists = pc.split_pattern(text, "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    codes, lines = encode(lists.flatten())
    worded = (pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0)
    own = owners(offsets)
    some = worded[codes]
    key, n = np.unique(own[some] * max(len(lines), 1) + codes[some], return_counts=True)
    return np.bincount(key // max(len(lines), 1), weights=n - 1, minlength=len(text)).astype(np.int64)


FEATURES = ("doc_id long, t long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, logp double")


def features(docs: DataFrame, model=None) -> DataFrame:
    """Counts of each row of ``docs`` (doc_id, t, lang, text); ``logp`` with a broadcast model."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=3, max_bytes=_TEXT):
            text = texts(batch.column(3))
            words, offsets = split_words(text)
            codes, vocabulary = encode(words)
            chars = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
            data, ends = raw_bytes(text)
            marks = np.diff(np.searchsorted(np.flatnonzero(_SYMBOL[data]), ends))
            logp = np.full(len(text), np.nan)
            if model is not None:
                logp[np.diff(offsets) == 0] = 0.0
                for name, some, points, starts in _running(words, offsets, batch.column(2)):
                    logp[some] = model.value.score_running(points, starts, name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), texts(batch.column(2)), pa.array(np.diff(offsets)),
                 pa.array(per_text(chars[codes], offsets)), pa.array(marks.astype(np.int64)),
                 pa.array(_repeated_lines(text)), pa.array(_repeated(codes, offsets)), pa.array(logp)],
                ["doc_id", "t", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "logp"])

    return docs.select("doc_id", "t", "lang", "text").mapInArrow(run, FEATURES)


def _logp_by_join(docs: DataFrame, grams: DataFrame, contexts: DataFrame, depth: int) -> DataFrame:
    """(doc_id, t, grp, joined_logp) without a broadcast model."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=3, max_bytes=_TEXT):
            for name, some, points, ends in _running(*split_words(texts(batch.column(3))), batch.column(2)):
                for text, own, counts in charmodel.running_grams(points, ends, depth, apart=True):
                    take = pa.array(some[text])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take).cast(pa.int64()), batch.column(1).take(take),
                         pa.array([name] * len(own), pa.string()), pa.array(own, pa.string()), pa.array(counts)],
                        ["doc_id", "t", "grp", "gram", "n"])

    counted = materialise(docs.select("doc_id", "t", "lang", "text").mapInArrow(
        run, "doc_id long, t long, grp string, gram string, n long"), "asked")
    copies = docs.groupBy("doc_id", "t", F.coalesce("lang", F.lit("")).alias("grp")).agg(F.count("*").alias("copies"))
    scored = charmodel.grams_by_join(counted.select("grp", "gram").distinct(), grams, contexts)
    summed = counted.join(scored, ["grp", "gram"]).groupBy("doc_id", "t", "grp").agg(
        F.sum(F.col("n") * F.col("logp")).alias("joined_logp"))
    same = [summed[c].eqNullSafe(copies[c]) for c in ("doc_id", "t", "grp")]
    return summed.join(copies, same[0] & same[1] & same[2]).select(
        summed["doc_id"].alias("d"), summed["t"].alias("u"), summed["grp"].alias("g"),
        (F.col("joined_logp") / F.col("copies")).alias("joined_logp"))


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """``docs`` (t, lang, text) with one row of each text and language; only texts that stand twice are shuffled."""
    copied = materialise(docs.groupBy("t", F.col("lang").alias("g")).agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("t").alias("u"), "g"), "copied")
    same = (F.col("t") == F.col("u")) & F.col("lang").eqNullSafe(F.col("g"))
    return docs.join(copied, same, "left_anti").unionByName(
        docs.join(copied, same, "left_semi").dropDuplicates(["t", "lang"]))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          spread: float = 5.0, even_words: int = 1000, depth: int = DEPTH, max_model_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, t (hash of the text), lang, the counts,
    base_failed, kept, and the perplexity per character (word ends included)
    and per word with the bounds that hold for the row (null without words).
    Both are of the running text: words in an unusual order raise them.

    base_failed: fewer than 10 words, or more than 20 % of them in repeated
    five-word windows.  A language's bounds are, for each of the two
    log-perplexities, its median plus and minus ``spread`` times the distance to
    the quartile on that side, scaled by sqrt(1/words + 1/even_words): a short
    text's average scatters more.  They are taken over the distinct texts that
    pass the base rules, and the distance is at least ``FLOOR``, so that neither
    copies nor near copies draw the bounds together; a value on a bound is kept.
    Null texts count as empty (base_failed), a null language is the empty one;
    repeated rows are judged each and count once in the model and in
    the bounds.  An empty table gives no rows.
    """
    own = pick(docs, doc_id=id_col, text=f"{text_col}:string", lang=f"{lang_col}:string").withColumns(
        {"t": F.xxhash64("text"), "lang": F.coalesce("lang", F.lit(""))})
    # each of an executor's workers holds a model: beyond ``max_model_bytes`` texts meet it by joins
    grams, contexts = kneser_ney(materialise(count_grams(_distinct_texts(own), depth), "counts"), depth)
    model = charmodel.collect_model(grams, contexts, depth, max_model_bytes)
    if model is not None:
        counted = features(own, docs.sparkSession.sparkContext.broadcast(model))
    else:
        scored = _logp_by_join(own, grams, contexts, depth)
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u")) & (F.col("lang") == F.col("g"))
        counted = features(own).join(scored, same, "left").withColumn(
            "logp", F.coalesce("joined_logp", F.lit(0.0))).drop("d", "u", "g", "joined_logp")
    worded = F.col("n_words") > 0
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = materialise(
        counted.withColumn("by_char", F.when(worded, -F.col("logp") / (F.col("word_chars") + F.col("n_words"))))
        .withColumn("by_word", F.when(worded, -F.col("logp") / F.col("n_words")))
        .withColumn("scale", F.when(worded, F.sqrt(1 / F.col("n_words") + F.lit(1 / even_words))))
        .withColumn("base_failed", failed).drop("logp"), "quality")
    good = counted.where(~F.col("base_failed")).select("lang", "t", "by_char", "by_word", "scale").dropDuplicates(["lang", "t"])
    quartile = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000))
    middle = good.groupBy("lang").agg(quartile("by_char")[1].alias("m_char"), quartile("by_word")[1].alias("m_word"))
    off = {m: (F.col(f"by_{m}") - F.col(f"m_{m}")) / F.col("scale") for m in ("char", "word")}
    bands = good.join(middle, "lang").groupBy("lang", "m_char", "m_word").agg(
        quartile(off["char"]).alias("q_char"), quartile(off["word"]).alias("q_word"))
    judged = counted.join(bands, "lang", "left")
    inside = F.lit(True)
    for m in ("char", "word"):
        # without documents that pass the base rules there are no quartiles and no bounds
        distance = {"lower": F.least(F.col(f"q_{m}")[0], F.lit(-FLOOR[m])), "upper": F.greatest(F.col(f"q_{m}")[2], F.lit(FLOOR[m]))}
        for side, d in distance.items():
            judged = judged.withColumn(f"{side}_{m}", F.col(f"m_{m}") + spread * F.col("scale") * d)
        inside = inside & F.coalesce(F.col(f"by_{m}").between(F.col(f"lower_{m}"), F.col(f"upper_{m}")), F.lit(False))
    ten = lambda c, name: F.pow(F.lit(10.0), c).alias(name)
    return judged.select(
        "doc_id", "t", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), ten("by_char", "perplexity"), ten("lower_char", "lower"),
        ten("upper_char", "upper"), ten("by_word", "word_perplexity"), ten("lower_word", "word_lower"),
        ten("upper_word", "word_upper"))
