"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders (slots), other words their
lower-case core; punctuation falls away.  A unit glued to a number (15%, 5kg, £5,
5-year) is a slot of its own; a name or number of several words (John Smith,
twenty five, 5 million) is one slot.  Windows of canonical words are
hash-joined with the benchmark's windows.  Windows of one document that lie on
one diagonal of one item are read together: a slot value of the item must stand
for one value of the document throughout, else its windows do not count.  So a
question with other numbers or names is still caught, and a chance match of
slots is not.  A window of almost only slots says nothing as a template: with
fewer than ``LITERAL`` different literal words (also in a short item) it is
matched by its words and values instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import batches, encode, materialise, mix, owners, pick, split_words, spread, texts

WINDOW = 8
COVERED = 13
#: windows with fewer different literal words are matched by their values
LITERAL = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)

# fixed values: unit words that count as units after a number
UNITS = ["%", "cm", "days", "dollars", "eur", "euros", "feet", "ft", "g", "gb", "grams", "hours", "hz", "inches", "kb",
         "kg", "kilograms", "kilometers", "km", "kwh", "l", "lb", "lbs", "liters", "m", "mb", "meters", "mg", "miles",
         "minutes", "ml", "mm", "months", "mph", "ms", "percent", "pounds", "seconds", "tb", "usd", "volts", "watts",
         "weeks", "years", "°c", "°f", "£", "€", "$", "¥", "‰", "°", "cent", "cents", "centimeter", "day", "dollar", "euro", "foot",
         "gram", "hour", "inch", "kilogram", "kilometer", "liter", "meter", "mile", "minute", "month", "pound", "second", "volt",
         "watt", "week", "year"]
# fixed values: number words
NUMBERS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
           "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty",
           "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion"]
_TRIM = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "%") + "“”‘’«»…–—"
_WORDED = "|".join(NUMBERS)
_NUMBER = rf"^([0-9]+([.,:/–-][0-9]+)*(st|nd|rd|th)?|({_WORDED})(-({_WORDED}))*)$"
_NUMBER_WORD = rf"^({_WORDED})(-({_WORDED}))*$"
#: Smith, McDonald, O'Brien, Jean-Luc; words in capitals count apart
_NAME = r"^\p{Lu}(\p{L}+|['’]\p{Lu}\p{L}+)(['’-]\p{Lu}\p{L}+)*(['’]s)?$"
_CAPITALS = r"^\p{Lu}\p{Lu}+(['’]s)?$"
_GLUED = r"[0-9][%‰°£€$¥\p{L}-]|[£€$¥][0-9]"
_PARTS = re.compile(r"^(\W*?)([£€$¥]?)([0-9]+(?:[.,:/–-][0-9]+)*)(?:-?(°?[^\W\d_]+|[%‰°£€$¥])(?:-([^\W\d_][\w-]*))?)?(\W*)$")
WORD, NUM, NAME, UNIT = 0, 1, 2, 3


def _parts(word: str) -> list[str]:
    """A word with a unit glued to its number as number and unit (and rest: 5-year-old), else the word."""
    m = _PARTS.match(word)
    if not m or not (m[2] or m[4] and m[4].lower() in UNITS):
        return [word]
    if m[4] and m[4].lower() not in UNITS:
        return [word]
    out = [m[1] + m[3], *([m[2]] if m[2] else []), *([m[4]] if m[4] else []), *([m[5]] if m[5] else [])]
    return out[:-1] + [out[-1] + m[6]]


def _unglued(words: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes, distinct words and offsets after ``_parts``."""
    codes, raw = encode(words)
    some = np.flatnonzero(pc.match_substring_regex(raw, _GLUED).to_numpy(zero_copy_only=False))
    parts = {k: p for k, p in zip(some.tolist(), map(_parts, raw.take(pa.array(some)).to_pylist())) if len(p) > 1}
    if not parts:
        return codes, raw, offsets
    pieces = sorted({x for p in parts.values() for x in p})
    number = {x: len(raw) + k for k, x in enumerate(pieces)}
    size = np.ones(len(raw), np.int64)
    for k, p in parts.items():
        size[k] = len(p)
    start = np.cumsum(size) - size
    flat = np.repeat(np.arange(len(raw)), size)
    for k, p in parts.items():
        flat[start[k]:start[k] + len(p)] = [number[x] for x in p]
    out = flat[spread(start[codes], size[codes])]
    offsets = np.concatenate([[0], np.cumsum(size[codes])])[offsets]
    # a piece may equal a word: one code for both
    once, all_words = encode(pa.concat_arrays([raw, pa.array(pieces, pa.string())]))
    return once[out], all_words, offsets


def _collapsed(follows: np.ndarray, codes: np.ndarray, cores: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Runs of words that follow on as one: places kept, their codes and the cores with the runs' texts."""
    kept = np.flatnonzero(~follows)
    size = np.diff(np.append(kept, len(follows)))
    longer = np.flatnonzero(size > 1)
    values = cores.take(pa.array(codes[spread(kept[longer], size[longer])])).to_pylist()
    ends = np.cumsum(size[longer]).tolist()
    joined = pa.array([" ".join(values[b - n:b]) for b, n in zip(ends, size[longer].tolist())], pa.string())
    own, runs = encode(joined)
    out = codes[kept]
    out[longer] = len(cores) + own
    return kept, out, pa.concat_arrays([cores, runs])


def canonical(text: pa.Array, names: pa.Array, known: pa.Array | None = None, collapse: bool = True) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Canonical words of the texts: owner, hash, hash of the word itself, kind,
    code of the lower-case core, cores.

    A capitalised word inside a sentence is a name; at a sentence's start, or in
    lower case, a word is a name if ``names`` has it.  With ``known`` (the words
    of the benchmark) a capitalised word that it lacks is a name at a sentence's
    start too: as a word it could match nothing.  A word in capitals is a name if
    no word beside it is in capitals.  A unit is a unit word after a number.  With
    ``collapse`` names without punctuation between them are one name, and number
    words after a number are one number with it.
    """
    codes, raw, offsets = _unglued(*split_words(text))
    own = owners(offsets)
    core = pc.utf8_trim(raw, characters=_TRIM)
    core = pc.if_else(pc.is_in(raw, pa.array(["$"])), raw, core)
    low = pc.utf8_lower(core)
    empty = pc.equal(pc.binary_length(core), 0).to_numpy(zero_copy_only=False)
    number = pc.match_substring_regex(low, _NUMBER).to_numpy(zero_copy_only=False)
    worded = pc.match_substring_regex(low, _NUMBER_WORD).to_numpy(zero_copy_only=False)
    unit = pc.is_in(low, pa.array(UNITS)).to_numpy(zero_copy_only=False)
    capitals = pc.match_substring_regex(core, _CAPITALS).to_numpy(zero_copy_only=False)
    title = pc.match_substring_regex(core, _NAME).to_numpy(zero_copy_only=False) & ~capitals
    listed = pc.is_in(low, names).to_numpy(zero_copy_only=False)
    ends = pc.match_substring_regex(raw, r"[.?!:]['\")\]”’»]*$").to_numpy(zero_copy_only=False)
    broken = pc.match_substring_regex(raw, r"[.?!:;,)\]}]['\")\]”’»]*$").to_numpy(zero_copy_only=False)
    opened = pc.match_substring_regex(raw, r"^['\"(\[{“‘«]").to_numpy(zero_copy_only=False)
    low_codes, cores = encode(low)
    starts = np.ones(len(codes), bool)
    if len(codes):
        starts[1:] = (own[1:] != own[:-1]) | ends[codes[:-1]]
    kept = ~empty[codes] if len(codes) else np.zeros(0, bool)
    codes, own, starts = codes[kept], own[kept], starts[kept]
    kind = np.zeros(len(codes), np.int8)
    big = capitals[codes]
    lone = big.copy()
    if len(codes) > 1:
        lone[1:] &= ~(big[:-1] & (own[1:] == own[:-1]))
        lone[:-1] &= ~(big[1:] & (own[1:] == own[:-1]))
    kind[(title[codes] & ~starts) | lone | listed[codes]] = NAME
    if known is not None:
        new = title & ~pc.is_in(low, known).to_numpy(zero_copy_only=False)
        kind[new[codes]] = NAME
    kind[number[codes]] = NUM
    follows = np.zeros(len(codes), bool)
    if collapse and len(codes) > 1:
        joins = (own[1:] == own[:-1]) & ~broken[codes[:-1]] & ~opened[codes[1:]] & (kind[1:] == kind[:-1])
        follows[1:] = joins & ((kind[1:] == NAME) | ((kind[1:] == NUM) & worded[codes[1:]]))
    kept, core_codes, cores = _collapsed(follows, low_codes[codes], cores)
    own, codes, kind = own[kept], codes[kept], kind[kept]
    if len(codes) > 1:
        after = np.flatnonzero(unit[codes[1:]] & (kind[:-1] == NUM) & (own[1:] == own[:-1])) + 1
        kind[after] = UNIT
    text_hash = pd.util.hash_array(np.array(cores.to_pylist(), dtype=object), categorize=False) if len(cores) else (
        np.zeros(0, np.uint64))
    h = mix(text_hash[core_codes].astype(np.uint64) if len(codes) else np.zeros(0, np.uint64))
    value = h.copy()
    for k in (NUM, NAME, UNIT):
        h[kind == k] = mix(np.array([k], np.uint64))
    return own, h, value, kind, core_codes, cores


def window_hashes(own: np.ndarray, h: np.ndarray, value: np.ndarray, literal: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``size`` words inside one text: of its
    template, or of its values if it has fewer than ``LITERAL`` different literal words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    back = np.full(len(h), size, np.int8)  # words back to the last equal one
    for k in range(size - 1, 0, -1):
        back[k:][h[k:] == h[:-k]] = k
    key, exact, words = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int8)
    for k in range(size):
        key = key * _STEP + h[k:n + k]
        exact = exact * _STEP + value[k:n + k]
        words += literal[k:n + k] & (back[k:n + k] > k)
    at = np.flatnonzero(own[:n] == own[size - 1:])
    return at, mix(np.where(words[at] < LITERAL, ~mix(exact[at]), key[at]))


def _rows(own, h, value, kind, core, cores, size, wanted=None):
    """Windows as columns: owner, position in the text, hash, slots.  With
    ``wanted`` (sorted hashes) only those windows are kept."""
    first = np.searchsorted(own, np.arange(int(own[-1]) + 2)) if len(own) else np.zeros(1, np.int64)
    at, key = window_hashes(own, h, value, kind == WORD, size)
    if wanted is not None and len(key):
        filt = np.zeros(1 << 20, bool)
        filt[wanted >> np.uint64(44)] = True
        some = filt[key >> np.uint64(44)]
        at, key = at[some], key[some]
        where = np.minimum(np.searchsorted(wanted, key), max(len(wanted) - 1, 0))
        some = wanted[where] == key if len(wanted) else np.zeros(len(key), bool)
        at, key = at[some], key[some]
    place = spread(at, np.full(len(at), size))
    slot = kind[place] != WORD
    ends = np.concatenate([[0], np.cumsum(slot)])[np.arange(len(at) + 1) * size].astype(np.int32)
    names = np.array(["", "n", "p", "u"])
    values = cores.take(pa.array(core[place[slot]])) if len(place) else pa.array([], pa.string())
    typed = pc.binary_join_element_wise(pa.array(names[kind[place[slot]]].tolist(), pa.string()), values, ":")
    slots = pa.ListArray.from_arrays(pa.array(ends), typed)
    return own[at], at - first[own[at]] if len(at) else at, key.view(np.int64), slots


WINDOWS = "doc_id long, t long, pos long, h long, slots array<string>"


def _windows(docs: DataFrame, size: int, names: list[str], wanted: np.ndarray | None,
             known: list[str] | None = None) -> DataFrame:
    """Windows of ``docs`` (doc_id, t, text); every window if ``wanted`` is None."""
    held = docs.sparkSession.sparkContext.broadcast((names, wanted, known))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_, wanted_, known_ = held.value
        lexicon = pa.array(names_, pa.string())
        words = None if known_ is None else pa.array(known_, pa.string())
        for batch in batches(rows, text=2):
            own, pos, key, slots = _rows(*canonical(texts(batch.column(2)), lexicon, words), size, wanted_)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(pos),
                                              pa.array(key), slots], ["doc_id", "t", "pos", "h", "slots"])

    return docs.select("doc_id", "t", "text").mapInArrow(run, WINDOWS)


def _lexicon(items: DataFrame) -> DataFrame:
    """(word, name): the items' words in lower case; a name is capitalised inside
    a sentence of an item and in lower case in none."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=0):
            text = texts(batch.column(0))
            _, _, _, kind, core, cores = canonical(text, pa.array([], pa.string()), collapse=False)
            named = np.unique(core[kind == NAME])
            plain = pc.unique(pc.utf8_trim(split_words(text)[0], characters=_TRIM))
            lower = pc.filter(plain, pc.equal(plain, pc.utf8_lower(plain)))
            rest = np.setdiff1d(np.unique(core), named)
            words = pa.concat_arrays([cores.take(pa.array(named)), cores.take(pa.array(rest)), lower])
            flags = np.where(np.arange(len(words)) < len(named), 1, np.where(np.arange(len(words)) < len(named) + len(rest), 0, -1))
            yield pa.RecordBatch.from_arrays([words, pa.array(flags)], ["word", "name"])

    # 1: seen as a name, 0: seen at a sentence's start or otherwise, -1: seen in lower case
    found = items.select("text").mapInArrow(run, "word string, name long")
    return found.groupBy("word").agg(((F.max("name") == 1) & (F.min("name") >= 0)).alias("name"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, covered: int = COVERED,
          max_windows: int = 4_000_000) -> DataFrame:
    """(doc_id, t, item_id, n_windows, n_tokens, item_tokens, n_slots, exact), a
    row for each document that holds a benchmark passage, and no other.

    A passage is held if windows of ``window`` canonical words with consistent
    slots cover ``covered`` words of the item, or all of an item shorter than
    that; items shorter than a window are matched whole.  A window with fewer
    than ``LITERAL`` different literal words needs the item's values.  ``exact`` is true if
    every slot has the item's own value.  t is the hash of the document's text,
    so different rows of one id stay apart; equal rows give one row.  Null or
    empty texts and items without words match nothing.

    The benchmark's window hashes are broadcast if there are at most
    ``max_windows`` (8 bytes each); else every window takes part in the join.
    Its words are broadcast under the same bound; a benchmark with more
    is refused, to be passed in parts.
    """
    own = pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string").withColumn("t", F.xxhash64("text"))
    bench = materialise(pick(items, item_id=f"{item_col}:long", text=f"{item_text_col}:string").where(
        "text IS NOT NULL").distinct().withColumn("t", F.xxhash64("text")), "benchmark")
    lexicon = materialise(_lexicon(bench), "names")
    if lexicon.count() > max_windows:
        raise ValueError("the benchmark has too many words to broadcast; call leaks() for parts of it")
    known = {r["word"]: r["name"] for r in lexicon.collect()}
    names = sorted(w for w, name in known.items() if name)
    sized = materialise(_sizes(bench, names), "items")
    lengths = [r["w"] for r in sized.select(F.least("n", F.lit(window)).cast("int").alias("w")).distinct().collect() if r["w"]]
    found = None
    for size in sorted(lengths):
        of_size = bench.join(sized.where(F.least("n", F.lit(window)) == size).select("doc_id", "u"),
                             bench["item_id"].eqNullSafe(F.col("doc_id")) & (bench["t"] == F.col("u")), "left_semi")
        asked = materialise(_windows(of_size.withColumnRenamed("item_id", "doc_id"), size, names, None).select(
            F.col("doc_id").alias("item_id"), F.col("t").alias("item_t"), F.col("pos").alias("item_pos"), "h",
            F.col("slots").alias("item_slots")), "windows")
        few_windows = asked.count() <= max_windows
        wanted = np.unique(np.array([r[0] for r in asked.select("h").distinct().collect()], np.int64).view(np.uint64)) if (
            few_windows) else None
        hits = _windows(own, size, names, wanted, sorted(known)).join(asked, "h")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, t long, item_id long, n_windows long, n_tokens long, item_tokens long, n_slots long, exact boolean")
    found = found.withColumn("size", F.lit(window)) if lengths == [window] else found.join(
        sized.select(F.col("doc_id").alias("i"), F.col("u").alias("iu"), F.least("n", F.lit(window)).cast("int").alias("size")),
        F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_t") == F.col("iu"))).drop("i", "iu")
    found = materialise(found.where(F.size("slots") == F.size("item_slots")).withColumn(
        "diagonal", F.col("pos") - F.col("item_pos")).distinct(), "hits")
    place = ["doc_id", "t", "item_id", "item_t", "diagonal"]
    pairs = found.select(*place, "pos", "h", F.explode(F.arrays_zip("item_slots", "slots")).alias("z")).select(
        *place, "pos", "h", F.col("z.item_slots").alias("given"), F.col("z.slots").alias("value"))
    torn = pairs.groupBy(*place, "given").agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a <> b")
    bad = pairs.join(torn.select(*(F.col(c).alias(f"x_{c}") for c in [*place, "given"])),
                     _same([*place, "given"])).select(*(F.col(c).alias(f"y_{c}") for c in [*place, "pos"])).distinct()
    good = found.join(bad, _same([*place, "pos"], "y_"), "left_anti")
    whole = ["doc_id", "t", "item_id", "item_t"]
    tokens = good.select(*whole, F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + F.col("size") - 1)).alias("at"))
    cover = tokens.groupBy(*whole).agg(F.count_distinct("at").alias("n_tokens"))
    total = good.groupBy(*whole).agg(F.count("*").alias("n_windows"), F.sum(F.size("slots")).cast("long").alias("n_slots"),
                                     F.min((F.col("slots") == F.col("item_slots"))).alias("exact"))
    joined = total.join(cover.select(*(F.col(c).alias(f"x_{c}") for c in whole), "n_tokens"), _same(whole)).join(
        sized.select(F.col("doc_id").alias("i"), F.col("u").alias("iu"), F.col("n").alias("item_tokens")),
        F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_t") == F.col("iu")))
    return joined.where(F.col("n_tokens") >= F.least(F.col("item_tokens"), F.lit(covered))).select(
        "doc_id", "t", "item_id", "n_windows", "n_tokens", "item_tokens", "n_slots", "exact")


def _same(columns: list[str], mark: str = "x_"):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"{mark}{c}"))
    return out


def _sizes(items: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, u, n): canonical words of each item."""
    held = items.sparkSession.sparkContext.broadcast(names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, text=2):
            own, *_ = canonical(texts(batch.column(2)), pa.array(held.value, pa.string()))
            n = np.bincount(own, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], ["doc_id", "u", "n"])

    return items.select("item_id", "t", "text").mapInArrow(run, "doc_id long, u long, n long")
