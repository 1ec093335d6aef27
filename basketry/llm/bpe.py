"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Every pre-token is a row of symbols.  The leaves of its segment tree hold the
merge rank of each adjacent pair (rank and position in one integer, so the
minimum is the leftmost pair of lowest rank).  The root names the next merge;
the merge changes three leaves, each updated along its path to the root, until
the root holds no mergeable pair.  Rows of one size class run through these
steps together as array operations, and each distinct pre-token of a batch is
merged once.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from basketry.llm.common import batches, encode, pick, spread, split_words, texts, tokenizer_path

_NONE = np.int64(2) ** 62
_POS = np.int64(2) ** 32 - 1
_ROWS = 1 << 21


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class Merges:
    """Vocabulary, merge ranks and pre-tokenizer of a word-end BPE tokenizer file."""

    _cache: dict[str, "Merges"] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"]:
            raise ValueError("a BPE file with a word-end suffix is needed")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.made = np.zeros(len(model["merges"]), np.int64)
        for rank, new in pairs.values():
            self.made[rank] = new
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**vocab, **self.special}.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \x0b cannot stand in a chunk (chunks hold no ASCII white space): it marks special tokens
        self.pieces = regex.compile(f"\x0b[0-9]+\x0b|\n|{split['pattern']['Regex']}")
        self.find_special = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None

    @classmethod
    def load(cls, path: str) -> "Merges":
        if path not in cls._cache:
            cls._cache[path] = cls(path)
        return cls._cache[path]

    def pretokens(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of white-space-free chunks, and how many each chunk has.

        Normalization (NFC, lower case by character) and the split never look
        across white space, so a text's pre-tokens are those of its chunks.
        """
        joined = "\n".join(chunks)
        if self.find_special and self.find_special.search(joined):
            joined = self.find_special.sub(lambda m: f"\x0b{self.special[m[0]]}\x0b", joined)
        joined = unicodedata.normalize("NFC", joined)
        found = self.pieces.findall(joined.replace("Σ", "σ").lower())
        breaks = np.fromiter((p == "\n" for p in found), bool, len(found))
        counts = np.diff(np.concatenate([[-1], np.flatnonzero(breaks), [len(found)]])) - 1
        return [p for p in found if p != "\n"], counts

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE >> 32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens, concatenated, and each one's number of ids."""
        special = np.array([w[0] == "\x0b" for w in words], bool) if words else np.zeros(0, bool)
        raw = [b"" if s else w.encode() for w, s in zip(words, special)]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.inner[data]
        ends = np.cumsum(lengths)
        full = lengths > 0
        ids[ends[full] - 1] = self.last[data[ends[full] - 1]]
        starts = ends - lengths
        counts = np.where(special, 1, lengths)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        classes = np.zeros(len(words), np.int64)
        classes[lengths > 1] = np.ceil(np.log2(np.maximum(lengths[lengths > 1] - 1, 1))).astype(np.int64) + 1
        for c in np.unique(classes[lengths > 1]):
            rows = np.flatnonzero((classes == c) & (lengths > 1))
            size = 1 << int(c - 1)
            step = max(1, _ROWS // (4 * size))
            for k in range(0, len(rows), step):
                some = rows[k:k + step]
                got, n = self._merge_class(ids, starts[some], lengths[some], size)
                counts[some] = n
                parts.append((some, got, n))
        out = np.zeros(int(counts.sum()), np.int64)
        at = np.cumsum(counts) - counts
        single = np.flatnonzero(lengths == 1)
        out[at[single]] = ids[starts[single]]
        for k in np.flatnonzero(special):
            out[at[k]] = int(words[k][1:-1])
        for some, got, n in parts:
            out[spread(at[some], n)] = got
        return out, counts

    def _merge_class(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                     size: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of 2 to ``size`` + 1 symbols; their trees have ``size`` leaves."""
        n, width, depth = len(starts), size + 1, size.bit_length() - 1
        symbol = np.full((n, width + 1), -1, np.int64)
        where = np.repeat(np.arange(n), lengths) * (width + 1) + spread(np.zeros(n, np.int64), lengths)
        symbol.reshape(-1)[where] = ids[spread(starts, lengths)]
        after = np.tile(np.arange(1, width + 2, dtype=np.int64), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int64), (n, 1))
        tree = np.full((n, 2 * size), _NONE, np.int64)
        pair = (symbol[:, :size] >= 0) & (symbol[:, 1:size + 1] >= 0)
        r, p = np.nonzero(pair)
        rank = self.rank(symbol[r, p], symbol[r, p + 1])
        tree[r, size + p] = np.where(rank < _NONE >> 32, rank << 32 | p, _NONE)
        for level in range(depth - 1, -1, -1):
            low = 1 << level
            tree[:, low:2 * low] = np.minimum(tree[:, 2 * low:4 * low:2], tree[:, 2 * low + 1:4 * low:2])
        flat, sym, aft, bef = tree.reshape(-1), symbol.reshape(-1), after.reshape(-1), before.reshape(-1)
        live = np.arange(n)
        while True:
            top = flat[live * (2 * size) + 1]
            live, top = live[top < _NONE], top[top < _NONE]
            if not len(live):
                break
            pos, made = top & _POS, self.made[top >> 32]
            base = live * (width + 1)
            gone = aft[base + pos]
            right = aft[base + gone]
            left = bef[base + pos]
            sym[base + pos] = made
            sym[base + gone] = -1
            aft[base + pos] = right
            bef[base + np.minimum(right, width)] = pos
            root = live * (2 * size)
            changed = [gone]
            flat[root + size + np.minimum(gone, size - 1)] = np.where(
                gone < size, _NONE, flat[root + size + np.minimum(gone, size - 1)])
            after_symbol = sym[base + np.minimum(right, width)]
            rank = self.rank(made, after_symbol)
            flat[root + size + pos] = np.where((after_symbol >= 0) & (rank < _NONE >> 32), rank << 32 | pos, _NONE)
            changed.append(pos)
            has_left = left >= 0
            lpos = np.maximum(left, 0)
            rank = self.rank(sym[base + lpos], made)
            leaf = root + size + lpos
            flat[leaf] = np.where(has_left, np.where(rank < _NONE >> 32, rank << 32 | lpos, _NONE), flat[leaf])
            changed.append(lpos)
            nodes = [np.minimum(x, size - 1) + size for x in changed]
            for _ in range(depth):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    flat[root + x] = np.minimum(flat[root + 2 * x], flat[root + 2 * x + 1])
        kept = symbol >= 0
        return symbol[kept], kept.sum(1)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks, concatenated, and each chunk's offsets into them."""
        pieces, per_chunk = self.pretokens(chunks)
        codes: dict[str, int] = {}
        which = np.fromiter((codes.setdefault(p, len(codes)) for p in pieces), np.int64, len(pieces))
        ids, counts = self.merge(list(codes))
        at = np.cumsum(counts) - counts
        out = ids[spread(at[which], counts[which])] if len(which) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(counts[which])])
        return out, ends[np.concatenate([[0], np.cumsum(per_chunk)])]

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text (null: empty)."""
        words, _ = split_words(pa.array([text or ""], pa.string()))
        return self.encode_chunks(words.to_pylist())[0].tolist() if len(words) else []

    def decode(self, ids) -> str:
        """The token strings, joined by a space (the file names no decoder)."""
        return " ".join(self.tokens[int(i)] for i in ids)


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", keep_ids: bool = False, keep_decoded: bool = False) -> DataFrame:
    """Ids and decoded text of every row: n_tokens, ids_sha256, decoded_sha256.

    One row per input row.  ``keep_ids`` adds ``ids`` (array<int>),
    ``keep_decoded`` adds ``decoded`` (string).  A null or empty text has no token; both digests are
    then those of the empty string.  Repeated rows are encoded each; an id may
    be null.  Other columns of the input are not read.
    """
    path = path or tokenizer_path()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>"
    if keep_decoded:
        schema += ", decoded string"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges.load(path)
        for batch in batches(rows, text=1):
            words, offsets = split_words(texts(batch.column(1)))
            codes, vocabulary = encode(words)
            ids, at = merges.encode_chunks(vocabulary.to_pylist()) if len(vocabulary) else (
                np.zeros(0, np.int64), np.zeros(1, np.int64))
            n = np.diff(at)
            numbers, strings = [], []
            for k in range(len(vocabulary)):
                own = ids[at[k]:at[k + 1]].tolist()
                numbers.append(" ".join(map(str, own)))
                strings.append(merges.decode(own))
            if len(n) and not n.all():  # chunks of Unicode spaces have no token
                some = n[codes] > 0
                offsets = np.concatenate([[0], np.cumsum(some)])[offsets]
                codes = codes[some]
            counts = np.concatenate([[0], np.cumsum(n[codes])])[offsets] if len(n) else np.zeros(len(offsets), np.int64)
            seq, ends = codes.tolist(), offsets.tolist()
            digests: tuple[list, list] = ([], [])
            decoded = []
            for a, b in zip(ends, ends[1:]):
                own = seq[a:b]
                digests[0].append(hashlib.sha256(" ".join([numbers[c] for c in own]).encode()).hexdigest())
                text = " ".join([strings[c] for c in own])
                digests[1].append(hashlib.sha256(text.encode()).hexdigest())
                if keep_decoded:
                    decoded.append(text)
            out = [batch.column(0).cast(pa.int64()), pa.array(np.diff(counts)), pa.array(digests[0], pa.string()),
                   pa.array(digests[1], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                flat = ids[spread(at[codes], n[codes])] if len(codes) else np.zeros(0, np.int64)
                out.append(pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), pa.array(flat.astype(np.int32))))
                names.append("ids")
            if keep_decoded:
                out.append(pa.array(decoded, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(out, names)

    return pick(docs, doc_id=f"{id_col}:long", text=f"{text_col}:string").mapInArrow(run, schema)
