"""Byte-level BPE encoding of whole columns of text with a public tokenizer's file.

Works on Arrow batches as flat arrays. Words are cut by comparing the classes of neighbouring characters,
equal words of a batch are found by sorting 64-bit keys (checked byte by byte), and only words not seen
before are merged: their symbols stand in one flat array, each round looks up all neighbouring pairs by
binary search over the sorted pair keys and merges each word's lowest-rank pair.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text worked on at once, and words kept between batches (then all are forgotten).
SLICE, KEPT = 4 << 20, 1 << 20
NONE = np.iinfo(np.int64).max
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The endings split off after an apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


def default_path() -> str:
    """Tokenizer file: GENOLOOM_TOKENIZER, or byte_bpe_50k.json in /opt/tokenizers."""
    return os.environ.get("GENOLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif kind[0] == "Z" or 9 <= c <= 13 or c == 0x85:
            out[c] = SPACE
    return out


def word_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words start. chars: code points of all texts; first: True where a text starts."""
    n = len(chars)
    kind = char_classes()[chars]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    ends_text = np.ones(n, bool)
    ends_text[:-1] = first[1:]
    white, blank = kind == SPACE, chars == 32
    start = run.copy()
    # A blank just before other characters belongs to them.
    joined = run & ~first & ~white
    joined[1:] &= blank[:-1]
    joined[:1] = False
    start[joined] = False
    # The last white space of several, where something follows, stands apart or joins what follows.
    last = white & ~ends_text
    last[:-1] &= ~white[1:]
    start |= last
    quote = np.flatnonzero(start & (chars == 39) & ~ends_text)
    if len(quote):
        padded = np.concatenate([chars, np.zeros(3, chars.dtype)])
        inside = np.concatenate([~first, np.zeros(3, bool)])  # the character belongs to the text before it
        a, b = padded[quote + 1], padded[quote + 2]
        one = inside[quote + 1] & np.isin(a, [ord(c) for c in ONE_LETTER])
        two = np.zeros(len(quote), bool)
        for x, y in TWO_LETTERS:
            two |= (a == ord(x)) & (b == ord(y))
        two &= inside[quote + 1] & inside[quote + 2]
        for which, size in ((one & ~two, 1), (two & ~one, 2)):
            at = quote[which]
            start[at + 1] = False
            after = at + 1 + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Tokenizer:
    """A byte-level BPE vocabulary (a ``tokenizers`` JSON file without normaliser or added prefix)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        # Files write bytes as characters: printable ones as they are, the others from 256 on.
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        as_char = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.byte_ids = np.array([vocab[as_char[b]] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        # A last key that no pair has, so that a search always ends at one.
        self.keys, self.ranks = np.append(keys[order], NONE), np.append(order.astype(np.int64), NONE)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one array, number of ids of each); no word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            key = (symbols[:-1] << 32) | symbols[1:]
            at = np.searchsorted(self.keys, key)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            each = np.repeat(least, np.diff(np.append(first, len(word))))
            over = each == NONE
            if over.any():
                done.append((word[over], symbols[over]))
                symbols, word, rank, each = symbols[~over], word[~over], rank[~over], each[~over]
                if not len(symbols):
                    break
            chosen = rank == each
            at = np.flatnonzero(chosen)
            # Of overlapping choices (a pair of equal symbols) every second one from the left is taken.
            group = np.concatenate([[True], at[1:] != at[:-1] + 1])
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(group, np.arange(len(at)), 0))
            at = at[place % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, symbols = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        return symbols[np.argsort(word, kind="stable")].astype(np.int32), np.bincount(word, minlength=len(words))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in flat, begin and size; words not known yet are merged and kept."""
        if len(self.known) > KEPT:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            ids, sizes = self.merge(new)
            self.known.update(zip(new, range(len(self.size), len(self.size) + len(new))))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
            self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word in data, index of each text's first word and the end); bounds: byte offsets of the texts."""
        raw = data.tobytes()
        text = raw.decode("utf-8", "surrogatepass")
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.zeros(len(chars), bool)
        if len(chars) == len(data):
            offset = None
            at = bounds[:-1]
        else:
            offset = np.flatnonzero((data & 0xC0) != 0x80)  # the byte where each character starts
            at = np.searchsorted(offset, bounds[:-1])
        first[at[at < len(chars)]] = True
        start = word_starts(chars, first)
        if offset is not None:
            start = offset[start]
        end = np.append(start[1:], len(data))
        size = end - start
        # 64-bit keys of the words from blocks of 8 bytes, and which words are equal.
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(padded.view(), (len(data) + 1, 8), (1, 1))
        masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

        def block(k: int, of: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray(eight[of + 8 * k]).view(np.uint64).ravel() & masks[np.minimum(sizes - 8 * k, 8)]

        short = size <= 64
        key = block(0, start, size) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(1, 8):
            more = np.flatnonzero((size > 8 * k) & short)
            if not len(more):
                break
            mixed = (key[more] ^ (key[more] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            key[more] = mixed + block(k, start[more], size[more])
        long = np.flatnonzero(~short)
        key[long] = np.uint64(2**63) + long.astype(np.uint64)  # each for itself
        _, where, same = np.unique(key, return_index=True, return_inverse=True)
        like = where[same]
        equal = size == size[like]
        for k in range(8):
            more = np.flatnonzero((size > 8 * k) & short & equal)
            if not len(more):
                break
            equal[more] = block(k, start[more], size[more]) == block(k, start[like[more]], size[more])
        number = self.numbers([raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist())])[same]
        odd = np.flatnonzero(~equal)
        if len(odd):
            number[odd] = self.numbers([raw[a:b] for a, b in zip(start[odd].tolist(), end[odd].tolist())])
        return number, np.searchsorted(start, bounds)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids start, and the end)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        number, at = self.words(data, bounds)
        size = self.size[number]
        upto = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.begin[number] - upto[:-1], size) + np.arange(upto[-1])
        return self.flat[place], upto[at]

    def count(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of ids of each text."""
        if not len(data):
            return np.zeros(len(bounds) - 1, np.int64)
        number, at = self.words(data, bounds)
        return np.diff(np.concatenate([[0], np.cumsum(self.size[number])])[at])


@lru_cache(2)
def load(path: str) -> Tokenizer:
    """The tokenizer, once per Python worker: at its path, or as the driver sent it where this machine has none there."""
    return Tokenizer(path if os.path.isfile(path) else SparkFiles.get(os.path.basename(path)))


def _parts(data: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Pieces of one very long text, cut before white space behind other characters, where a word always ends."""
    while end - begin > 2 * SLICE:
        cut, step = 0, begin + SLICE
        while not cut and step < end - 1:
            piece = data[step : min(step + SLICE, end)]
            ascii_space = (piece == 32) | ((piece >= 9) & (piece <= 13))
            solid = (piece > 32) & (piece < 127)
            at = np.flatnonzero(ascii_space[1:] & solid[:-1])
            cut, step = (step + int(at[0]) + 1 if len(at) else 0), step + SLICE
        if not cut:
            break
        yield begin, cut
        begin = cut
    yield begin, end


def slices(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, bool]]:
    """(bytes, offsets in them, first text, end text, whether it goes on the text before) of a column, about SLICE bytes each."""
    text = text.cast(pa.large_string()).fill_null("")
    if not len(text):
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    k = 0
    while k < len(text):
        to = max(k + 1, int(np.searchsorted(offsets, offsets[k] + SLICE, "right")) - 1)
        if to == k + 1:
            for n, (a, b) in enumerate(_parts(data, int(offsets[k]), int(offsets[to]))):
                yield data[a:b], np.array([0, b - a]), k, to, n > 0
        else:
            yield data[offsets[k] : offsets[to]], offsets[k : to + 1] - offsets[k], k, to, False
        k = to


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            held: list[tuple[int, int, list[np.ndarray], np.ndarray]] = []
            for data, bounds, a, b, goes_on in slices(batch.column(1)):
                ids, at = tokenizer.encode(data, bounds)
                if goes_on:
                    first, end, parts, _ = held.pop()
                    held.append((first, end, [*parts, ids], np.array([0, sum(map(len, parts)) + len(ids)])))
                    continue
                if held:
                    yield _ids_batch(batch, *held.pop())
                held.append((a, b, [ids], at))
            if held:
                yield _ids_batch(batch, *held.pop())

    return run


def _ids_batch(batch: pa.RecordBatch, a: int, b: int, parts: list[np.ndarray], at: np.ndarray) -> pa.RecordBatch:
    ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.concatenate(parts), pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["row_id", "ids"])


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            for data, bounds, a, b, _ in slices(batch.column(1)):
                counts[a:b] += tokenizer.count(data, bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], names=["row_id", "tokens"])

    return run


def _sent(df: DataFrame, path: str) -> str:
    """``path``, its file (a few megabytes) having been sent to the cluster's machines."""
    sc = df.sparkSession.sparkContext
    if os.path.isfile(path) and not sc.master.startswith("local"):
        sc.addFile(path)
    return path


def _two(df: DataFrame, row_id: str, text: str | Column) -> DataFrame:
    column = F.col(text) if isinstance(text, str) else text
    return df.select(F.col(row_id).cast("long").alias("row_id"), column.cast("string").alias("text"))


def encode(df: DataFrame, row_id: str, text: str | Column, path: str | None = None) -> DataFrame:
    """(row_id, ids array of int) of each row, special tokens never used; an empty list for null and empty text.

    Rows keep their number, repeated ones too; null row ids are kept; texts of any length are encoded
    whole; other columns are ignored; an empty table gives no rows. No shuffle: each input partition is
    encoded where it is read.
    """
    return _two(df, row_id, text).mapInArrow(_encoder(_sent(df, path or default_path())), "row_id long, ids array<int>").withColumnRenamed("row_id", row_id)


def token_counts(df: DataFrame, row_id: str, text: str | Column, path: str | None = None) -> DataFrame:
    """(row_id, tokens) of each row, as ``encode`` would give; 0 for null and empty text."""
    return _two(df, row_id, text).mapInArrow(_counter(_sent(df, path or default_path())), "row_id long, tokens long").withColumnRenamed("row_id", row_id)
