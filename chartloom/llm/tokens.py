"""Splitting texts into words and encoding words with a public tokenizer, batch-wise."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
CACHE_WORDS = 400_000


def slices(batch: pa.RecordBatch, text_column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text, so that memory is bounded by the longest text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes):
        if size + n > limit and i > start:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def words_of(texts: pa.Array, line_end: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, position -> word number, text -> first position; one more at the end).

    A word is what stands between single spaces once ``line_end`` is put for every newline.
    Null texts are empty and have one empty word.
    """
    lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", line_end), " ")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return coded.dictionary, coded.indices.to_numpy(), offsets


class WordEncoder:
    """Ids of words by the tokenizers library; each word is encoded once while it is cached.

    ``plain`` is for words that the vocabulary's normaliser and splitter leave as they are:
    it spares them both.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, *, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        if plain:
            self._tokenizer.normalizer = normalizers.Sequence([])
            self._tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._cache: dict[str, bytes] = {}
        self._limit = cache_words

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        encoded = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def clear(self) -> None:
        """Forget the words encoded so far."""
        self._cache.clear()

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order of the words, ids per word)."""
        cache = self._cache
        fresh = [w for w in words if w not in cache]
        if fresh:
            if len(cache) + len(fresh) > self._limit:
                cache.clear()
                fresh = words
            for at in range(0, len(fresh), 10_000):
                part = fresh[at : at + 10_000]
                cache.update(zip(part, self.encode(part), strict=True))
        found = [cache[w] for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4"), counts


def gather(flat: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the runs ``which`` of ``flat`` (run r has counts[r] values); also where each ends."""
    starts = np.cumsum(counts) - counts
    lengths = counts[which]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[which] - (ends - lengths), lengths) + np.arange(total)
    return flat[at], ends
