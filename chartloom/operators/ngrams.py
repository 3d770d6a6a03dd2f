"""N-gram counts of batches of notes, each distinct word cut into windows once.

Tokens arrive as Arrow lists that generated code has split; words are numbered by the batch's dictionary, so
strings are touched once per distinct word and everything else is arithmetic on numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Token entries counted at once; bounds the memory of a task, whatever the batch.
SLICE_TOKENS = 400_000
# Runs of words give many more distinct terms than windows of characters, so few are met again in a longer slice.
SLICE_WORDS = 100_000
_WEIGHT_BITS = 20
# Padded words above this length are cut on their own.
LONG_WORD = 48
# Windows added up at once, save those of a note that has more; few enough to stay in the processor's cache.
_CHUNK = 1 << 18


class Counts(NamedTuple):
    """Occurrences per (note, term): rows by note, then term; ``terms`` are the distinct ones."""

    note: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    terms: pa.Array


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_TOKENS) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` tokens in a list column; a longer note is a run of its own."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held + n > limit and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's weights."""
    if not len(keys):
        return keys, weights
    if keys.max() < 1 << (62 - _WEIGHT_BITS) and weights.max() < 1 << _WEIGHT_BITS:
        both = np.sort(keys << _WEIGHT_BITS | weights)  # one plain sort in place of an indirect one
        keys, weights = both >> _WEIGHT_BITS, both & ((1 << _WEIGHT_BITS) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(weights, heads)


def _numbered(tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(note of each token, word number of each token, distinct words)."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    coded = tokens.flatten().dictionary_encode()
    return np.repeat(np.arange(len(tokens)), sizes), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _counts(keys: np.ndarray, tf: np.ndarray, terms: pa.Array) -> Counts:
    return Counts(keys // max(1, len(terms)), keys % max(1, len(terms)), tf, terms)


def _places(terms: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each term is in ``known``; -1 where it is not."""
    return pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy().astype(np.int64)


def word_counts(tokens: pa.ListArray, low: int, high: int, known: pa.Array | None = None) -> Counts:
    """Runs of ``low`` to ``high`` tokens, joined by a space; only those in ``known``, if given, numbered by their place in it."""
    note, word, words = _numbered(tokens)
    run, names = word, words
    notes, terms, kinds, start = [], [], [], 0
    for n in range(1, high + 1):
        if n > 1:
            inside = note[n - 1 :] == note[: len(note) - n + 1]
            pair = run[: len(inside)] * len(words) + word[n - 1 :]
            distinct, number = np.unique(pair[inside], return_inverse=True)
            names = pc.binary_join_element_wise(
                names.take(pa.array(distinct // max(1, len(words)))), words.take(pa.array(distinct % max(1, len(words)))), " "
            )
            # Positions whose run leaves its note get any number; they are cut off below and here.
            run = np.zeros(len(inside), np.int64)
            run[inside] = number
        at = np.flatnonzero(note[n - 1 :] == note[: len(note) - n + 1]) if n > 1 else np.arange(len(note))
        if n >= low:
            notes.append(note[at])
            terms.append(run[at] + start)
            kinds.append(names)
            start += len(names)
    joined = pa.concat_arrays([k.cast(pa.string()) for k in kinds])
    note, term = np.concatenate(notes), np.concatenate(terms)
    if known is not None:
        term, joined = _places(joined, known)[term], known
        note, term = note[term >= 0], term[term >= 0]
    return _counts(*_summed(note * len(joined) + term, np.ones(len(note), np.int64)), joined)


def _windows(words: pa.StringArray, low: int, high: int) -> tuple[np.ndarray, pa.Array]:
    """(word number, window) of every window of padded words that are not empty, in any order.

    Words are ordered by length, so those that reach a place are a run, cut at once; the few long ones are cut one by one.
    """
    padded = pc.binary_join_element_wise(" ", words.cast(pa.string()), " ", "")
    sizes = pc.utf8_length(padded).to_numpy().astype(np.int64)
    sizes[sizes == 2] = 0
    order = np.argsort(-sizes, kind="stable")
    n_long = int(np.count_nonzero(sizes > LONG_WORD))
    short = padded.take(pa.array(order[n_long:]))
    rising = np.sort(sizes[order[n_long:]])
    owners, pieces = [np.empty(0, np.int64)], [pa.array([], pa.string())]
    for n in range(low, high + 1):
        for i in range(int(rising[-1]) - n + 1 if len(rising) else 0):
            reach = len(rising) - int(np.searchsorted(rising, i + n))
            owners.append(order[n_long : n_long + reach])
            pieces.append(pc.utf8_slice_codeunits(short.slice(0, reach), i, i + n))
    for w in order[:n_long].tolist():
        text = padded[w].as_py()
        cut = [text[i : i + n] for n in range(low, high + 1) for i in range(len(text) - n + 1)]
        owners.append(np.full(len(cut), w))
        pieces.append(pa.array(cut, pa.string()))
    return np.concatenate(owners), pa.concat_arrays(pieces)


def char_counts(tokens: pa.ListArray, low: int, high: int, known: pa.Array | None = None) -> Counts:
    """Windows of ``low`` to ``high`` characters of each word with a space at both ends; empty words have none.

    Only those in ``known``, if given, numbered by their place in it.
    """
    note, word, words = _numbered(tokens)
    distinct, times = _summed(note * max(1, len(words)) + word, np.ones(len(word), np.int64))
    note, word = distinct // max(1, len(words)), distinct % max(1, len(words))
    owner, windows = _windows(words, low, high)
    coded = windows.dictionary_encode()
    gram, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if known is not None:
        gram, terms = _places(terms, known)[gram], known
        owner, gram = owner[gram >= 0], gram[gram >= 0]
    gram = gram[np.argsort(owner)]
    size = np.bincount(owner, minlength=len(words))
    start = np.cumsum(size) - size
    own = size[word]
    # Notes are added up a few at a time; their rows come in order, so the parts do too.
    heads = np.flatnonzero(np.diff(note, prepend=-1))
    part = (np.cumsum(own) - own)[heads] // _CHUNK
    cuts = [*heads[np.flatnonzero(np.diff(part, prepend=-1))].tolist(), len(note)]
    keys, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b in pairwise(cuts):
        n = own[a:b]
        at = np.repeat(start[word[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        some, tf = _summed(np.repeat(note[a:b] * len(terms), n) + gram[at], np.repeat(times[a:b], n))
        keys.append(some)
        sums.append(tf)
    return _counts(np.concatenate(keys), np.concatenate(sums), terms)
