"""BPE encoding and decoding through a table of distinct words.

Documents are read in chunks (a task's rows, cut where the chunk's vocabulary is full).
A chunk yields its distinct words, numbered, and its documents as word numbers by
position. Words of all chunks are brought together by word; each distinct word is encoded
once there, and its ids go back to the chunks that have it. A chunk then joins ids to
positions by word number, and pieces to ids by id, a block of documents at a time: a task
holds a chunk's word table and packed positions, but the ids and text of one block only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.blocks import packed, unpacked
from chartloom.llm.tokens import WordEncoder, gather, slices, words_of
from chartloom.session import materialize, ship_package

CHUNK_WORDS = 300_000
CHUNK_BYTES = 32 << 20
# What is cut into words at once, and what goes back to positions at once.
SLICE_BYTES = 2 << 20
BLOCK_DOCS = 1000
BLOCK_POSITIONS = 1 << 18
# White space as the tokenizer's pattern has it; Python's \s has four control characters more.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A word is a run of white space and what follows it up to the next one. No token runs from
# other text into white space, so the ids of words strung together are those of the text.
WORD = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+\\Z")
# What stands between single spaces, newlines having got a space before them, is such a word
# but for its space, unless it is one of these.
ODD = re.compile(f"\\A(?!\n[^{WHITE}])[{WHITE}]|[{WHITE}]\\Z|\\A\\Z")


def _slice_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, word number per position, first position per text (one more at the end)."""
    parts, at, offsets = words_of(texts, " \n")
    parts = parts.to_pylist()
    n = len(parts)
    odd = np.fromiter((ODD.search(w) is not None for w in parts), bool, n)
    irregular = np.add.reduceat(odd[at], offsets[:-1]) > 0
    # Part p is word p at the start of a text or of a line and word n + p after a space.
    after_space = np.fromiter((not w.startswith("\n") for w in parts), bool, n)[at]
    after_space[offsets[:-1]] = False
    codes = at + n * after_space.astype(np.int32)
    extra: dict[str, int] = {}
    runs = []
    for i, irregular_text in enumerate(irregular):
        if irregular_text:
            found = WORD.findall(texts[i].as_py() or "")
            runs.append(np.fromiter((2 * n + extra.setdefault(w, len(extra)) for w in found), np.int32, len(found)))
        else:
            runs.append(codes[offsets[i] : offsets[i + 1]])
    codes = np.concatenate(runs)
    seen = np.zeros(2 * n + len(extra), bool)
    seen[codes] = True
    used = np.flatnonzero(seen)
    numbers = (np.cumsum(seen, dtype=np.int32) - 1)[codes]
    more = list(extra)
    words = [parts[c] if c < n else " " + parts[c - n] if c < 2 * n else more[c - 2 * n] for c in used.tolist()]
    return words, numbers, np.concatenate(([0], np.cumsum([len(r) for r in runs])))


def _chunks(batches: Iterator[pa.RecordBatch], positions: bool) -> Iterator[tuple[int, dict[str, int], list]]:
    """(chunk, its words with their numbers, (doc_id, positions) of its documents if ``positions``).

    Both collections are emptied for the next chunk. Rows are (partition, doc_id, text).
    """
    part = chunk = size = rows_seen = 0
    numbers: dict[str, int] = {}
    docs: list = []
    for batch in batches:
        for rows in slices(batch, 2, SLICE_BYTES):
            part = rows.column(0)[0].as_py()
            words, at, offsets = _slice_words(rows.column(2))
            number = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
            if positions:
                at = number[at]
                docs += [
                    (doc, at[lo:hi])
                    for doc, lo, hi in zip(rows.column(1).to_pylist(), offsets, offsets[1:], strict=False)
                ]
            rows_seen += rows.num_rows
            size += rows.nbytes
            if len(numbers) >= CHUNK_WORDS or size >= CHUNK_BYTES:
                yield part << 24 | chunk, numbers, docs
                chunk, size, rows_seen = chunk + 1, 0, 0
                numbers.clear()
                docs.clear()
    if rows_seen:
        yield part << 24 | chunk, numbers, docs


def _bucket_rows(chunk: int, numbers: dict[str, int], buckets: int) -> list[tuple]:
    words: list[list[bytes]] = [[] for _ in range(buckets)]
    own: list[list[int]] = [[] for _ in range(buckets)]
    for word, number in numbers.items():
        data = word.encode("utf-8", "surrogatepass")
        b = crc32(data) % buckets
        words[b].append(data)
        own[b].append(number)
    rows = []
    for b in range(buckets):
        if own[b]:
            step = np.diff(np.array(own[b], np.int32), prepend=np.int32(0)).astype(np.int32)
            sizes = np.fromiter(map(len, words[b]), np.uint32, len(words[b]))
            text = np.frombuffer(b"".join(words[b]), np.uint8)
            rows.append((b, chunk, len(step), len(text), packed(step, sizes, text)))
    return rows


def _chunk_words(buckets: int):
    """A chunk's words, packed by hash bucket in order of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, numbers, _ in _chunks(batches, False):
            rows = _bucket_rows(chunk, numbers, buckets)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["bucket", "chunk", "n", "n_bytes", "block"],
                )

    return run


def _blocks(docs: list) -> Iterator[list]:
    """Runs of documents of at most ``BLOCK_DOCS`` and ``BLOCK_POSITIONS``, a longer document by itself."""
    start = size = 0
    for i, (_, positions) in enumerate(docs):
        if i > start and (i - start >= BLOCK_DOCS or size + len(positions) > BLOCK_POSITIONS):
            yield docs[start:i]
            start, size = i, 0
        size += len(positions)
    if docs:
        yield docs[start:]


def _chunk_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk, numbers, docs in _chunks(batches, True):
        for part in _blocks(docs):
            at = np.concatenate([p for _, p in part])
            block = packed(np.array([len(p) for _, p in part], np.int64), at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk]),
                    pa.array([len(numbers)], pa.int32()),
                    pa.array([[d for d, _ in part]], pa.list_(pa.int64())),
                    pa.array([len(at)]),
                    pa.array([block], pa.binary()),
                ],
                ["chunk", "n_words", "doc_ids", "n", "block"],
            )


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> WordEncoder:
    """One encoder a worker process: its next task finds the words of the last one."""
    return WordEncoder(vocabulary)


def _encode_words(vocabulary: str):
    """Ids of the words of a chunk and bucket, in their order; rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held = _encoder(vocabulary), None
        for batch in batches:
            for bucket, chunk, n, n_bytes, block in zip(
                *(batch.column(c).to_pylist() for c in ("bucket", "chunk", "n", "n_bytes", "block")), strict=True
            ):
                if bucket != held:
                    # No other bucket has these words.
                    encoder.clear()
                    held = bucket
                step, sizes, text = unpacked(block, ("<i4", n), ("<u4", n), ("u1", n_bytes))
                data, ends = text.tobytes(), np.cumsum(sizes, dtype=np.int64)
                words = [data[hi - k : hi].decode("utf-8", "surrogatepass") for k, hi in zip(sizes.tolist(), ends.tolist(), strict=True)]
                flat, counts = encoder.lookup(words)
                ids = flat.astype(np.uint32)
                out = packed(step, counts.astype(np.uint32), ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([n]), pa.array([len(ids)]), pa.array([out], pa.binary())],
                    ["chunk", "n", "n_ids", "block"],
                )
        encoder.clear()

    return run


def _join_positions(vocabulary: str, decoded: bool):
    """A chunk's blocks of documents with the ids of their words; rows without ``n_words`` are the chunk's words."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, numbers, counts, flat = [], [], [], []
        for batch in batches:
            for n_words, doc_ids, n, n_ids, block in zip(
                *(batch.column(c).to_pylist() for c in ("n_words", "doc_ids", "n", "n_ids", "block")), strict=True
            ):
                if n_words is not None:
                    texts.append((n_words, doc_ids, n, block))
                    continue
                step, count, ids = unpacked(block, ("<i4", n), ("<u4", n), ("<u4", n_ids))
                numbers.append(np.cumsum(step))
                counts.append(count)
                flat.append(ids)
        number = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        if {len(number)} != {n_words for n_words, *_ in texts}:
            raise RuntimeError(f"chunk {key[0]}: ids of {len(number)} words, not those of its documents; the documents changed")
        place = np.empty(len(number), np.int64)
        place[number] = np.arange(len(number))
        counts = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        for _, docs_of, n, block in texts:
            sizes, at = unpacked(block, ("<i8", len(docs_of)), ("<i4", n))
            ids, ends = gather(flat, counts, place[at])
            ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
            data = ids.tobytes()
            cuts = list(zip(ends.tolist(), ends[1:].tolist(), strict=False))
            columns = [pa.array(docs_of, pa.int64()), pa.array([data[4 * lo : 4 * hi] for lo, hi in cuts], pa.binary())]
            if decoded:
                columns.append(pa.array([_text(vocabulary, ids[lo:hi]) for lo, hi in cuts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][: len(columns)])

    return run


def encode(docs: DataFrame, vocabulary: str, *, stored: bool = False, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of (doc_id, text): ids as little-endian unsigned 32-bit integers.

    With ``decoded`` the column ``text`` follows, what ``decode`` makes of the ids, joined
    to their pieces where they arise.

    Equal to the tokenizers library's encoding of the whole text without special tokens
    added. Null texts are empty and have no ids; repeated rows are repeated. ``docs`` is
    read twice and must give the same rows in the same tasks both times, as a stored table
    does (``stored``); anything else is written to the shared folder first.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    docs = docs if stored else materialize(docs, "texts")
    # Both passes number their chunks by the partition of the table, not by the task that reads it.
    docs = docs.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    # A word's bucket is a hash of it, so equal words of all chunks meet in one task.
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = docs.mapInArrow(_chunk_words(buckets), "bucket int, chunk long, n int, n_bytes long, block binary")
    encoded = (
        words.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_words(vocabulary), "chunk long, n long, n_ids long, block binary")
    )
    texts = docs.mapInArrow(_chunk_docs, "chunk long, n_words int, doc_ids array<long>, n long, block binary")
    return (
        texts.unionByName(encoded, allowMissingColumns=True)
        .groupBy("chunk")
        .applyInArrow(_join_positions(vocabulary, decoded), "doc_id long, ids binary" + (", text string" if decoded else ""))
    )


def piece_table(vocabulary: str) -> list[bytes]:
    """Bytes of every id; its size is the vocabulary's."""
    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    # The byte-level alphabet maps these bytes to themselves, the others in
    # ascending order to code points from 256 on.
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(same)]
    byte = {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(others)}
    tokens = content["model"]["vocab"] | {t["content"]: t["id"] for t in content["added_tokens"]}
    pieces = [b""] * (max(tokens.values()) + 1)
    for token, i in tokens.items():
        pieces[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return pieces


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, text): each id joined with its piece, pieces strung together, read as UTF-8.

    Bytes that are not UTF-8 become U+FFFD. An id outside the vocabulary is an error.
    """
    ship_package(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1, 16 << 20):
                texts = []
                for block in rows.column(1).to_pylist():
                    ids = np.frombuffer(block or b"", "<u4")
                    texts.append(_text(vocabulary, ids))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


@lru_cache(maxsize=1)
def _pieces(vocabulary: str) -> tuple[pa.Array, np.ndarray]:
    pieces = pa.array(piece_table(vocabulary), pa.binary())
    return pieces, pc.binary_length(pieces).to_numpy()


def _text(vocabulary: str, ids: np.ndarray) -> str:
    """The pieces of ``ids`` strung together: what a join of ids with pieces leaves in its value buffer."""
    if not len(ids):
        return ""
    pieces, sizes = _pieces(vocabulary)
    taken = pieces.take(pa.array(ids))
    return taken.buffers()[2].slice(0, int(sizes[ids].sum())).to_pybytes().decode("utf-8", "replace")
