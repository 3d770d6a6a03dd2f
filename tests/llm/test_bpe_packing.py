import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chartloom.llm import bpe, packing

ODD = [
    None, "", " ", "  a  b ", "a\n\nb", " \n x", "x <|endoftext|> y", "a  <|endoftext|>  b<|endoftext|>c", "﻿a",
    "don't we'll 'S it's", "é ü x \x1cq\x1d \x85z", "tab\there  \t x\t", "日本語 テスト 🙂🙂 emoji‍x", "á é.\nÉ",
    "a b c " * 2000, "end \n", "A　B 12a 3.4 ½²", "word.\nNext, line\n", "\nstart", "x" * 5000, "<|startoftext|>",
]


@pytest.fixture
def texts(documents):
    pairs = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id here"), (900, ODD[4]), (901, ODD[4])]
    return documents(pairs), pairs


def test_bpe_equals_the_library_and_comes_back(texts, vocabularies):
    docs, pairs = texts
    path = vocabularies["byte_bpe_50k.json"]
    tok = Tokenizer.from_file(path)
    got = sorted(((r.doc_id, bytes(r.ids), r.text) for r in bpe.decode(bpe.encode(docs, path), path).collect()), key=str)
    want = []
    for i, t in pairs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, struct.pack(f"<{len(ids)}I", *ids), tok.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)


def test_invalid_bytes_decode_to_replacement_characters(spark, vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    pieces = bpe.piece_table(path)
    lone = pieces.index(b"\xe9")
    df = spark.createDataFrame([(1, bytearray(struct.pack("<2I", lone, pieces.index(b"a")))), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.text for r in bpe.decode(df, path).collect()} == {1: "�a", 2: ""}


def test_pieces_are_gapless_and_fill_as_few_sequences_as_best_fit(texts, vocabularies):
    docs, pairs = texts
    path = vocabularies["word_bpe_49k.json"]
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    want = defaultdict(int)
    for i, t in pairs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        for k, s in enumerate(range(0, len(ids), 2048)):
            cut = ids[s : s + 2048]
            want[i, k, s, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))] += 1
    found = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def _best_fit(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in free if g >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(capacity - n)
    return len(free)


@pytest.mark.parametrize("seed", range(8))
def test_sweeps_use_as_many_sequences_as_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, rng.choice([capacity, capacity // 3])) for _ in range(rng.randint(0, 300))]
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    plan, used = packing.sweep(counts, capacity)
    assert used == _best_fit(lengths, capacity)
    filled, ranks = defaultdict(list), defaultdict(list)
    for r in plan.itertuples():
        ranks[r.length].append((r.lo, r.size))
        for j in range(r.size):
            filled[r.first + j // r.per].append((r.offset + j % r.per * r.length, r.length))
    assert set(filled) == set(range(used))
    for n, parts in ranks.items():
        at = 0
        for lo, size in sorted(parts):
            assert lo == at
            at += size
        assert at == counts[n]
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity


def test_no_documents(documents, vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    assert bpe.decode(bpe.encode(documents([]), path), path).count() == 0
    assert packing.pack(documents([]), vocabularies["word_bpe_49k.json"]).count() == 0


def test_ids_digest_matches_little_endian_integers(documents, vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    row = bpe.encode(documents([(1, "hello world")]), path).first()
    ids = Tokenizer.from_file(path).encode("hello world", add_special_tokens=False).ids
    assert hashlib.sha256(row.ids).hexdigest() == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def _texts(pairs, part=3):
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(pairs), pa.int32()), pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs])],
        ["part", "doc_id", "text"],
    )


def _words(batches):
    """Rows of _chunk_words in one batch, sorted by bucket."""
    return pa.Table.from_batches(batches).sort_by("bucket").combine_chunks().to_batches()


def test_a_chunk_comes_back_in_small_batches_and_chunk_borders_lose_nothing(vocabularies, monkeypatch):
    # One table a chunk, ids and text of 32 MB of documents at once, took an executor past its memory.
    for name, value in (("SLICE_BYTES", 2000), ("CHUNK_WORDS", 400), ("BLOCK_DOCS", 5), ("BLOCK_POSITIONS", 200)):
        monkeypatch.setattr(bpe, name, value)
    rng = random.Random(1)
    some = [" ".join(f"w{rng.randrange(2000)}" for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    pairs = [*enumerate([*ODD, *some, "long " * 3000, "", None, *ODD]), (None, "no id here")]
    path = vocabularies["byte_bpe_50k.json"]
    rows = defaultdict(list)
    for batch in bpe._chunk_docs(iter([_texts(pairs)])):
        for r in batch.to_pylist():
            assert len(r["doc_ids"]) == 1 or (len(r["doc_ids"]) <= 5 and r["n"] <= 200)
            rows[r["chunk"]].append(r | {"n_ids": None})
    for batch in bpe._encode_words(path)(iter(_words(list(bpe._chunk_words(4)(iter([_texts(pairs)])))))):
        for r in batch.to_pylist():
            rows[r["chunk"]].append(r | {"n_words": None, "doc_ids": None})
    assert len(rows) > 3 and {c >> 24 for c in rows} == {3}
    kinds = [("n_words", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n", pa.int64()), ("n_ids", pa.int64()), ("block", pa.binary())]
    got = []
    for chunk, of in rows.items():
        rng.shuffle(of)
        table = pa.Table.from_pylist(of, pa.schema(kinds))
        batches = list(bpe._join_positions(path, True)((chunk,), iter(table.to_batches(7))))
        assert len(batches) == sum(r["n_words"] is not None for r in of)
        got += [(r["doc_id"], r["ids"], r["text"]) for b in batches for r in b.to_pylist()]
    tok = Tokenizer.from_file(path)
    want = []
    for i, t in pairs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, struct.pack(f"<{len(ids)}I", *ids), tok.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_changed_documents_are_noticed(vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    texts = [b.append_column("n_ids", pa.array([None], pa.int64())) for b in bpe._chunk_docs(iter([_texts([(1, "a b")])]))]
    with pytest.raises(RuntimeError, match="documents changed"):
        list(bpe._join_positions(path, False)((1,), iter(texts)))


def test_an_encoder_keeps_the_words_of_one_bucket(vocabularies):
    path = vocabularies["byte_bpe_50k.json"]
    pairs = [(i, f"word{i} and{i % 7}") for i in range(500)]
    words = _words([b for part in range(3) for b in bpe._chunk_words(16)(iter([_texts(pairs, part)]))])
    distinct = dict(zip(words[0].column("bucket").to_pylist(), words[0].column("n").to_pylist(), strict=True))
    kept = [len(bpe._encoder(path)._cache) for _ in bpe._encode_words(path)(iter(words))]
    assert kept == [distinct[b] for b in words[0].column("bucket").to_pylist()]
    assert not bpe._encoder(path)._cache
