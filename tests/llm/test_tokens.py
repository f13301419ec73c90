"""Packing, token files and byte-level BPE against the public libraries on whole texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlens.llm import bpe, packing, tokenfile, vocab
from orderlens.llm.queries import QUERIES
from llm_helpers import ODD_IDS, ODD_TEXTS, corpus, documents

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "the", "'s", "é", "é", " ", "  ", "\n", "\t", " ", "中", "12", "?!", "\x1c", "İ", "Σ", "<|endoftext|>",
         "</w>", "😀", "Word,", " x***", "\r\n", "　", "\x01"]


def plain(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own_bpe():
    return bpe.Bpe.load(RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(path):
    rnd, whole, tool = random.Random(3), plain(path), vocab.PieceEncoder(path)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for text, raw in zip(texts, tool.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == whole(text), text


def test_piece_table_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(vocab.PieceEncoder, "limit", 3)
    tool, whole = vocab.PieceEncoder(BYTE), plain(BYTE)
    for text in ["one two three four", "five two\nsix seven", "one two"]:
        assert np.frombuffer(tool.encode([text])[0], "<u4").tolist() == whole(text)


def check_pieces(rows, texts, window, whole):
    """Every id in one piece, sequences filled without gaps, all but the last full."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for s, own in sequences.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or s == len(sequences) - 1 and at <= window
    want = sorted(len(whole(t)) + 1 for t in texts)
    assert sum(r.length for r in rows) == sum(want)
    return docs


def test_packing_odd_rows(spark):
    whole = plain(WORD)
    docs = documents(spark, ODD_TEXTS, ODD_IDS).repartition(3)
    pieces = packing.pack(docs, WORD, window=64, end_id=2).collect()
    check_pieces(pieces, ODD_TEXTS, 64, whole)
    long = sorted((r for r in pieces if r.doc_id == 2), key=lambda r: r.start)
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in long), "<u4").tolist()
    assert ids == whole(ODD_TEXTS[ODD_IDS.index(2)]) + [2]
    assert all(a.start + a.length == b.start for a, b in zip(long, long[1:], strict=False))


def test_packing_query_and_sequences(spark, sf_dir):
    texts, whole = corpus(sf_dir), plain(WORD)
    rows = QUERIES["op1_packing"](spark, sf_dir).collect()
    check_pieces(rows, texts.values(), 4096, whole)
    for r in rows:
        ids = np.array((whole(texts[r.doc_id]) + [2])[r.start : r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
    pieces = packing.pack(documents(spark, ["a b c", "d e f g", None]), WORD, window=4)
    out = sorted(packing.sequences(pieces).collect(), key=lambda r: r.sequence_id)
    assert [r.n_tokens for r in out] == [4, 4, 2]
    assert np.frombuffer(b"".join(bytes(r.ids) for r in out), "<u4").tolist() == whole("a b c") + [2] + whole("d e f g") + [2, 2]


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert packing.pack(empty, WORD).count() == 0
    assert tokenfile.read(tokenfile.write(empty, BYTE)).count() == 0
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files_query(spark, sf_dir):
    texts, whole = corpus(sf_dir), plain(BYTE)
    got = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, sf_dir).collect()}
    at = 0
    for doc_id in sorted(texts):
        ids = np.array([*whole(texts[doc_id]), 2], "<u4")
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(texts)


def test_token_files_odd_rows_and_lookup(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_IDS", 50)
    whole = plain(BYTE)
    manifest = tokenfile.write(documents(spark, ODD_TEXTS, ODD_IDS), BYTE)
    rows = tokenfile.read(manifest).collect()
    want = sorted(zip([-(1 << 63) if i is None else i for i in ODD_IDS], [t or "" for t in ODD_TEXTS], strict=True))
    at = 0
    for r, (_, text) in zip(sorted(rows, key=lambda r: r.start), want, strict=True):
        ids = [*whole(text), 2]
        assert r.start == at and np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        at += len(ids)
    asked = spark.createDataFrame([(7,), (2,), (3,), (None,), (1 << 40,)], "doc_id bigint")
    found = tokenfile.lookup(manifest, asked).collect()
    assert sorted(r.doc_id for r in found) == [2, 7, 7, 1 << 40]
    assert all(np.frombuffer(bytes(r.ids), "<u4").tolist() == [*whole(ODD_TEXTS[4]), 2] for r in found if r.doc_id == 7)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000))
    table = tokenfile.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert len(tokenfile.PerfectHash.build(np.empty(0, np.int64)).slots(keys)) == len(keys)


def test_bpe_equals_tiktoken(own_bpe):
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own_bpe.ranks, special_tokens={})
    rnd, tool = random.Random(5), bpe.BpePieces(own_bpe)
    texts = ["".join(rnd.choice([*PARTS, "zq" * 30, " " * 140]) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for text, raw in zip(texts, tool.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == lib.encode_ordinary(text) == own_bpe.encode(text)
        assert own_bpe.decode(ids) == text.encode()


def test_pairs_fit_by_definition(own_bpe):
    rnd, ids = random.Random(2), list(own_bpe.bytes)
    for _ in range(5000):
        a, b = rnd.choice(ids), rnd.choice(ids)
        assert own_bpe.fits(a, b) == (own_bpe.merged(own_bpe.bytes[a] + own_bpe.bytes[b]) == [a, b])


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=20), st.integers(0, 80), st.integers(0, 10))
def test_prefixes_survive_appends_and_edits(own_bpe, data, new, at, cut):
    p = bpe.Prefixes(own_bpe, data[:7])
    p.append(data[7:])
    assert p.tokens() == own_bpe.merged(data)
    at, end = min(at, len(data)), min(at + cut, len(data))
    p.replace(at, end, new)
    assert p.data == data[:at] + new + data[end:]
    assert all(p.tokens(k) == own_bpe.merged(p.data[:k]) for k in range(len(p.data) + 1))


def test_bpe_query(spark, sf_dir):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = corpus(sf_dir)
    rows = QUERIES["op5_byte_bpe"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = lib.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows(spark):
    both = bpe.decode(bpe.encode(documents(spark, ODD_TEXTS, ODD_IDS), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded).decode() for r in both.collect()) == sorted(t or "" for t in ODD_TEXTS)
