import hashlib
import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import chunk_codec, packing, queries, tokens

PATH = queries.TOKENIZER
ROOT = Path(__file__).resolve().parents[2]
ODD = [
    "It's A.B., \"x\".. don't I'LL", "ǰ J̌ <|endoftext|> <|STARTOFTEXT|>x <|startoftext|>", "a\x0bb\x0cc\x85d\xa0e f\x1cg", "", "  \n",
    "１２ ½ ǅ ß ẞ Σας ΣΑΣ İI 中文字 한국 é ́a", "x.,y ., ,. a.é, é. '.s 's 'S ’s", "1990s, 3.14. a1. b2,", "z" * 5000, "中" * 3000 + " a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(3)
    drawn = list("aAbB.,'  \n\t1éÉ́<|>-_sS中ß\x0b ")
    mixed = ["".join(rng.choice(drawn, rng.integers(0, 2000))) for _ in range(150)]
    return [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()] + ODD + mixed


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_ids_of_the_library(library, texts, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 3000)
    encoder = tokens.Encoder(PATH)
    for _ in range(2):
        for i in range(0, len(texts), 50):
            ids, at = encoder.encode([t.encode() for t in texts[i : i + 50]])
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(library, t) for t in texts[i : i + 50]]


def test_chunks_join_to_the_ids_of_the_library(library, texts, monkeypatch):
    for bits in (2, 6, 9):
        monkeypatch.setattr(chunk_codec, "CUT_BITS", bits)
        coder = chunk_codec.Codec(PATH)
        assert [x.tolist() for x in coder.encode([t.encode() for t in texts])] == [ids_of(library, t) for t in texts]


def test_shared_passages_are_encoded_once(texts):
    long = max(texts, key=len)
    coder = chunk_codec.Codec(PATH)
    coder.encode([f"Begin {i}. {long}".encode() for i in range(20)])
    assert coder.met > 15 * coder.encoded - 400 and coder.encoded < coder.met / 5


def test_a_join_that_disagrees_is_widened(library):
    coder = chunk_codec.Codec(PATH)
    text = b"one two three four five six seven eight"
    coder.known = {
        text[:17]: chunk_codec.Chunk(b"one", b" two three ", np.array(ids_of(library, "two wrong"), np.uint32), text[14:17]),
        text[17:]: chunk_codec.Chunk(text[17:18], b" five six seven ", np.array(ids_of(library, "five six seven"), np.uint32), b"eight"),
    }
    assert coder._joined([(coder.known[text[:17]], b"four", coder.known[text[17:]])]) == [None]


def test_query_matches_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.QUERIES["op5_bpe"](spark, SF_DIR).collect():
        ids = ids_of(library, docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_codec_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "a b", 5), (2, "a b", 5)], "doc_id long, text string, ids int")
    got = [(r.doc_id, r.n_tokens, r.decoded) for r in chunk_codec.encode_decode(df, PATH).orderBy("doc_id", "n_tokens").collect()]
    assert got == [(1, 0, ""), (2, 0, ""), (2, 2, "a</w> b</w>"), (2, 2, "a</w> b</w>")]
    assert chunk_codec.encode_decode(df.limit(0), PATH).collect() == []


def check_packing(rows, library, texts):
    """Every id in one piece, every sequence gapless and small enough."""
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_row) == set(texts)
    for doc, own in by_row.items():
        ids = np.array([*ids_of(library, texts[doc]), 2], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= packing.CAPACITY
    assert set(by_sequence) == set(range(len(by_sequence)))
    return sum(n for s in by_sequence.values() for _, n in s) / (packing.CAPACITY * len(by_sequence))


def test_packing_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert check_packing(queries.QUERIES["op3_packing"](spark, SF_DIR).collect(), library, texts) > 0.95


def test_packing_edges(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 5)
    monkeypatch.setattr(packing, "RUN", 4)
    texts = {1: None, 2: "", 3: "a " * 4095, 4: "a " * 4096, 5: "b " * 20000, **{i: "same words" for i in range(10, 90)}}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, offset string")
    check_packing(packing.pack(packing.token_pieces(df, PATH)).collect(), library, texts)
    twice = df.filter("doc_id in (1, 10)").union(df.filter("doc_id in (1, 10)"))
    assert packing.pack(packing.token_pieces(twice, PATH)).count() == 4
    assert packing.pack(packing.token_pieces(df.limit(0), PATH)).collect() == []


def test_shortest_pack_first_matches_brute_force():
    rng = np.random.default_rng(5)
    for capacity in (7, 64, 300):
        lengths = rng.integers(1, capacity, 400)
        runs, n = packing.place({int(x): int(c) for x, c in zip(*np.unique(lengths, return_counts=True))}, capacity)
        packs = []
        for length in sorted(lengths, reverse=True):
            least = min(range(len(packs)), key=packs.__getitem__, default=None)
            if least is None or packs[least] + length > capacity:
                packs.append(length)
            else:
                packs[least] += length
        held = np.zeros(n, int)
        for length, _, count, first, offset in runs:
            assert (held[first : first + count] == offset).all()
            held[first : first + count] += length
        assert sorted(held) == sorted(packs) and sum(r[2] for r in runs) == 400


def test_an_encoder_starts_no_threads():
    code = """
import os, random
from tideline.llm import queries, tokens
encoder = tokens.Encoder(queries.TOKENIZER)
before = len(os.listdir("/proc/self/task"))
draw = random.Random(1)
texts = [" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(2000)).encode() for _ in range(4)]
ids, at = encoder.encode(texts)
assert len(at) == 5 and len(ids) >= 8000
print(len(os.listdir("/proc/self/task")) - before)
"""
    # In a process of its own, as other tests may have started threads in this one.
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "0"
