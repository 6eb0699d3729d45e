import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from layerhouse.llm import byte_bpe
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(PATH, PATTERN)


def packed(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def expected(plain, rows) -> list:
    out = []
    for doc_id, text in rows:
        ids = plain.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_the_plain_library(spark, plain, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = QUERIES["op12_byte_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(plain, rows)


def test_odd_rows(spark, plain, odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    found = byte_bpe.decode(byte_bpe.encode(odd_documents, PATH, PATTERN), PATH, PATTERN).collect()
    told = [(r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded).hexdigest()) for r in found]
    assert sorted(told, key=str) == expected(plain, rows)
    assert byte_bpe.encode(no_documents, PATH, PATTERN, starts=True).count() == 0


def test_every_kind_of_character_and_space(plain, codec):
    draw = random.Random(4)
    kinds = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "᠎", "a", "Zé", "中文", "123", "²",
             "'s", "'ll", "!", "...", "----", "=" * 37, "😀", "👩‍👩‍👧", "\x00", "é", "<|endoftext|>", "ß", "अनु", "\U0010ffff"]
    for _ in range(3000):
        text = "".join(draw.choice(kinds) * draw.choice([1, 1, 1, 2, 9]) for _ in range(draw.randrange(12)))
        ids = codec.encode(text)
        assert ids == packed(plain.encode_ordinary(text)), repr(text)
        assert codec.decode(ids).decode() == text


def test_runs_of_one_unit(plain, codec):
    """Repeated characters: many neighbours have the same rank there."""
    draw = random.Random(6)
    for _ in range(1500):
        unit = "".join(draw.choice("-=ab.*0haéЖ中") for _ in range(draw.randint(1, 3)))
        text = "".join(draw.choice(["", "a", "-", " "]) + unit * draw.randint(1, 60) for _ in range(draw.randint(1, 3)))
        assert codec.encode(text) == packed(plain.encode_ordinary(text)), text


def test_full_cache_and_long_texts(plain, codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "BLOCK", 20)
    draw = random.Random(8)
    text = " ".join("".join(draw.choice("abcdé") for _ in range(draw.choice([2, 3, 90]))) for _ in range(2000))
    assert codec.encode(text) == packed(plain.encode_ordinary(text))
    assert len(codec.known) <= 50 + 20


def test_starts_and_cut_characters(plain, codec):
    text = "naïve 😀 text, 中文字 and a \U0010ffff"
    ids = codec.encode(text)
    starts = codec.starts(text, ids)
    _, offsets = plain.decode_with_offsets(plain.encode_ordinary(text))
    assert starts.tolist() == [min(o, len(text) - 1) for o in offsets]
    single = [ids[i:i + 4] for i in range(0, len(ids), 4)]
    assert "".join(codec.texts(single)) == text
    assert any(codec.decode(s).decode(errors="replace") != codec.decode(s).decode(errors="ignore") for s in single)
    assert "".join(codec.texts([single[0], ids[-8:-4]])).endswith("�")
    assert list(codec.texts([])) == [""]
