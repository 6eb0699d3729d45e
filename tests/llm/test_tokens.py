import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import xxhash
from tokenizers import Tokenizer

from layerhouse.llm import packing, token_store
from layerhouse.llm.huffman import Code, canonical, code_lengths
from layerhouse.llm.queries import QUERIES
from layerhouse.llm.tokenizer import Encoder, vocabulary_path
from layerhouse.session import work_dir
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, texts: list) -> list:
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("most", [50, 1_000_000])
def test_encoder_equals_the_library(library, most):
    draw = random.Random(1)
    parts = [*"ab ,.\n\t'1é—|!", "<|endoftext|>", "  ", "the ", " don't", "　", "\x1c", "日本", "\r\n", "foo<|endoftext|>."]
    texts = ["", None, " ", "\n", "end\n\n", "  \n <|endoftext|>\n", "a" * 500]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    encoder = Encoder(vocabulary_path(), most)
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == ids_of(library, texts)


@pytest.mark.parametrize("bits", [0, 4, 9])
@pytest.mark.parametrize("most", [50, 1_000_000])
def test_pieces_of_one_hash_keep_their_own_ids(library, bits, most):
    """Hashes of a few bits: nearly all pieces share theirs with others, of equal and of other lengths."""
    draw = random.Random(7)
    parts = ["the ", "dog ", "cat ", "a", "b ", "\n", "longer", "日本 ", "\x1c", ". ", "<|endoftext|>"]
    texts = ["", "the dog", "the cat", *("".join(draw.choice(parts) for _ in range(draw.randint(1, 30))) for _ in range(300))]
    encoder = Encoder(vocabulary_path(), most)
    encoder.byte_value &= np.uint64((1 << bits) - 1)
    encoder.powers[:], encoder.inverses[:] = 1, 1
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == ids_of(library, texts)


def test_long_pieces_do_not_fill_the_cache(library):
    draw = random.Random(8)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=900)) for _ in range(40)) for _ in range(60)]
    encoder = Encoder(vocabulary_path(), 1000)
    for text in texts:
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.text) <= 64 * 1000 + len(text)


def test_encoder_of_another_kind():
    path = vocabulary_path("word_bpe_49k.json")
    texts = ["Hello  World", "", "naïve café"]
    ids, sizes = Encoder(path).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == ids_of(Tokenizer.from_file(path), texts)


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([0, 45, 13, 12, 16, 9, 5, 0])
    lengths = code_lengths(counts)
    assert lengths.tolist() == [0, 1, 3, 3, 3, 4, 4, 0]
    skewed = np.array([2**i for i in range(20)])
    for limit in (5, 8, 19):
        lengths = code_lengths(skewed, limit)
        assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths) <= 1
    assert code_lengths(skewed, 19).tolist() == [19, 19, *range(18, 0, -1)]
    with pytest.raises(ValueError):
        code_lengths(skewed, 4)
    assert code_lengths(np.array([0, 7])).tolist() == [0, 1]


def test_codes_are_prefix_free():
    lengths = code_lengths(np.random.default_rng(1).integers(0, 50, 300))
    codes = canonical(lengths)
    texts = [format(int(c), f"0{int(n)}b") for c, n in zip(codes, lengths) if n]
    assert not any(a != b and b.startswith(a) for a in texts for b in texts)


def test_huffman_round_trip():
    draw = np.random.default_rng(5)
    counts = np.maximum(1, draw.zipf(1.3, 3000) % 100_000)
    code = Code(code_lengths(counts))
    parts = [draw.choice(3000, size=n, p=counts / counts.sum()) for n in (0, 1, 127, 128, 129, 5000)]
    coded = [(*code.encode(p), len(p)) for p in parts]
    for found, part in zip(code.decode(coded), parts):
        assert found.tolist() == part.tolist()
    assert code.decode(coded[4:5])[0].tolist() == parts[4].tolist()  # a block alone


def tie(text: str | None) -> int:
    return np.uint64(xxhash.xxh64_intdigest((text or "").encode(), 42)).astype(np.int64).item()


def expected_store(library, rows: list) -> list:
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    out, start = [], 0
    for (doc_id, _), ids in zip(order, ids_of(library, [t for _, t in order])):
        ids = np.array([*ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_store_query_equals_the_library(spark, documents, library):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op6_token_store"](spark, SF).collect()) == expected_store(library, rows)


def test_store_of_odd_rows(spark, odd_documents, library):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in token_store.stored(odd_documents).collect()), key=lambda r: r[1])
    assert found == expected_store(library, rows)


def test_store_read_back_has_the_ids(spark, odd_documents, library):
    path = work_dir(spark, "test")
    token_store.write(odd_documents.filter("doc_id is not null"), path)
    texts = {r.start: r.ids for r in token_store.read(spark, path).collect()}
    rows = [tuple(r) for r in odd_documents.filter("doc_id is not null").select("doc_id", "text").collect()]
    order = sorted(rows, key=lambda r: (r[0], tie(r[1])))
    assert [texts[k] for k in sorted(texts)] == [[*ids, 0] for ids in ids_of(library, [t for _, t in order])]


def test_store_of_nothing(no_documents):
    assert token_store.stored(no_documents).count() == 0


def check_packing(library, rows: list, found: list, size: int) -> int:
    pieces = []
    for (doc_id, _), ids in zip(rows, ids_of(library, [t for _, t in rows])):
        ids, start, number = [*ids, 2], 0, 0
        length = (len(ids) - 1) % size + 1
        while start < len(ids):
            pieces.append((doc_id, number, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())))
            start, length, number = start + length, size, number + 1
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(pieces, key=str)
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_packing_query(spark, documents, library):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    n = check_packing(library, rows, QUERIES["op9_packing"](spark, SF).collect(), 1024)
    total = sum(len(x) + 1 for x in ids_of(library, [t for _, t in rows]))
    assert n <= 1.05 * -(-total // 1024) + 5


@pytest.mark.parametrize("size", [1, 7, 1024])
def test_packing_of_odd_rows(odd_documents, library, size):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 1000] if size < 1024 else rows
    docs = odd_documents.filter("length(coalesce(text, '')) < 1000") if size < 1024 else odd_documents
    check_packing(library, rows, packing.pack(docs, size).collect(), size)


def test_packing_of_nothing(no_documents):
    assert packing.pack(no_documents).count() == 0


def test_plan_places_everything_once_and_fills_well():
    draw = random.Random(2)
    for size, n in ((1024, 20_000), (64, 500), (10, 40), (5, 3)):
        counts: dict = {}
        for _ in range(n):
            length = min(size, int(draw.expovariate(3 / size)) + 1)
            counts[length] = counts.get(length, 0) + 1
        chosen = packing.plan(counts, size)
        placed: dict = {}
        for lengths, times in chosen:
            assert times > 0 and sum(lengths) <= size
            for x in lengths:
                placed[x] = placed.get(x, 0) + times
        assert placed == counts
        bound = -(-sum(k * v for k, v in counts.items()) // size)
        assert sum(t for _, t in chosen) <= 1.01 * bound + 2
        assert len(chosen) <= 4 * size


def test_plan_of_exact_complements():
    assert sum(t for _, t in packing.plan({6: 5, 4: 5}, 10)) == 5
    assert sum(t for _, t in packing.plan({5: 4, 3: 4, 2: 4}, 10)) == 4
    assert sum(t for _, t in packing.plan({4: 3, 3: 3, 2: 3, 1: 3}, 10)) == 3
    assert packing.plan({}, 10) == []


def test_files_follow_ascending_doc_id(spark, documents, tmp_path, monkeypatch):
    """Read in the order of the file names, row by row, the blocks go on where the one before ends."""
    import pyarrow.parquet as pq

    from layerhouse.llm import token_store

    monkeypatch.setattr(token_store, "BLOCK_IDS", 2000)
    docs = documents.unionByName(documents.withColumn("doc_id", F.col("doc_id") + 1000)).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write(docs, str(tmp_path / "store"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ids, place = [], 0
    files = sorted((tmp_path / "store" / "blocks").glob("part-*"))
    for file in files:
        for row in pq.read_table(file).to_pylist():
            assert row["first"] == place
            place += sum(row["n_tokens"])
            ids += row["doc_ids"]
    assert len(files) > 1 and ids == sorted(ids) and len(ids) == 400
