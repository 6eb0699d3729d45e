import hashlib
import re

import pytest

from layerhouse.llm import decontaminate
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF

FOLD = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs: list, items: list, size: int = 13) -> list:
    windows: dict = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(FOLD))
        length = min(size, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            windows.setdefault(tuple(words[i:i + length]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words = WORD.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for length in lengths:
            for i in range(len(words) - length + 1):
                if owners := windows.get(tuple(words[i:i + length])):
                    hit.update(range(i, i + length))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def digest(frame) -> list:
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
                   for r in frame.collect()), key=str)


def rows(frame, *columns) -> list:
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_query_equals_brute_force(spark, documents):
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    found = sorted((tuple(r) for r in QUERIES["op8_decontaminate"](spark, SF).collect()), key=str)
    assert found == brute(rows(documents, "doc_id", "text"), items)
    assert any(r[-1] for r in found)


def bench(spark, texts: list):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


TEXTS = [
    "the quick brown fox", "lazy", "", None, "gamma delta epsilon zeta eta theta alpha beta gamma delta epsilon zeta eta theta alpha",
    "a b", "The Quick BROWN fox!", "old river bank no id", "x" * 50]


def test_odd_rows_short_items_and_blocks(spark, odd_documents):
    items = bench(spark, TEXTS).unionByName(spark.createDataFrame([(None, "id here"), (1, "lazy")], "item_id long, text string"))
    expected = brute(rows(odd_documents, "doc_id", "text"), rows(items, "item_id", "text"))
    assert digest(decontaminate.occurrences(odd_documents, items)) == expected
    # The same with so small blocks that every item is searched for in a pass of its own.
    assert digest(decontaminate.occurrences(odd_documents, items, block_bytes=120)) == expected


@pytest.mark.parametrize("block_bytes,how", [(120, "merge"), (4000, "broadcast")])
def test_several_blocks_write_the_rows_once(spark, odd_documents, monkeypatch, block_bytes, how):
    items = bench(spark, [*TEXTS, " ".join(f"w{i}" for i in range(2000))])
    written, hints = [], []
    frame, saved = type(odd_documents), decontaminate.saved
    hint = frame.hint
    monkeypatch.setattr(decontaminate, "saved", lambda df, purpose: written.append(purpose) or saved(df, purpose))
    monkeypatch.setattr(frame, "hint", lambda df, name, *more: hints.append(name) or hint(df, name, *more))
    judged = decontaminate.occurrences(odd_documents, items, block_bytes=block_bytes)
    assert written.count("decontamination") == 1 and hints == [how]
    assert digest(judged) == brute(rows(odd_documents, "doc_id", "text"), rows(items, "item_id", "text"))
    kept, whole = decontaminate.clean(odd_documents, items, block_bytes=block_bytes), decontaminate.clean(odd_documents, items)
    assert kept.dtypes == whole.dtypes
    assert sorted(kept.collect(), key=str) == sorted(whole.collect(), key=str)


def test_no_rows(spark, no_documents, odd_documents):
    assert decontaminate.occurrences(no_documents, bench(spark, TEXTS)).count() == 0
    assert decontaminate.occurrences(no_documents, bench(spark, TEXTS), block_bytes=60).count() == 0
    none = decontaminate.occurrences(odd_documents, bench(spark, TEXTS).limit(0))
    assert none.count() == odd_documents.count() and none.filter("n_hit > 0 or contaminated").count() == 0


def test_clean_keeps_all_columns_and_clean_rows(spark, odd_documents):
    kept = decontaminate.clean(odd_documents, bench(spark, ["the quick brown fox jumps over the lazy dog near the old river bank"]))
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count() - 2


def test_search_against_scanning_with_overlaps():
    words = "a a a b a a a a c a a".split()
    text = " ".join(words).encode()
    tables, _ = decontaminate.searchers([("x", b"a a a"), ("y", b"a"), ("z", b"a a c a")], 3)
    spans, found = decontaminate.search(decontaminate.words_of(text), tables)
    assert spans == [[0, 3], [4, 11]] and found == {0, 1, 2}
