"""Benchmark decontamination against brute force."""

from __future__ import annotations

import hashlib
import re

import pytest

from strataline.llm import contamination
from strataline.llm.queries import op12_contamination

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size: int = 10) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        named = sorted(str(x) for x in found if x is not None)
        rows.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest()))
    return sorted(rows, key=repr)


def rows_of(df) -> list[tuple]:
    return sorted(
        (
            (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest())
            for r in df.collect()
        ),
        key=repr,
    )


DOC = "doc_id long, text string, item string, words string, key string, spans string, n_hit long"
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (None, None, None, None, None, None, None),
    (1, "", "x", "x", "x", "x", 1),
    (2, f"Before, {LONG.upper()}! after", None, None, None, None, None),
    (2, f"Before, {LONG.upper()}! after", None, None, None, None, None),
    (3, "w1-w2\tw3 w4", None, None, None, None, None),
    (4, "Été cafés " * 50_000 + LONG, None, None, None, None, None),
    (5, "short answer; the short answers", None, None, None, None, None),
    (6, "W0 w1 w2 w3 w4 w5 w6 w7 w8", None, None, None, None, None),
]
ITEMS = [
    (1, LONG), (2, " ".join(f"w{i}" for i in range(30, 45))), (2, "short ANSWER"), (3, None), (4, "\n ?"),
    (10, "answer"), (None, "the short"), (11, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 other words"), (1, LONG), (12, "été"), (13, "Été"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOC), spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("max_words", [contamination.MAX_WORDS, 40])
def test_odd_rows_match_brute_force(odd, max_words):
    docs, items = odd
    assert rows_of(contamination.scan(docs, items, max_words=max_words)) == brute([r[:2] for r in ROWS], ITEMS)


def test_empty_tables(odd):
    docs, items = odd
    assert contamination.scan(docs.limit(0), items).count() == 0
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in contamination.scan(docs, items.limit(0)).collect())


def test_chunks_keep_every_window():
    for n in (1, 9, 10, 11, 25, 100):
        w = [b"%d" % i for i in range(n)]
        whole = {tuple(w[i : i + 10]) for i in range(max(1, n - 9))}
        cut = {tuple(c[i : i + 10]) for c in contamination.chunks(w, 10, 20) for i in range(max(1, len(c) - 9))}
        assert cut == whole
    assert list(contamination.chunks([], 10)) == []


@pytest.mark.parametrize("max_words", [contamination.MAX_WORDS, 300])
def test_tables_match_brute_force(spark, max_words):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert any(r[2] for r in want)
    assert rows_of(contamination.scan(docs, items, max_words=max_words)) == want
    if max_words == contamination.MAX_WORDS:
        got = op12_contamination(spark, SF).collect()
        assert sorted((tuple(r)[:5] for r in got), key=repr) == want
        assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_spans_point_into_the_original_text(odd):
    docs, items = odd
    for r in contamination.scan(docs.filter("text is not null"), items).collect():
        text = next(row[1] for row in ROWS if row[0] == r["doc_id"])
        hit = [w for s in r["spans"] for w in words(text[s["start"] : s["end"]])]
        assert len(hit) == r["n_hit"]
        if r["doc_id"] == 2:
            assert text[r["spans"][0]["start"] : r["spans"][0]["end"]] == LONG.upper()


def test_questions_and_answers_are_texts_by_themselves(spark):
    items = spark.createDataFrame([(1, "one two three", "four five")], "item_id long, question string, answer string")
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "three four"), (3, "so four five")], "doc_id long, text string")
    found = contamination.scan(docs, items, item_texts=["question", "answer"])
    assert {r["doc_id"]: r["n_hit"] for r in found.collect()} == {1: 5, 2: 0, 3: 2}
