"""Spelling variants against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from strataline.llm import variants
from strataline.llm.queries import op11_variants

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows) -> Counter:
    """Occurrences of words, as the contract words it, code point by code point."""
    found: Counter = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 7 and n >= 2})


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def expected(words: Counter) -> dict[str, tuple]:
    # Words one edit apart are equal once a code point at one place of each is left out, at most.
    near: dict[str, set] = {w: set() for w in words}
    by_rest: dict[str, set] = {}
    for w in words:
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_rest.setdefault(rest, set()).add(w)
    for group in by_rest.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    rows = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return rows


def result(df) -> dict[str, tuple]:
    rows = df.collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert result(op11_variants(spark, SF)) == expected(counted(docs.collect()))


@pytest.mark.parametrize("letters", ["ab", "abcé", "a"])
def test_dense_words_match_brute_force(spark, letters):
    """Repeated letters, ties between grams, words of every small edit, and chains of forms."""
    rng = random.Random(len(letters))
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(60)]
    texts = []
    for i, w in enumerate(base):
        for n in (1, 10, 100):
            at = rng.randrange(len(w))
            texts.append((i, " ".join([w] * (2 * n))))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:]])
    got = result(variants.group(spark.createDataFrame(texts, "doc_id long, text string")))
    want = expected(counted(texts))
    assert got == want
    if letters == "abcé":
        assert any(form and root != form for form, root, *_ in want.values())


def test_no_pair_of_near_words_is_missed():
    """Every single edit of many words is found by a common key, one way round or the other."""
    rng = random.Random(5)
    words = {"".join(rng.choice("aaaabcé") for _ in range(rng.randint(7, 14))) for _ in range(100)}
    words |= {x * n + y * m for x in "ab" for y in "abé" for n in (7, 8, 20) for m in (0, 1, 2, 9)}
    edited = {w[:i] + x + w[i + j :] for w in words for i in range(len(w) + 1) for j in (0, 1) for x in ("", "a", "z")}
    known = [w for w in words | edited if len(w) >= 7]
    counts = Counter(w[i : i + 2] for w in known for i in range(len(w) - 1))
    rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    keys = {}
    for w in known:
        last, places, choice = variants.prefix(w, rank)
        chosen = variants.pivots(choice, [counts[w[i : i + 2]] for i in choice])
        assert chosen[1] - chosen[0] >= 2 and set(chosen) <= set(choice) <= set(places) and len(places) <= 7
        tied = [i for i in range(len(w) - 1) if rank[w[i : i + 2]] <= last]
        best = min(counts[w[a : a + 2]] + counts[w[b : b + 2]] for a, b in itertools.combinations(tied, 2) if b - a >= 2)
        assert best == sum(counts[w[i : i + 2]] for i in chosen)
        keys[w] = last, variants.index_keys(w, places), variants.probe_keys(w, chosen)
    held = set(known)
    for w in known[:3000]:
        around = {w[:i] + x + w[i + j :] for i in range(len(w) + 1) for j in (0, 1) for x in ("", "a", "b", "c", "z")} & held - {w}
        for v in around:
            (a, index_a, probe_a), (b, index_b, probe_b) = keys[w], keys[v]
            assert (a <= b and probe_a & index_b) or (b <= a and probe_b & index_a), (w, v)


DOC = "doc_id long, text string, word string, n long, key string"
ROWS = [
    (None, None, None, None, None),
    (1, "", "x", 1, "x"),
    (2, "ABCDEFGHI abcdefghi abcdefgh ÀÉbcdefg " * 4000, "x", 1, "x"),
    (3, f"{'x' * 3000} {'x' * 3000} {'x' * 2999} {'x' * 2999} {'x' * 2998}y {'x' * 2998}y", None, None, None),
    (None, "abcdefghij abcdefghij", None, 1, None),
    (None, "abcdefghij abcdefghij", None, 1, None),
]


def test_edge_cases(spark):
    odd = spark.createDataFrame(ROWS, DOC)
    assert result(variants.group(odd)) == expected(counted([r[:2] for r in ROWS]))
    assert variants.group(odd.limit(0)).count() == 0
    assert result(variants.group(spark.createDataFrame([("a", "Abcdefgh abcdefgh")], "doc_id string, text string")))
