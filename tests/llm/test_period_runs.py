"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from propgraph.llm import period_runs, queries
from tests.llm.helpers import clashing, documents


def brute_force(words, least=12):
    """(start, end, period) of all runs, by comparing the words with themselves at every distance."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def texts(seed, count):
    """Texts over few words: random ones, powers with changed words, Fibonacci words, powers of powers."""
    choose = random.Random(seed)
    for i in range(count):
        size = choose.randint(0, 150)
        if i % 4 == 0:
            yield [choose.choice("ab") for _ in range(size)]
        elif i % 4 == 1:
            words = ([choose.choice("abc") for _ in range(choose.randint(1, 40))] * size)[:size]
            for _ in range(choose.randint(0, 3) if words else 0):
                words[choose.randrange(size)] = choose.choice("abcd")
            yield words
        elif i % 4 == 2:
            a, b = ["a"], ["a", "b"]
            while len(b) < size:
                a, b = b, b + a
            yield b[:size]
        else:
            part = [choose.choice("aab") for _ in range(choose.randint(1, 6))] * choose.randint(1, 6)
            yield ((part + [choose.choice("ab") for _ in range(choose.randint(1, 5))]) * size)[:size]


@pytest.mark.parametrize("seed", range(3))
def test_runs_like_brute_force(seed):
    choose = random.Random(seed)
    rows = list(texts(seed, 400))
    while rows:
        batch = [[w.encode() for w in rows.pop()] for _ in range(min(len(rows), choose.randint(1, 6)))]
        for words, found in zip(batch, period_runs._batch_runs(batch, 12), strict=True):
            assert [tuple(r) for r in found.tolist()] == brute_force(words)


def test_longer_runs_only():
    for words in texts(9, 80):
        [found] = period_runs._batch_runs([[w.encode() for w in words]], 30)
        assert [tuple(r) for r in found.tolist()] == brute_force(words, 30)


def test_successor():
    choose = random.Random(1)
    numbers = np.array(choose.sample(range(500), 300))
    tree = period_runs.WaveletTree(numbers, 500)
    low = np.array([choose.randrange(300) for _ in range(500)])
    high = np.array([choose.randint(l, 300) for l in low])
    least = np.array([choose.randrange(501) for _ in range(500)])
    want = [min((x for x in numbers[l:h] if x >= v), default=-1) for l, h, v in zip(low, high, least)]
    assert tree.successor(low, high, least).tolist() == want


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_force(words)
    best = min(((e - s, s, p) for s, e, p in runs), key=lambda r: (-r[0], r[1], r[2]), default=None)
    dropped = {i for s, e, p in runs for i in range(s + p, e)}
    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    if best is None:
        return doc_id, 0, None, None, None, None, sha(b""), sha(kept)
    return doc_id, len(runs), best[1], best[0], best[2], 1000 * best[0] // best[2], sha(listed.encode()), sha(kept)


def test_query_like_brute_force(spark, tmp_path):
    choose = random.Random(4)
    docs = [(i, "\n ".join(words)) for i, words in enumerate(texts(11, 300))]
    docs += [(i, " ".join(choose.choice("abcdefghij") for _ in range(choose.randint(0, 90)))) for i in range(300, 700)]
    docs += [(800, None), (801, ""), (802, " \t"), (None, "a b " * 9), (None, None), (803, "\x0b\x1c \xa0" * 14), (4, docs[4][1]), (4, docs[4][1])]
    clashing(documents(spark, docs)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_period_runs(spark, str(tmp_path)).collect()
    order = lambda r: str(tuple(r))
    assert sorted(map(tuple, rows), key=order) == sorted((expected(*d) for d in docs), key=order)
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op11_period_runs(spark, f"{tmp_path}/none").count() == 0


def test_very_long_texts():
    n = 200_000
    [one, other] = period_runs._batch_runs([[b"a"] * n, [b"a", b"b", b"a"] * (n // 3) + [b"c"]], 12)
    assert one.tolist() == [[0, n, 1]] and other.tolist() == [[0, n // 3 * 3, 3]]
