"""Decontamination and license scans against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from propgraph.llm import decontaminate, licenses
from propgraph.llm.common import WordHashes, chained, words_of
from tests.llm.helpers import clashing, documents, sentence

ITEMS = [(i, sentence(1000 + i, n)) for i, n in enumerate([1, 3, 5, 9, 12, 14, 20, 33, 60, 200])] + [(50, None), (51, ""), (None, sentence(7, 25))]


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def planted():
    choose = random.Random(3)
    docs = []
    for n, (item, text) in enumerate(ITEMS):
        before, after = sentence(n + 1, choose.randint(0, 40)), sentence(n + 90, choose.randint(0, 40))
        docs.append((100 + n, f"{before} {text or ''} {after}"))
    long_item = ITEMS[8][1].split()
    long_item[30] = "changed"
    docs += [(200, " ".join(["pre", *long_item])), (201, sentence(9, 30_000) + " " + ITEMS[7][1] + " end"), (202, ITEMS[6][1].upper() + "!")]
    return docs + [(300 + i, sentence(5000 + i, 50)) for i in range(40)] + [(400, None), (401, ""), (None, ITEMS[5][1]), (100, docs[0][1])]


def by_similarity(docs):
    """(doc_id, item_id) pairs of which some item-sized run of words is similar enough."""
    found = set()
    for doc_id, text in docs:
        words = words_of(text)
        for item, item_text in ITEMS:
            own = words_of(item_text)
            if own and any(
                decontaminate.similarity(words[p : p + len(own)], own) >= decontaminate.SIMILARITY
                for p in range(max(1, len(words) - len(own) + 1)) if words
            ):
                found.add((doc_id, item))
    return found


def test_contaminated(spark):
    docs = planted()
    rows = decontaminate.contaminated(clashing(documents(spark, docs)), clashing(benchmark(spark))).collect()
    texts = {d: t for d, t in docs}
    got = {(r.doc_id, r.item_id) for r in rows}
    want = by_similarity(docs)
    assert got == want and {(200, 8), (201, 7), (202, 6), (None, 5)} <= got
    for r in rows:
        words = words_of(texts[r.doc_id])[r.start_word : r.start_word + r.n_words]
        assert decontaminate.similarity(words, words_of(dict(ITEMS)[r.item_id])) == pytest.approx(r.similarity)
    in_blocks = decontaminate.contaminated(documents(spark, docs), benchmark(spark), block_bytes=300).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, in_blocks), key=str)


def test_edited_passages_are_found(spark):
    choose = random.Random(11)
    vocabulary = [sentence(i, 1) for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]

    def zipf(n):
        return choose.choices(vocabulary, weights, k=n)

    items = [zipf(choose.randint(15, 150)) for _ in range(120)]
    docs = []
    for n in range(360):
        words = list(items[n % 120])
        for _ in range(choose.randint(1, 1 + len(words) // 45)):
            at, kind = choose.randrange(len(words)), choose.randrange(3)
            words[at : at + (kind != 2)] = zipf(kind != 1)
        docs.append((n, " ".join([*zipf(choose.randint(0, 30)), *words, *zipf(70)])))
    want = set()
    for n, text in docs:
        words = text.split()
        for i, own in enumerate(items):
            known = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
            hits = [tuple(words[k : k + 5]) in known for k in range(len(words) - 4)]
            if any(hits) and any(decontaminate.similarity(words[p : p + len(own)], own) >= 0.8 for p in range(len(words) - len(own) + 1)):
                want.add((n, i))
    table = spark.createDataFrame([(i, " ".join(own)) for i, own in enumerate(items)], "item_id long, text string")
    rows = decontaminate.contaminated(documents(spark, docs), table).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 150
    assert 7 < max(r.distance for r in rows) <= decontaminate.RADIUS
    texts = dict(docs)
    for r in rows:
        passage = texts[r.doc_id].split()[r.start_word : r.start_word + r.n_words]
        assert r.similarity == decontaminate.similarity(passage, items[r.item_id]) >= 0.8


def test_repeated_items(spark):
    docs, rows = [(1, f"start {ITEMS[6][1]} end"), (1, f"start {ITEMS[6][1]} end")], [ITEMS[6]] * 5 + [(77, ITEMS[6][1])]
    found = decontaminate.contaminated(documents(spark, docs), benchmark(spark, rows)).collect()
    assert sorted(r.item_id for r in found) == [6] * 10 + [77] * 2


def test_nothing_to_compare(spark):
    assert decontaminate.contaminated(documents(spark, []), benchmark(spark)).count() == 0
    assert decontaminate.contaminated(documents(spark, planted()), benchmark(spark, [])).count() == 0


def test_index_finds_all_within_the_radius():
    choose = random.Random(4)
    prints = np.array([choose.getrandbits(64) for _ in range(300)], dtype=np.uint64)
    queries = prints.copy()
    for i in range(len(queries)):
        for b in choose.sample(range(64), i % 15):
            queries[i] ^= np.uint64(1 << b)
    index = decontaminate.BlockIndex.build(8, 1, prints, np.arange(300), np.zeros(300, np.int64))
    q, e, d = index.search(queries, decontaminate.RADIUS)
    want = {(i, j) for i in range(300) for j in range(300) if int(queries[i] ^ prints[j]).bit_count() <= decontaminate.RADIUS}
    assert set(zip(q.tolist(), e.tolist(), strict=True)) == want
    assert (d <= decontaminate.RADIUS).all() and len(want) >= 240


def test_candidates_are_those_of_all_windows(monkeypatch):
    hasher = WordHashes()
    items = [words_of(t) for _, t in ITEMS]
    docs = [words_of(t) for _, t in planted() if t is not None and len(t) < 5000]
    indexes = decontaminate.build_indexes(items)
    want = set()
    for number, words in enumerate(docs):
        h = hasher.of(words)
        for index in indexes:
            n = index.size - 1 if index.size >= 2 else 1
            runs = chained(h, 2) if index.size >= 2 else h
            for start in range(0, len(words) - index.size + 1, index.stride):
                ones = [sum(int(x) >> b & 1 for x in runs[start : start + n]) for b in range(64)]
                fp = sum(1 << b for b in range(64) if 2 * ones[b] > n)
                for entry, other in enumerate(index.prints.tolist()):
                    if (fp ^ other).bit_count() <= 7:
                        want.add((number, int(index.items[entry]), start - int(index.offsets[entry])))
    for chunk in (1 << 13, 64):
        monkeypatch.setattr(decontaminate, "CHUNK", chunk)
        got = {x[:3] for x in decontaminate.candidates(docs, hasher, indexes, 7)}
        assert got == want


def test_windows_of_every_alignment():
    for words in range(1, 300):
        size, offsets = decontaminate.window_of(words)
        assert 1 <= size and size + offsets - 1 <= words


MIT = licenses.TEMPLATES["MIT"]


def texts_with_licenses():
    words = MIT.split()
    changed = [*words[:20], "other", *words[21:40], *words[41:60], "more", *words[60:]]
    return [
        (1, f"{sentence(1, 50)}. Released under the MIT License. {sentence(2, 50)}"),
        (2, f"{sentence(3, 30)}\n{' '.join(changed)}\n{sentence(4, 30)}"),
        (3, sentence(5, 400)), (4, None), (5, ""), (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0."),
        (7, sentence(6, 70_000) + " Released under the MIT License. " + sentence(7, 10)), (8, " ".join(words[: len(words) // 3])),
        (None, "Licensed under the Apache License, Version 2.0."), (9, "Released under the MIT License. x y z Released under the MIT License."),
    ]


def test_licenses(spark):
    docs = texts_with_licenses()
    rows = licenses.scan_licenses(clashing(documents(spark, docs))).collect()
    got = sorted(((r.doc_id, r.license) for r in rows), key=str)
    want = [(1, "MIT-notice"), (2, "MIT"), (6, "CC-BY-NC-4.0-notice"), (6, "CC-BY-NC-4.0-notice"), (7, "MIT-notice")]
    want += [(9, "MIT-notice"), (9, "MIT-notice"), (None, "Apache-2.0-notice")]
    assert got == sorted(want, key=str)
    texts = dict(docs)
    assert all(texts[r.doc_id][r.start_char : r.end_char] == r.span for r in rows)
    whole = next(r for r in rows if r.doc_id == 2)
    assert whole.span.startswith("Permission is") and whole.span.endswith("THE SOFTWARE") and 0.95 < whole.coverage < 1
    assert licenses.scan_licenses(documents(spark, [])).count() == 0
    assert licenses.scan_licenses(documents(spark, docs), {"none": ""}).count() == 0


def test_winnowing_keeps_a_hash_of_every_window():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 50, 500).astype(np.uint64)
    kept = set(licenses.winnow(hashes, 4).tolist())
    for i in range(len(hashes) - 3):
        part = hashes[i : i + 4].tolist()
        assert i + max(j for j in range(4) if part[j] == min(part)) in kept


def test_alignment_counts_words_in_order():
    template = "a b c d e f g h".split()
    for document, matched in (("a b c d e f g h", 8), ("x a b d e f g h", 7), ("a b c q d e f g h", 8), ("a b c q e f g h", 7)):
        assert licenses.align(template, document.split(), 0, 4)[0] == matched


def found(text):
    return [(name, round(coverage, 2), text[first:end]) for name, coverage, _, first, end in licenses.scan(text, WordHashes(), licenses.build_index())]


def test_every_template_is_found_as_itself_over_its_whole_span():
    for name, text in licenses.TEMPLATES.items():
        (got,) = found(f"{sentence(1, 20)}. {text} {sentence(2, 20)}")
        assert got[:2] == (name, 1.0) and got[2].split()[0] == text.split()[0].strip("'") and got[2] in text
        assert len(got[2]) >= len(text) - 3


def test_licenses_of_one_family_are_told_apart():
    header = licenses.TEMPLATES["GPL-2.0-header"]
    assert [x[0] for x in found(header)] == ["GPL-2.0-header"]
    assert found(header.replace("version 2", "version 1")) == []
    assert found(header.replace("General", "Library General")) == []
    assert [x[0] for x in found(licenses.TEMPLATES["LGPL-3.0-header"].replace("version 3", "version 2.1"))] == ["LGPL-2.1-header"]
    assert found("Licensed under CC BY-SA 3.0.") == [] and found("Licensed under CC BY-NC-ND 4.0.") == []
    # A changed word makes no second find of the part that is whole, and one of a name no find of a longer license.
    assert [x[:2] for x in found(MIT.replace("AUTHORS", "WRITERS"))] == [("MIT", 0.99)]
    no_warranty = licenses.TEMPLATES["MIT-permission"]
    assert [x[0] for x in found(no_warranty)] == ["MIT-permission"]
    both = found(licenses.TEMPLATES["BSD-2-Clause"] + " " + sentence(3, 40) + " " + licenses.TEMPLATES["BSD-3-Clause"])
    assert [x[0] for x in both] == ["BSD-2-Clause", "BSD-3-Clause"]


def best_alignments(template, document):
    """Score of the best local alignments, and (matched words, first, last place) of each of them, without a band."""
    best, ends, before = 0.0, set(), [{0.0: {(0, -1)}}] * (len(document) + 1)
    for word in template:
        row = [{0.0: {(0, -1)}}]
        for j, other in enumerate(document):
            ways = {}
            for cell, gain in ((before[j], None), (before[j + 1], -0.5), (row[j], -0.5)):
                for score, states in cell.items():
                    equal = gain is None and word == other
                    value = score + (1 if equal else -0.5)
                    new = {(m + 1, s if s >= 0 else j) if equal else (m, s) for m, s in states}
                    ways.setdefault(value, set()).update(new)
            ways = {v: s for v, s in ways.items() if v > 0}
            top = max(ways, default=0.0)
            row.append({top: ways[top]} if ways else {0.0: {(0, -1)}})
            if top > best:
                best, ends = top, set()
            if top and top == best:
                ends |= {(m, s, j) for m, s in ways[top]}
        before = row
    return best, ends


def test_alignment_is_a_best_one():
    rng = np.random.default_rng(3)
    for _ in range(300):
        template, document = ([str(x) for x in rng.integers(0, 4, rng.integers(1, 14))] for _ in range(2))
        best, ends = best_alignments(template, document)
        got = licenses.align(template, document, 0, 30)
        assert got in ends if best else got[0] == 0
