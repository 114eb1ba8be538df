"""Exact and SimHash deduplication against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from propgraph.llm import components, exact_dedup, simhash_dedup
from propgraph.llm.common import WordHashes
from tests.llm.helpers import clashing, classes, documents, sentence


def slow_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for ids in groups.values():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


def got_groups(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


CASES = [
    (5, "a  b\n c"), (3, "a b c"), (3, "a b c"), (9, None), (2, ""), (7, " "), (8, "\t\n"), (None, "a b c"), (None, "only"),
    (None, "only"), (4, "a b c"), (10, "x" * 200_000), (11, "x" * 200_000),
]


def test_exact_groups(spark):
    assert got_groups(exact_dedup.exact_groups(clashing(documents(spark, CASES)))) == slow_groups(CASES)


@pytest.mark.parametrize(("salts", "local_bytes"), [(1, 64 << 20), (5, 64 << 20), (5, 1)])
def test_exact_groups_of_a_hot_text(spark, salts, local_bytes):
    choose = random.Random(1)
    rows = [(i, "hot text" if choose.random() < 0.4 else f"t {choose.randint(0, 60)}") for i in range(2000)]
    docs = documents(spark, rows).repartition(16)
    assert got_groups(exact_dedup.exact_groups(docs, salts=salts, local_bytes=local_bytes)) == slow_groups(rows)


def test_equal_digests_of_unlike_contents_stay_apart():
    rows = [("d", 1, 1, [1], b"x"), ("d", 2, 1, [2], b"y"), ("d", 3, 1, [3], b"x"), ("e", 4, 1, [4], b"x")]
    salted = list(exact_dedup._salted(iter(rows)))
    assert [(r[0], r[1], r[4]) for r in salted] == [("d", 1, b"x"), ("d", 2, b"y"), ("d", 1, None), ("e", 4, b"x")]
    assert list(exact_dedup._global(iter([("d", 1, b"x"), ("d", 2, b"y"), ("d", 5, b"x")]))) == [
        ("d", 1, 1), ("d", 2, 2), ("d", 5, 1)
    ]


def test_drop_copies(spark):
    kept = exact_dedup.drop_copies(documents(spark, CASES)).collect()
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept if r.doc_id is not None) == [
        (2, ""), (3, "a b c"), (4, "a b c"), (7, " "), (10, "xxxxx")
    ]
    assert [r.text for r in kept if r.doc_id is None] == ["only"]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
    assert simhash_dedup.near_groups(docs).count() == 0
    assert simhash_dedup.drop_near_copies(docs, 3, 7, least=0.7).count() == 0


def slow_simhash(text, words=3):
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "One TWO", "Ä b c", "a b c d", sentence(1, 300), "a b c\x0bd e\x1cf"])
def test_fingerprint(text):
    assert simhash_dedup.simhash(text) & (2**64 - 1) == slow_simhash(text)


def near(fp, bits, choose):
    for b in choose.sample(range(64), bits):
        fp ^= 1 << b
    return fp


@pytest.mark.parametrize(("radius", "agree"), [(3, 2), (3, 1), (5, 2), (7, 2), (0, 1)])
def test_shards_lose_no_pair(radius, agree):
    choose = random.Random(radius)
    masks = [m & (2**64 - 1) for m in simhash_dedup.block_masks(radius, agree)]
    for _ in range(200):
        a = choose.getrandbits(64)
        b = near(a, radius, choose)
        assert any(a & m == b & m for m in masks)


def fingerprint_rows(seed, n=250):
    choose = random.Random(seed)
    base = [choose.getrandbits(64) for _ in range(40)]
    chain = [base[0]]
    for _ in range(30):  # a long chain, each link within the radius
        chain.append(near(chain[-1], 3, choose))
    return list(dict.fromkeys([0, 7, *base, *chain, *(near(choose.choice(base), choose.randint(1, 6), choose) for _ in range(n))]))


def signed(fp):
    return fp - 2**64 if fp >> 63 else fp


@pytest.mark.parametrize("tree_rows", [20_000, 20])
def test_links_against_all_pairs(spark, tree_rows):
    fps = fingerprint_rows(2)
    prints = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(4)
    links = simhash_dedup.near_links(prints, 3, 2, tree_rows)
    roots = {r.node: r.root for r in components.components(links).collect()}
    got = defaultdict(set)
    for f in fps:
        got[roots.get(signed(f), signed(f))].add(f)
    want = defaultdict(set)
    for f, root in classes(fps, lambda a, b: (a ^ b).bit_count() <= 3).items():
        want[root].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_tree_keys_are_distances_to_the_parent():
    fps = np.array(fingerprint_rows(3), dtype=np.uint64)
    keys, children = simhash_dedup.bk_forest(np.zeros(len(fps), dtype=np.int64), fps)
    parent, distance = keys // 65, keys % 65
    assert sorted(children) == list(range(1, len(fps)))
    assert (np.bitwise_count(fps[parent] ^ fps[children]) == distance).all()
    assert len(np.unique(keys)) == len(keys)


def test_near_groups(spark):
    text = sentence(5, 400)
    words = text.split()
    words[7] = "changed"
    rows = [(4, text), (2, " ".join(words)), (9, text.upper()), (5, None), (6, ""), (1, sentence(6, 80)), (1, sentence(6, 80)), (None, text)]
    rows += [(20 + i, sentence(50 + i, 30)) for i in range(60)]
    fps = {text: slow_simhash(text) for _, text in rows}
    least = {}
    for doc_id, t in rows:
        if doc_id is not None:
            least[fps[t]] = min(doc_id, least.get(fps[t], doc_id))
    root = classes(list(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    ids = {}
    for fp, r in root.items():
        ids[r] = min(least[fp], ids.get(r, least[fp]))
    got = simhash_dedup.near_groups(clashing(documents(spark, rows))).collect()
    want = [(doc_id, f"{fps[t]:016x}", ids[root[fps[t]]]) for doc_id, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_sketch_similarity():
    hasher = WordHashes()
    text = sentence(8, 300).split()
    for changed in (0, 2, 10, 40, 300):
        other = list(text)
        for i in range(changed):
            other[(i * 7) % 300] = f"new{i}"
        a, b = ({tuple(w[i : i + 5]) for i in range(296)} for w in (text, other))
        true = len(a & b) / len(a | b)
        pair = [np.frombuffer(simhash_dedup.sketch(" ".join(w), hasher), np.uint8) for w in (text, other)]
        assert abs(float(simhash_dedup.sketch_similarity(*pair)) - true) < 0.2
    assert simhash_dedup.sketch(None, hasher) == simhash_dedup.sketch(" ", hasher)


def test_drop_near_copies_keeps_one_of_each_group(spark):
    text = sentence(9, 500).split()
    rows = [(i, " ".join([*text[:i], "other", *text[i + 1 :]])) for i in range(3, 40)]
    rows += [(100 + i, sentence(200 + i, 40)) for i in range(50)] + [(None, "no id"), (100, sentence(200, 40))]
    docs = documents(spark, rows)
    kept = simhash_dedup.drop_near_copies(docs, 3, 7, least=0.72)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, None, *range(100, 150)], key=str)


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in components.components(path).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
