"""Packing: every id in exactly one piece, and the limits of a sequence."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from propgraph.llm import packing
from propgraph.llm.queries import tokenizer_path
from tests.llm.helpers import clashing, documents, sentence


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")


def test_encoder_equals_the_tokenizer(tokenizer):
    choose = random.Random(1)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "1", "²", "!!", "<|endoftext|>", " ", "日本", "\x1c", "😀", "́"]
    texts = ["".join(choose.choice(parts) for _ in range(choose.randint(0, 30))) for _ in range(3000)]
    encode = packing.Encoder(tokenizer_path(), cache_words=500)
    for i in range(0, len(texts), 50):
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts[i : i + 50], add_special_tokens=False)]
        assert encode(texts[i : i + 50]) == want


def check(rows, ids, limits, prompts=None):
    """Rows against the ids of each example; returns the lengths of the sequences."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        data = ids[r.doc_id]
        assert r.doc_tokens == len(data)
        assert r.ids_crc32 == zlib.crc32(data[r.start : r.start + r.length].tobytes())
        before = prompts[r.doc_id] if prompts else 0
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, before))
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length, r.loss_tokens))
    assert pieces.keys() == ids.keys()
    for doc_id, own in pieces.items():
        place = 0
        for start, length in sorted(own):
            assert start == place and length > 0
            place += length
        assert place == len(ids[doc_id])
    for own in sequences.values():
        place = 0
        for offset, length, _ in sorted(own):
            assert offset == place
            place += length
        assert place <= limits.tokens and len(own) <= limits.segments and sum(x[2] for x in own) <= limits.loss
    return [sum(x[1] for x in own) for own in sequences.values()]


def test_documents(spark, tokenizer):
    rows = [(i, sentence(i, i % 90)) for i in range(300)] + [(900, None), (901, ""), (902, sentence(3, 20_000))]
    got = packing.pack(clashing(documents(spark, rows)), tokenizer_path()).collect()
    lengths = check(got, {i: ids_of(tokenizer, t or "") for i, t in rows}, packing.Limits())
    padding = sum(1024 - n for n in lengths if n & (n - 1))
    assert padding <= 0.01 * sum(lengths)


def test_short_documents_need_no_padding(spark, tokenizer):
    """Sequences that are full of segments are not filled up to the limit of tokens."""
    rows = [(i, sentence(i, 3)) for i in range(3000)]
    lengths = check(packing.pack(documents(spark, rows), tokenizer_path()).collect(), {i: ids_of(tokenizer, t) for i, t in rows}, packing.Limits())
    assert all(n & (n - 1) == 0 for n in lengths)


@pytest.mark.parametrize("limits", [packing.Limits(128, 4, 60), packing.Limits(64, 1, 64), packing.Limits(256, 100, 5)])
def test_limits_on_segments_and_loss(spark, tokenizer, limits):
    rows = [(i, sentence(i, i % 40), sentence(i + 500, i % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, answer string").repartition(3)
    got = packing.pack(df, tokenizer_path(), response="answer", prompt="prompt", limits=limits, pool=40).collect()
    ids, prompts = {}, {}
    for i, a, b in rows:
        ids[i] = np.concatenate([ids_of(tokenizer, a)[:-1], ids_of(tokenizer, b)])
        prompts[i] = len(ids_of(tokenizer, a)) - 1
    check(got, ids, limits, prompts)


def test_empty_table_null_ids_and_repeated_rows(spark, tokenizer):
    assert packing.pack(documents(spark, []), tokenizer_path()).count() == 0
    got = packing.pack(documents(spark, [(None, "a"), (1, "b"), (1, "b")]), tokenizer_path()).collect()
    assert sorted((r.doc_id is None, r.doc_tokens) for r in got) == [(False, 2), (False, 2), (True, 2)]


def test_the_fitting_piece_with_the_largest_dot_product_goes_first():
    packer = packing.Packer(packing.Limits(100, 3, 100), pool=1)
    sequences = [s for n in (30, 70, 20, 60, 15) for s in packer.add(n, n, 0)] + list(packer.finish())
    assert [p[0] for p in sequences[0]][:2] == [70, 30]
    with pytest.raises(ValueError):
        packing.Limits(0)
