import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sightline.llm import packing
from sightline.llm.queries import QUERIES, tokenizer_path
from sightline.session import materialize
from tests.conftest import SF_ORACLE
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check_layout(rows, capacity):
    """rows: (length, sequence, offset). Every sequence is gapless from 0."""
    by = {}
    for length, seq, off in rows:
        by.setdefault(seq, []).append((off, length))
    for places in by.values():
        at = 0
        for off, length in sorted(places):
            assert off == at
            at += length
        assert at <= capacity
    return len(by)


def expected(doc_rows, library, capacity=4096, end=1):
    out = []
    for i, text in doc_rows:
        ids = library(text) + [end]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((i, p, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return sorted(out, key=repr)


def test_query_against_the_library(spark, doc_rows, library):
    got = [tuple(r) for r in QUERIES["op11_packing"](spark, SF_ORACLE).collect()]
    assert sorted((r[:5] for r in got), key=repr) == expected(doc_rows, library)
    made = check_layout([(r[3], r[5], r[6]) for r in got], 4096)
    assert made <= 1.02 * sum(r[3] for r in got) / 4096 + 1


def test_odd_rows(spark, odd, empty, library):
    got = packing.pack_documents(odd, tokenizer_path(), capacity=64)
    rows = [tuple(r) for r in got.collect()]
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted((r[:5] for r in rows), key=repr) == expected(texts, library, 64)
    check_layout([(r[3], r[5], r[6]) for r in rows], 64)
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_levels(spark):
    """Many packers, few open bins: what they leave open is packed again."""
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in np.minimum(100, 1 + rng.exponential(18, 6000))]
    items = materialize(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "item long, length long"), "items")
    got = packing.best_fit(items, "length", capacity=100, open_bins=4, block=100)
    rows = [tuple(r) for r in got.collect()]
    assert sorted((r[0], r[1]) for r in rows) == list(enumerate(sizes))
    made = check_layout([r[1:] for r in rows], 100)
    assert made <= 1.08 * sum(sizes) / 100
    again = packing.best_fit(items, "length", capacity=100, open_bins=4, block=100)
    assert rows_of(again) == rows_of(got)


def test_sequences_hold_the_ids(spark, docs, library):
    some = docs.where("doc_id < 30")
    packed = packing.pack_documents(some, tokenizer_path(), capacity=256, with_ids=True)
    packed = materialize(packed, "packed-ids")
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    back = {}
    for r in packed.select("doc_id", "start", "length", "sequence_id", "offset").collect():
        back.setdefault(r.doc_id, []).append((r.start, whole[r.sequence_id][r.offset:r.offset + r.length]))
    for d in some.select("doc_id", "text").collect():
        assert [x for _, part in sorted(back[d.doc_id]) for x in part] == library(d.text) + [1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(1, 6))
def test_fill_bins_is_best_fit(sizes, open_bins):
    """The bitset packer does what a scan over a list of open bins does."""
    bins, offsets, still = packing.fill_bins(sizes, 50, open_bins)
    left = {}                                   # open bins, the one that changed last comes last
    for size, b, off in zip(sizes, bins, offsets):
        fits = [f for f in left.values() if f >= size]
        if fits:
            assert b == [x for x, f in left.items() if f == min(fits)][-1]
        else:
            assert b not in left
            if len(left) == open_bins:
                del left[[x for x, f in left.items() if f == min(left.values())][-1]]
            left[b] = 50
        free = left.pop(b)
        assert off == 50 - free
        if free > size:
            left[b] = free - size
    assert sorted(still) == sorted(left)
    assert len(still) <= open_bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_encoder_equals_library(library, texts):
    got = [x.tolist() for x in packing.Encoder(tokenizer_path()).encode(texts)] if texts else []
    assert got == [library(t) for t in texts]


def test_encoder_long_and_special(library):
    texts = ["x" * 100_000, "ab" * 5000, "<|endoftext|> a <|startoftext|>b", "", None, "ΑΣ ς İ ß \x1c\x85 a b", "it's'll we've 1234 ½²",
             "na" * 30 + " " + "na" * 30, "!" * 300]
    got = [x.tolist() for x in packing.Encoder(tokenizer_path()).encode(texts, together=10)]
    assert got == [library(t) for t in texts]
