"""BPE against the tokenizers library."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sightline.llm import bpe
from sightline.llm.queries import tokenizer_path
from tests.llm.conftest import ODD

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def check(lib, text):
    m = bpe.model(PATH)
    want = lib.encode(text, add_special_tokens=False).ids
    assert m.encode(text).tolist() == want, repr(text)[:200]
    assert m.decode(want) == lib.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(Tokenizer.from_file(PATH) if not hasattr(test_any_text, "lib") else test_any_text.lib, text)


test_any_text.lib = Tokenizer.from_file(PATH)


def test_hard_texts(lib):
    rnd = random.Random(1)
    for t in ["don't I'LL we've 123 4x5", "<|endoftext|>a<|startoftext|> <|endoftext", "ΑΣ ΣΑΣ İI", "é e ﬁ Å",
              "Ᲊa Ɤ \U00010d50 x͸y", "a b\x85c\xa0d\x1ce", "힣" * 5, "a" * 5000,
              "".join(rnd.choice("abcdefgh") for _ in range(3000)), "!" * 700 + "?!" * 300, "\U0001f600" * 200]:
        check(lib, t)


def test_documents(lib, doc_rows):
    for _, t in doc_rows[::3]:
        check(lib, t or "")


def test_forced_boundaries_are_in_no_token():
    m = bpe.model(PATH)
    word = "qzxjknownthingsandwxyzqq".encode()
    parts = m.fragments(word)
    assert b"".join(p for p, _ in parts) == word and [e for _, e in parts] == [False] * (len(parts) - 1) + [True]
    assert len(parts) > 1
    for (a, _), (b, ends) in zip(parts, parts[1:]):
        right = b[0] + (256 if ends and len(b) == 1 else 0)
        assert not m.joined[a[-1], right]


def test_frames(odd, empty, lib):
    both = bpe.decode(bpe.encode(odd, PATH, out_col="tok"), PATH, "tok", "back")
    assert both.columns == odd.columns + ["tok", "back"]
    got = sorted(((r.doc_id, r.tok, r.back) for r in both.collect()), key=repr)
    want = []
    for r in ODD:
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, lib.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    assert bpe.encode(empty, PATH, out_col="tok").collect() == []
