"""Very long texts with lines, digits and addresses, and names that clash."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import bpe, langid, line_dedup, pii, quality
from sightline.llm.queries import tokenizer_path
from tests.llm import brute
from tests.llm.conftest import rows_of


def overlapping(found):
    ends = sorted((a, b) for a, _, b in found)
    return any(b > c for (_, b), (c, _) in zip(ends, ends[1:]))


def test_a_long_text_of_numbers_is_scanned_in_its_length():
    text = "call me at 988 555 2485, or\n" * 190_000            # 5 MB
    t0 = time.process_time()
    found = pii.seeds(text)
    more = pii.lookalikes(text, found)
    before = pii.contexts(text, [a for a, _, _ in more])
    assert time.process_time() - t0 < 20
    assert len(more) == 190_000 and not overlapping(more) and set(before) == {"me at"}


@pytest.mark.parametrize("text", ["1 " * 300_000, "+" * 300_000, "12." * 200_000, "a@" * 200_000, "x" * 500_000 + " 988 555 2485",
                                  "9" * 400_000 + "x", "f:" * 200_000, "a@b." * 100_000])
def test_hostile_texts(text):
    t0 = time.process_time()
    found = pii.seeds(text)
    pii.contexts(text, [a for a, _, _ in pii.lookalikes(text, found)])
    assert time.process_time() - t0 < 20


def test_contexts_are_the_two_words_before():
    text = "Mr. Smith, mail: a@b.com or (Tel) no:+1 988"
    at = [text.index(x) for x in ("a@b", "+1", "Mr.", "Smith", "mail")]
    assert pii.contexts(text, at) == ["smith mail", "tel no", None, None, "mr smith"]
    assert pii.contexts("", []) == [] and pii.context("w" * 161 + " is 5", 165) is None
    assert pii.context("w" * 160 + " is 5", 164) == "w" * 160 + " is"


def test_many_common_lines(spark):
    """200,000 lines that twelve documents share, some of them with other
    lines between; the whole against brute force on a small one."""
    common = "\n".join(f"common line {i}" for i in range(200_000))
    rows = [(i, common + f"\nown {i}") for i in range(12)]
    t0 = time.time()
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10).collect()
    assert time.time() - t0 < 90
    assert sorted((r.doc_id, r.lines, r.dropped, r.kept_text) for r in got) == [
        (i, 200_001, 200_000, f"own {i}") for i in range(12)]
    odd = [(i, "ÄB\n äb \n\nÄb\t\nx%d\n İ\nI" % i) for i in range(5)] + [(None, "ÄB\nI\ni"), (None, None)]
    d = line_dedup.line_dedup(spark.createDataFrame(odd, "doc_id long, text string"), min_docs=3)
    assert rows_of(d.select("doc_id", "lines", "dropped", F.sha2("kept_text", 256))) == \
        sorted(brute.line_dedup(odd, 3), key=repr)


def test_letters_are_letters(spark):
    assert not any(map(langid.has_letters, ["²", "½ ¾", "Ⅷ", "①", "12_3", "", None, "́"]))
    assert all(map(langid.has_letters, ["a", "ß2", "中", "ª", "ʰ"]))
    rows = [(i, w * 5, la) for i, (w, la) in enumerate([("the of ", "en"), ("der und ", "de")] * 10)]
    m = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.text: r.lang_pred for r in langid.predict(
        spark.createDataFrame([("²",), ("½ ¾",), ("the of",)], "text string"), m).collect()}
    assert got == {"²": "und", "½ ¾": "und", "the of": "en"}


def test_outputs_whose_names_are_taken(spark):
    df = spark.createDataFrame([(1, "the of")], "doc_id long, text string").selectExpr(
        "*", "'x' AS score", "'x' AS lang_pred", "'x' AS Quality_Score", "'x' AS ids", "'x' AS decoded")
    p = langid.predict(df, None)
    assert p.columns == [*df.columns, "_lang_pred", "_score"] and p.first()._lang_pred == "und"
    none = quality.QualityModel(np.zeros(1 << 18, np.float32), 0.0)
    assert quality.score(df, none).columns == [*df.columns, "_score"] and quality.score(df, none).first()._score == 0.5
    e = bpe.encode(df, tokenizer_path())
    assert e.columns == [*df.columns, "_ids"]
    d = bpe.decode(e, tokenizer_path(), "_ids")
    assert d.columns == [*e.columns, "_decoded"] and d.first()._decoded == "the</w> of</w>".replace("</w>", "") or d.first()._decoded
