"""Personal data: the rules against plain patterns, and what contexts add."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sightline.llm import pii
from tests.llm import brute
from tests.llm.conftest import ODD


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1.@-+ ()4%\n9é", max_size=60))
def test_rules_equal_plain_patterns(text):
    assert pii.seeds(text) == brute.base_spans(text)


def test_rules_on_documents(doc_rows):
    found = 0
    for _, t in doc_rows:
        want = brute.base_spans(t)
        assert pii.seeds(t) == want
        found += len(want)
    assert found > 50


def test_rules_on_digit_runs():
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choice("0123456789 -.+()") for _ in range(rnd.randrange(80)))
        assert pii.seeds(t) == brute.base_spans(t)
    pii.seeds("9" * 200_000 + ".1" * 1000 + "a" * 200_000 + "@" * 1000)  # ends soon


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(df, **options):
    rows = pii.find_personal_data(df, **options).select("doc_id", pii.spans_text(
        pii.F.col("seeds")).alias("s"), pii.spans_text(pii.F.col("spans")).alias("a")).collect()
    return {r.doc_id: (r.s, r.a) for r in rows}


def test_contexts_discover_what_rules_miss(spark):
    """A pattern that precedes many known numbers tells that a number without
    a plus is one; the instance then supports a second pattern."""
    texts = [f"please call me on +1 (555) 010-{2000 + i} today" for i in range(12)]
    texts += ["please call me on 555 867 5309 today", "order number 555 111 2222 shipped",
              "write to contact me bob (at) example (dot) com"]
    texts += [f"write to contact me user{i}@mail.example.com" for i in range(9)]
    got = found(frame(spark, texts))
    assert got[12] == ("", f"phone:{texts[12].index('555')}:{texts[12].index(' today')}")
    assert got[13] == ("", "")          # the same shape behind another pattern
    assert got[14] == ("", f"email:{texts[14].index('bob')}:{len(texts[14])}")
    for i in range(12):
        assert got[i][0] == got[i][1] == brute.spans_text(brute.base_spans(texts[i]))
    assert found(frame(spark, texts), min_support=50)[12] == ("", "")


def test_unseen_identifiers_do_not_count_against_their_context(spark):
    """25 seeds and 75 lookalikes that no rule knows: all are found. Those
    that fail a check of the kind do count."""
    seen = [f"please call me on +1 (555) 010-{2000 + i} today" for i in range(25)]
    unseen = [f"please call me on 555 867 {5000 + i} today" for i in range(75)]
    dates = [f"the meeting was +1 (555) 020-{2000 + i} today" for i in range(10)]
    dates += [f"the meeting was 2024-01-{i + 10} today" for i in range(10)] + ["the meeting was 555 222 1111 today"]
    texts = seen + unseen + dates
    got = found(frame(spark, texts))
    for i in range(25, 100):
        assert got[i] == ("", f"phone:{texts[i].index('555')}:{texts[i].index(' today')}")
    assert all(got[i] == ("", "") for i in range(110, len(texts)))


def test_rounds_go_on_until_nothing_is_added(spark):
    """A chain of eight contexts, each known only through the one before."""
    number = [[f"555 {100 + h} {1000 + i}" for i in range(5)] for h in range(8)]
    texts = [f"first place0 +1 (555) 010-{2000 + i} x" for i in range(5)]
    for h in range(8):
        texts += [f"hop place{h} {n} x" if h else f"first place0 {n} x" for n in number[h]]
        texts += [f"hop place{h + 1} {n} x" for n in number[h]]
    got = found(frame(spark, texts))
    assert all(a.startswith("phone:") for _, a in got.values())


def test_checks_of_lookalikes():
    wrong = [(0, "bob@localhost"), (1, "12:30:45:10"), (2, "4111 1111 1111 1112"), (3, "2024-01-15"), (3, "1990-1995"),
             (3, "15.01.2024"), (3, "1234567.89")]
    unknown = [(0, "bob (at) example (dot) com"), (1, "1:2:3:4:5:6:7:8"), (2, "411111111111"), (3, "555 867 5309")]
    assert all(pii.fails(k, x) for k, x in wrong) and not any(pii.fails(k, x) for k, x in unknown)


def test_clean_documents_stay_clean(docs, doc_rows):
    got = found(docs)
    for i, t in doc_rows:
        want = brute.spans_text(brute.base_spans(t))
        assert got[i][0] == want
        if not want:
            assert got[i][1] == ""
        assert set(want.split(",")) <= set(got[i][1].split(","))


def test_odd(odd, empty):
    rows = pii.find_personal_data(odd).collect()
    got = sorted(((r.doc_id, tuple(tuple(s) for s in r.seeds)) for r in rows), key=repr)
    assert got == sorted(((r[0], tuple(brute.base_spans(r[1]))) for r in ODD), key=repr)
    assert pii.find_personal_data(empty).collect() == []


def test_query_counts_the_spans_of_each_kind(spark, tmp_path):
    """op10's counts are those of the rules, whatever a span's place is."""
    from sightline.llm.queries import QUERIES
    texts = ["10.0.0.1 and 10.0.0.2 then 10.0.0.3", "write a@b.example.com, c@d.example.com or 10.0.0.255",
             "card 4111 1111 1111 1111 or +1 (988) 555-2485 or +1 (988) 555-2486", "nothing", "", None]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        base = brute.base_spans(t)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(kind == j for _, kind, _ in base) for j in range(4)]
        assert got[i].base_sha256 == hashlib.sha256(brute.spans_text(base).encode()).hexdigest()
    assert [got[0].n_ip, got[1].n_email, got[2].n_phone] == [3, 2, 2]
