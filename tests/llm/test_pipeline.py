"""The pipeline's stages and the registered queries."""

import duckdb
import pytest

import corpus_pipeline
from scripts.check_oracle import TABLES, rows_of
from sightline.llm import bpe
from sightline.llm.queries import ORACLE, QUERIES, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages_follow_the_contract():
    assert len(corpus_pipeline.STAGES) == 5
    assert [n[:3] for n, _ in corpus_pipeline.STAGES] == ["qua", "exa", "sim", "mix", "bpe"]
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages_one_by_one(spark):
    """Each stage against a plain version, on all that the one before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    kept = {}
    for n in names[:-1]:
        out = stages[n](spark, docs, SF_SMALL).cache()
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept[n] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()])
        docs = out
    before, after = kept[names[0]]
    good = [r for r in before if labels.get(r[0]) == 1]
    assert len({r[0] for r in after} & {r[0] for r in good}) >= 0.97 * len(good)
    before, after = kept[names[1]]
    want = {i for i, _, _, k, _ in brute.exact([(r[0], r[1]) for r in before]) if k}
    assert {r[0] for r in after} == want and len(after) == len(want)
    before, after = kept[names[2]]
    want = {i for i, _, c in brute.simhash([(r[0], r[1]) for r in before]) if i == c}
    assert {r[0] for r in after} == want and len(after) == len(want)
    before, after = kept[names[3]]
    sizes, words = {}, {}
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + len(brute.WORD.findall(r[1] or ""))
    for r in after:
        words[r[3]] = words.get(r[3], 0) + len(brute.WORD.findall(r[1] or ""))
    longest = max(len(brute.WORD.findall(r[1] or "")) for r in before)
    for s, t in brute.targets(sizes).items():
        assert abs(words.get(s, 0) - t) <= longest
    m = bpe.model(tokenizer_path())
    last = stages[names[-1]](spark, docs, SF_SMALL).collect()
    texts = {r[0]: r[1] for r in after}
    assert len(last) == len(after)
    for r in last:
        assert r.ids == m.encode(texts[r.doc_id]).tolist() and r.decoded == m.decode(r.ids)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and "ids" in out.columns


@pytest.mark.parametrize("what", ["odd", "empty"])
def test_stages_on_odd_rows(spark, request, what):
    docs = request.getfixturevalue(what)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert rows == 0 or what == "odd"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in [*TABLES, "documents"]:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_its_whole_table(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("documents", "embeddings")}
    if name == "op3_ann":
        n = 5 * -(-rows["embeddings"] // 50)
    elif name == "op11_packing":                                   # pieces of 4,096 tokens, one end id a document
        n = sum(-(-(r.n_tokens + 1) // 4096) for r in QUERIES["op2_bpe"](spark, SF_SMALL).select("n_tokens").collect())
    elif name == "op12_trie":                                      # nodes
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
        n = len(con.execute(ORACLE[name]).fetchall())
    else:
        n = rows["embeddings" if name == "op13_codes" else "documents"]
    assert df.count() == n
