"""The pipeline's stages against brute-force versions, and the registered queries against DuckDB."""

import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cinerank.llm import mixing, queries
from test_neardup import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_filter(spark, docs, SF)
    assert good.columns == docs.columns
    rows = {r.doc_id: r for r in good.collect()}
    last = {}
    for i, r in rows.items():
        last[r.text or ""] = max(i, last.get(r.text or "", -1))
    unique = sorted(last.values())
    assert sorted(r.doc_id for r in corpus_pipeline.exact_dedup(spark, good, SF).collect()) == unique
    kept = [r[0] for r in near_brute([(i, rows[i].text) for i in unique], 5) if r[3]]
    near = corpus_pipeline.near_dedup(spark, good.filter(good.doc_id.isin(unique)), SF)
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == sorted(kept)
    mixed = corpus_pipeline.mix_sources(spark, near, SF)
    assert mixed.columns == docs.columns
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for r in mixed.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids_le), r.decoded) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_stages_take_odd_rows(spark, docs_of):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)), rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(None, "null id text here now", "a"), (None, None, None), (50, ""), (50, ""), (51, rows[0][1], "a"), (52, "word " * 40_000, "b")]
    for df in (docs_of(rows), docs_of([])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            out.collect()
        assert corpus_pipeline.bpe_encode(spark, df, SF).count() == df.count()


def test_mix_stage_meets_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: (r.source, len(r.text.split())) for r in docs.collect()}
    want = {rows[r.doc_id][0]: r.target for r in mixing.mix(docs).collect()}
    out = corpus_pipeline.mix_sources(spark, docs, SF).groupBy("doc_id").count().collect()
    taken = {}
    for r in out:
        assert r["count"] <= 3
        source, size = rows[r.doc_id]
        taken[source] = taken.get(source, 0) + r["count"] * size
    for source, target in want.items():
        assert abs(taken.get(source, 0) - target) <= max(n for s, n in rows.values() if s == source) / 2 + 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    sys.path.insert(0, __file__.rsplit("/llm/", 1)[0])
    from oracle_check import digest, duck
    df = queries.QUERIES[name](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    con = duck(SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(cols, cur.fetchall())[0] == got[0]
