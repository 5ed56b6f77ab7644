"""The pipeline against brute force, stage by stage on its own input."""

import re

import public_tokenizers as P
import tiktoken
from tidelog.llm import bpe, mixing

from tests.llm.test_documents import brute_links, normal

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        assert k == 4 or docs.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} <= {r.doc_id for r in before if not re.search(r"[^\W\d_]", r.text or "") or len(r.text) < 40}
        elif name == "exact_dedup":
            first = {}
            for r in sorted(before, key=lambda r: r.doc_id):
                first.setdefault(normal(r.text), r)
            assert sorted(after) == sorted(first.values())
        elif name == "near_dedup":
            _, classes = brute_links([(r.doc_id, r.text) for r in before])
            assert sorted(r.doc_id for r in after) == sorted(i for i, c in classes.items() if i == c)
        elif name == "mixing":
            row = {r.doc_id: r for r in before}
            assert sorted(after) == sorted(row[r.doc_id] for r in mixing.plan(spark.createDataFrame(before)).collect() if r.size for _ in range(-(-r.taken // r.size)))
        else:
            enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
            assert sorted((r.doc_id, r.ids) for r in after) == sorted((r.doc_id, enc.encode_ordinary(r.text)) for r in before)


def test_mix_keeps_documents_whole(spark):
    import corpus_pipeline
    from tidelog.llm import mixing

    docs = spark.createDataFrame([(i, f"a{i}  b\n" + " ".join(f"w{k}" for k in range(40 + 300 * (i % 7))), "en", "abc"[i % 5 // 2]) for i in range(90)], "doc_id long, text string, lang string, source string")
    row = {r.doc_id: r for r in docs.collect()}
    plan = mixing.plan(docs).collect()
    assert any(r.taken % r.size for r in plan)
    want = sorted(row[r.doc_id] for r in plan for _ in range(-(-r.taken // r.size)))
    assert sorted(corpus_pipeline.mix(spark, docs, SF).collect()) == want


def test_awkward_rows(spark, awkward, nothing):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns and an empty table pass all stages."""
    import corpus_pipeline

    for df, kept in ((awkward, {1, 6, 8, None}), (nothing, set())):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, stage(spark, docs, SF)
        assert {r.doc_id for r in docs.collect()} <= kept and docs.columns[:3] == ["doc_id", "lang", "source"] and columns == df.columns
