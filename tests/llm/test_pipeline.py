"""The corpus pipeline against its operators in plain Python, stage by stage."""

import corpus_pipeline
from lakewright.llm import substring_dedup
from tests.llm.test_near import plain_components
from tests.llm.test_tokens import check_pieces


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, sf).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    toxic, exact, near, strip, packed = kept
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r.doc_id for r in toxic}
    marked = [k for k, t in labels.items() if t]
    assert sum(k in left for k in marked) <= 0.2 * len(marked) and len(left) >= 200 - 2 * len(marked)
    last = {}
    for r in toxic:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in exact) == sorted(last.values())
    groups = plain_components({r.doc_id: r.text for r in exact})
    assert sorted(r.doc_id for r in near) == sorted(k for k, (_, c) in groups.items() if k == c)
    held, settings = set(), substring_dedup.Settings()
    texts = {r.doc_id: r.text for r in strip}
    for r in sorted(near, key=lambda r: r.doc_id):
        text = r.text.encode()
        spans = substring_dedup.repeated_spans(text, held, settings)[2]
        cuts = [0, *[x for s in spans for x in s], len(text)]
        assert texts[r.doc_id].encode() == b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
        held |= set(substring_dedup.chunk_digests(text, substring_dedup.chunk_ends(text, settings)))
    assert all(r.n_chars == len(r.text) for r in strip) and len(strip) == len(near)
    check_pieces(packed, texts)
    assert corpus_pipeline.run(spark, sf).count() == len(packed)
