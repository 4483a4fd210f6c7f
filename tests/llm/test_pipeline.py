"""The corpus pipeline against plain versions of its stages."""

import brute
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from curlew.llm.queries import QUERIES
from curlew.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"


def cut(docs, width=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            first[b[p : p + width]] = min(first.get(b[p : p + width], d), d)
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < d:
                gone[p : p + width] = b"\1" * width
        out.append((d, bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")))
    return out


def test_run_equals_plain_stages(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    good = {r.doc_id for r in QUERIES["op10_host_quality_rules"](spark, SF).collect() if r.kept}
    docs = [(d, x) for d, x in zip(t["doc_id"], t["text"], strict=True) if d in good]
    label = brute.components(docs, 5, 80)
    docs = cut([(d, x) for d, x in docs if label[d][1] == d])
    b = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    items = list(zip(b["item_id"], b["text"], strict=True))
    bad = {r[0] for r in brute.contaminated(docs, items)}
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, SF).collect()]
    ids = {r[0] for r in got}
    assert ids == {d for d, _ in docs} - bad
    brute.check_packing(got, [x for x in docs if x[0] in ids], vocabulary("byte_bpe_50k.json"), 0, 2048)


@pytest.mark.parametrize("which", ["odd", "empty", "nulls"])
def test_stages_keep_columns(spark, request, which):
    folder = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns and out.count() <= n, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= n
