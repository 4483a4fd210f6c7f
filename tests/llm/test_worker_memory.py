"""Python workers live on from stage to stage: what one remembers may not stay beside the next."""

from types import SimpleNamespace

from pyspark import TaskContext

from curlew.llm.decontaminate import decontaminate
from curlew.llm.near_dups import shingled
from curlew.llm.packing import best_fit_pack
from curlew.llm.tokens import encoder, vocabulary

SF = "/root/testdata/sf0.001"


def test_stages_forget_the_encoders_words(spark, monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = {"mapInArrow": [], "mapInPandas": []}
    for name, functions in made.items():
        monkeypatch.setattr(type(docs), name, lambda self, f, *a, own=functions, real=getattr(type(docs), name): own.append(f) or real(self, f, *a))
    shingled(docs, 5, ["doc_id"])
    decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    best_fit_pack(docs, path, end_id=0)
    encodes, place = made["mapInPandas"]
    enc = encoder(path)
    whole = enc.encode(["some words of a text"])
    for f in (*made["mapInArrow"], place):
        assert enc.encode(["some words of a text"]) == whole
        assert enc.pieces and len(enc.keys)
        assert list(f(iter([]))) == []
        assert not enc.pieces and not len(enc.keys)
    enc.encode(["some words of a text"])
    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    list(encodes(iter([])))
    assert enc.pieces and len(enc.keys)  # kept from task to task within the stage
