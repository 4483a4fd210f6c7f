"""File sources, collection and sinks, each read back."""

import json
import re

import pytest
from pyspark.sql import functions as F

from curlew.functions.text import chunks_of, json_shape, read_page
from curlew.operators import export
from curlew.plans.plan import Plan
from curlew.sources import files, web


def raw(df):
    return [json.loads(r.raw) for r in df.orderBy("seq").collect()]


def test_formats_and_jsonl(spark, tmp_path):
    assert [files.detect_format(f"a/b{x}") for x in (".jsonl", ".NDJSON", ".json", ".csv")] == ["jsonl", "jsonl", "json", "csv"]
    with pytest.raises(ValueError):
        files.detect_format("a.parquet")
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n  \n{"a": "é\\n"}\n', encoding="utf-8")
    assert raw(files.read_records(spark, str(tmp_path / "a.jsonl"))) == [{"a": 1}, {"a": "é\n"}]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n[1]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        files.read_records(spark, str(tmp_path / "b.jsonl")).collect()


def test_json_array_and_object(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": k, "t": "x\ny"} for k in range(3)], indent=1))
    assert raw(files.read_records(spark, str(tmp_path / "a.json"))) == [{"k": k, "t": "x\ny"} for k in range(3)]
    (tmp_path / "b.json").write_text('{"k": 9}')
    assert raw(files.read_records(spark, str(tmp_path / "b.json"))) == [{"k": 9}]


def test_csv_in_and_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text('instruction,response\n"one, ""two""\nthree",4\n,x\n')
    assert raw(files.read_records(spark, str(tmp_path / "a.csv"))) == [{"instruction": 'one, "two"\nthree', "response": "4"}, {"instruction": "", "response": "x"}]
    df = spark.createDataFrame([('a,"b"\nc', None), ("é", "")], "x string, y string")
    export.write_csv(df, str(tmp_path / "out"), files=1)
    back = spark.read.csv(str(tmp_path / "out"), header=True, multiLine=True, escape='"')
    assert sorted(r.x for r in back.collect()) == ['a,"b"\nc', "é"] and {r.y for r in back.collect()} == {None}


def test_tree_of_files(spark, tmp_path):
    for name, data in {"a.md": b"# one", "sub/b.PY": b"x = 1", "sub/c.csv": b"a,b", "d.bin": b"\0", "node_modules/e.js": b"no", "sub/.mypy_cache/f.json": b"{}", "g.cfg": "é".encode("latin-1"), "h.tsx": b"no", "build/i.xml": b"<a/>", "j.xml": b"<a/>"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = files.walk(spark, str(tmp_path)).select(F.regexp_replace("path", ".*/", "").alias("name"), files.decode(F.col("content")).alias("text")).collect()
    assert [(r.name, r.text) for r in got] == [("a.md", "# one"), ("g.cfg", "é"), ("j.xml", "<a/>"), ("b.PY", "x = 1")]
    assert files.walk(spark, str(tmp_path), max_files=2).count() == 2
    recs = web.collect_files(spark, str(tmp_path)).collect()
    assert len(recs) == 4 and {r.status for r in recs} == {"collected"} and {r.source_type for r in recs} == {"raw_dataset"}


def test_batches_schema_plan_reviews(spark, tmp_path):
    for n in ("b2.jsonl", "b1.jsonl"):
        (tmp_path / n).write_text('{"id": "r1", "score": 5, "reason": "good", "status": "PASS"}\n')
    paths = files.resolve_batches([str(tmp_path / "b2.jsonl")], str(tmp_path / "b*.jsonl"))
    assert [p[-8:] for p in paths] == ["b2.jsonl", "b1.jsonl"]
    with pytest.raises(FileNotFoundError):
        files.resolve_batches([str(tmp_path / "none.jsonl")])
    assert [tuple(r)[:4] for r in files.read_reviews(spark, paths[0]).collect()] == [("r1", "5", "good", "PASS")]
    (tmp_path / "s.json").write_text('{"name": "x", "mode": "flat", "columns": [{"name": "", "source": ""}]}')
    with pytest.raises(ValueError, match=r"columns\[0\]\.name"):
        files.load_flat_schema(str(tmp_path / "s.json"))
    (tmp_path / "p.json").write_text('{"target_effective_count": 2, "required_fields": ["a", "a"]}')
    assert Plan.load(str(tmp_path / "p.json")).target == 2 and Plan.load(None).spec == {} and Plan.load(str(tmp_path / "p.json")).required() == ["a"]
    (tmp_path / "q.json").write_text("[]")
    with pytest.raises(ValueError):
        Plan.load(str(tmp_path / "q.json"))


def test_fetch_search_and_merge(spark):
    def fetcher(url):
        return (url, f"<title>{url}</title><p>text of {url}</p>", 200, None) if "good" in url else (url, None, None, "OSError: no")

    urls = spark.createDataFrame([("good1",), ("bad",), ("good2",)], "url string")
    pages = web.fetch(urls, fetcher, delay=0)
    assert {(r.url, r.status, r.error) for r in pages.collect()} == {("good1", 200, None), ("good2", 200, None), ("bad", None, "OSError: no")}

    def fails(query, limit):
        raise OSError("down")

    found = web.search("q", [fails, lambda q, n: [], lambda q, n: [{"title": "t", "url": "u", "snippet": "s"}] * 3], limit=2)
    assert len(found) == 2 and web.search("q", [fails]) == []
    with_snippet = pages.withColumn("snippet", F.lit("a snippet"))
    got = {r.source_uri: r for r in web.collect_pages(with_snippet).collect()}
    assert got["bad"].response.text == "a snippet" and got["good1"].context == "good1" and "text of good1" in got["good1"].response.text
    twice = web.merge_collected(web.collect_pages(with_snippet), web.collect_pages(with_snippet))
    assert twice.count() == 3


def test_search_results_of_each_backend():
    answer = {"organic_results": [{"title": "a", "link": "u1", "snippet": "s"}, {"link": "u2"}]}
    assert web.parse_results("serpapi", json.dumps(answer), 1) == [{"title": "a", "url": "u1", "snippet": "s"}]
    assert web.parse_results("bing", json.dumps({"webPages": {"value": [{"name": "b", "url": "u", "snippet": "t"}]}}), 5) == [{"title": "b", "url": "u", "snippet": "t"}]
    assert web.parse_results("google_cse", json.dumps({"items": [{"title": "c", "link": "v"}]}), 5) == [{"title": "c", "url": "v", "snippet": ""}]
    page = '<div class="result"><h2 class="result__title"><a href="//x.com/l/?uddg=https%3A%2F%2Fa.org%2Fp&amp;rut=1">A &amp; B</a></h2><a class="result__snippet">sn <b>ip</b></a></div><div class="result"><h2 class="result__title"><a href="https://c.org">C</a></h2></div>'
    assert web.parse_results("duckduckgo_html", page, 5) == [{"title": "A & B", "url": "https://a.org/p", "snippet": "sn ip"}, {"title": "C", "url": "https://c.org", "snippet": ""}]
    assert web.parse_results("bing", "no json", 5) == []


def test_lines_are_ascii(spark, tmp_path):
    df = spark.createDataFrame([("é 日 😀 \\ \" \n",)], "t string").select(F.to_json(F.struct("t")).alias("value"))
    export.write_jsonl(df, str(tmp_path / "o"), files=1)
    line = "".join(p.read_text("ascii") for p in (tmp_path / "o").glob("part-*"))
    assert line == json.dumps({"t": "é 日 😀 \\ \" \n"}, separators=(",", ":")) + "\n"
    export.write_json({"a": ["é"]}, str(tmp_path / "d" / "r.json"))
    assert json.loads((tmp_path / "d" / "r.json").read_text()) == {"a": ["é"]}


def packed_by_hand(text, most, overlap):
    """Chunks found by trying, for each, how far it goes; sizes are added up anew every time."""
    text = text.strip()
    if len(text) <= most:
        return [text] if text else []
    paras = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    out, kept, rest = [], [], paras
    while rest:
        n = 1
        while n < len(rest) and sum(map(len, kept)) + sum(len(p) + 2 for p in rest[: n + 1]) <= most:
            n += 1
        whole = kept + rest[:n]
        out.append("\n\n".join(whole))
        rest = rest[n:]
        kept = next(whole[k:] for k in range(len(whole) + 1) if sum(map(len, whole[k:])) <= overlap)
    final = []
    for piece in out:
        if len(piece) <= most:
            final.append(piece)
            continue
        sentences, first = re.split(r"(?<=[.!?])\s+", piece), True
        while sentences:
            n = 1
            while n < len(sentences) and len(" ".join(sentences[: n + 1])) - (0 if first else 1) <= most:
                n += 1
            final.append(" ".join(sentences[:n]))
            sentences, first = sentences[n:], False
    return [p for p in final if p.strip()]


def test_chunks_against_packing_by_hand():
    import random

    rng = random.Random(4)
    for _ in range(300):
        paras = ["".join(rng.choice(["word ", "end. ", "why? ", "x"]) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        text = "\n \n".join(paras)
        most, overlap = rng.randint(20, 200), rng.randint(0, 120)
        assert chunks_of(text, most, overlap) == packed_by_hand(text, most, overlap)
    ten = "\n\n".join("p" * 120 for _ in range(10))
    assert len(chunks_of(ten, 300, 0)) > 1 and all(len(c) <= 400 for c in chunks_of(ten, 300, 0)) and chunks_of(None, 10, 0) == []


def test_query_chunks_equal_packing_by_hand(spark):
    from curlew.queries.core import QUERIES

    sf = "/root/testdata/sf0.001"
    want = [(r.doc_id, k, len(c)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for k, c in enumerate(packed_by_hand(r.text or "", 3000, 200))]
    assert sorted((r.doc_id, r.chunk_index, r.n_chars) for r in QUERIES["T2_chunks"](spark, sf).collect()) == sorted(want)


def test_pages_equal_a_parse_by_patterns(spark):
    """T1 and N11 on all pages of the smallest tables: what stands between tags, outside of dropped elements."""
    import html

    from curlew.queries.core import QUERIES

    sf = "/root/testdata/sf0.001"
    got, chunks = {r.page_id: r for r in QUERIES["T1_page_text"](spark, sf).collect()}, {}
    for r in QUERIES["N11_collected"](spark, sf).collect():
        chunks.setdefault(r.source_uri, []).append(r.n_chars)
    import hashlib

    pages, seen = spark.read.parquet(f"{sf}/pages.parquet").collect(), 0
    for p in pages:
        body = re.sub(r"(?is)<!--.*?-->", "", p.html)
        title = re.search(r"(?is)<title[^>]*>(.*?)</title>", body)
        body = re.sub(r"(?is)<title[^>]*>.*?</title>", "", body)
        if re.search(r"(?i)<(nav|footer|header|aside)\b", body) and len(re.findall(r"(?i)<(nav|footer|header|aside|script|style)\b", body)) != len(re.findall(r"(?i)</(nav|footer|header|aside|script|style)\s*>", body)):
            continue  # unclosed elements: the patterns can't follow
        body = re.sub(r"(?is)<(script|style|nav|footer|header|aside)\b.*?</\1\s*>", "\0", body)
        text = "\n".join(t for t in (html.unescape(x).strip() for x in re.split(r"(?s)<[^>]*>|\0", body)) if t)
        seen += 1
        assert got[p.page_id].title == (html.unescape(title[1]).strip() if title else "" or p.url) and got[p.page_id].h == hashlib.md5(text.encode()).hexdigest(), p.page_id
        assert sorted(chunks.get(p.url, []))[-1:] == sorted(map(len, packed_by_hand(text, 3000, 200)))[-1:]
    assert seen >= len(pages) // 2


def test_page_without_title():
    assert read_page("<p>one</p><script>no</script><p> two</p>", "u") == ("u", "one\ntwo")
    assert read_page(None, None) == ("", "")


def test_shapes():
    assert json_shape("42") == json_shape("true") == json_shape('"x"') == json_shape("{broken") == ("plain_text", "plain_text")
    assert json_shape(" \n") == json_shape(None) == ("empty", "empty")
    assert json_shape(' {"b": [1, true, null], "a": {"x": "s"}}') == ("{a:{x:string},b:[bool,null,number]}", "object(a,b)")
    assert json_shape("[]") == ("[]", "array") and json_shape("[2, 1.5]")[0] == json_shape("[7]")[0]
