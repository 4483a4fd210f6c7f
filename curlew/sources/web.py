"""Web sources and collection (S10 to S12, N11, N12, T1, T2). Backends are pluggable; none is called in tests."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from html.parser import HTMLParser
from urllib.parse import parse_qs, urlencode, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curlew.functions.text import chunk, extract_page
from curlew.operators.normalize import content_id
from curlew.sources.files import decode, walk

FETCHED = "url string, html string, status int, error string"


def fetch_one(url: str, timeout: float = 15.0) -> tuple[str, str | None, int | None, str | None]:
    """(url, html, status, error); failures are rows, not exceptions."""
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"User-Agent": "curlew"}), timeout=timeout) as r:
            return url, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), r.status, None
    except Exception as e:  # every failure becomes the row's error
        return url, None, None, f"{type(e).__name__}: {e}"


def fetch(urls: DataFrame, fetcher: Callable = fetch_one, delay: float = 1.0) -> DataFrame:
    """Pages of a DataFrame of urls; each task keeps its own pace of one request every `delay` seconds."""

    def run(batches):
        import time

        for pdf in batches:
            rows = []
            for k, u in enumerate(pdf["url"]):
                if k and delay:
                    time.sleep(delay)
                rows.append(fetcher(u))
            yield pd.DataFrame(rows, columns=["url", "html", "status", "error"]).astype({"status": "Int32"})

    return urls.select("url").mapInPandas(run, FETCHED)


def search(query: str, backends: Iterable[Callable[[str, int], list[dict]]], limit: int = 10) -> list[dict]:
    """The first backend that finds anything; one that fails counts as finding nothing."""
    for backend in backends:
        try:
            found = backend(query, limit)
        except Exception:
            found = []
        if found:
            return found[:limit]
    return []


#: Where each JSON search service keeps its results, and their title and address (fixed values of the services' answers).
ANSWERS = {"serpapi": (("organic_results",), "title", "link"), "bing": (("webPages", "value"), "name", "url"), "google_cse": (("items",), "title", "link")}


class _Results(HTMLParser):
    """Titles, addresses and snippets of a results page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.part, self.depth = None, 0

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        kinds = (given.get("class") or "").split()
        if self.part:
            self.depth += 1
        if "result__title" in kinds:
            self.part, self.depth = "title", 0
            self.found.append({"title": "", "url": "", "snippet": ""})
        elif "result__snippet" in kinds and self.found:
            self.part, self.depth = "snippet", 0
        if self.part == "title" and tag == "a" and not self.found[-1]["url"]:
            self.found[-1]["url"] = self.target(given.get("href") or "")

    def handle_endtag(self, tag):
        if self.part:
            self.depth -= 1
            if self.depth < 0:
                self.part = None

    def handle_data(self, data):
        if self.part:
            self.found[-1][self.part] += data

    @staticmethod
    def target(href: str) -> str:
        """The address that a redirecting link leads to."""
        return parse_qs(urlsplit(href).query).get("uddg", [href])[0]


def parse_results(service: str, answer: str, limit: int = 10) -> list[dict]:
    """Title, url and snippet of a search service's answer; one that can't be read has no results."""
    if service == "duckduckgo_html":
        page = _Results()
        page.feed(answer)
        page.close()
        return [{k: v.strip() for k, v in r.items()} for r in page.found if r["url"]][:limit]
    path, title, url = ANSWERS[service]
    try:
        at = json.loads(answer)
        for key in path:
            at = at.get(key, {})
        return [{"title": r.get(title, ""), "url": r.get(url, ""), "snippet": r.get("snippet", "")} for r in list(at)[:limit]]
    except (ValueError, AttributeError):
        return []


def backend(service: str, fetcher: Callable, address: Callable[[str, int], str]) -> Callable[[str, int], list[dict]]:
    """A search backend: `address` gives the request's url, with its key, `fetcher` is like fetch_one."""

    def run(query: str, limit: int) -> list[dict]:
        answer = fetcher(address(query, limit))[1]
        return parse_results(service, answer, limit) if answer else []

    return run


def html_search(fetcher: Callable = fetch_one) -> Callable[[str, int], list[dict]]:
    """The backend that needs no key."""
    return backend("duckduckgo_html", fetcher, lambda query, limit: "https://html.duckduckgo.com/html/?" + urlencode({"q": query, "kl": "us-en"}))


def chunk_ids(instruction: Column, uri: Column, index: Column) -> Column:
    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([content_id({"instruction": x, "source_uri": y, "chunk_index": int(z)}) for x, y, z in zip(a, b, c, strict=True)])

    return run(instruction, uri, index)


def chunk_records(pages: DataFrame, query: str | None = None, max_chars: int = 3000, overlap: int = 200, task_type: str = "sft", source_type: str = "url_reference") -> DataFrame:
    """(source_uri, title, text) → collected records, one a chunk."""
    cut = pages.select("source_uri", "title", F.posexplode(chunk(F.col("text"), max_chars, overlap)).alias("chunk_index", "chunk"))
    about = F.concat(F.lit("Using the source, answer: "), F.lit(query)) if query else F.concat(F.lit("Summarise the key points of: "), F.col("title"))
    out = cut.withColumn("instruction", about)
    none = F.lit(None).cast("string")
    meta = F.to_json(F.struct(F.lit("unspecified").alias("difficulty"), F.lit("general").alias("persona"), F.lit(source_type).alias("source_type"), F.lit("real_world").alias("source_origin"), F.col("source_uri").alias("source_path"), "chunk_index"))
    response = F.struct(F.lit("single").alias("format"), F.col("chunk").alias("text"), none.alias("chosen"), none.alias("rejected"))
    ids = chunk_ids(F.col("instruction"), F.col("source_uri"), F.col("chunk_index"))
    return out.select(ids.alias("id"), F.lit(task_type).alias("task_type"), "instruction", F.col("title").alias("context"), response.alias("response"), meta.alias("metadata"), F.lit("pending").alias("pipeline_status"), F.lit("collected").alias("status"), F.lit(source_type).alias("source_type"), "source_uri", "chunk_index")


def collect_pages(pages: DataFrame, **options) -> DataFrame:
    """Records from (url, html) pages; where fetching failed and a snippet is given, from the snippet."""
    page = extract_page(F.col("html"), F.col("url")).alias("p")
    columns = [page, F.col("url").alias("source_uri"), (F.col("snippet") if "snippet" in pages.columns else F.lit(None).cast("string")).alias("snippet")]
    read = pages.select(*columns).select("source_uri", "p.title", F.coalesce(F.nullif(F.col("p.text"), F.lit("")), "snippet").alias("text"))
    return chunk_records(read, **options)


def collect_files(spark: SparkSession, root: str, max_files: int | None = 200, **options) -> DataFrame:
    files = walk(spark, root, max_files=max_files)
    name = F.element_at(F.split("path", "/"), -1)
    return chunk_records(files.select(F.col("path").alias("source_uri"), name.alias("title"), decode(F.col("content")).alias("text")), source_type="raw_dataset", **options)


def merge_collected(*parts: DataFrame) -> DataFrame:
    """Records of all modes, the first of equal ids in the order of modes, sources and chunks."""
    marked = [p.withColumn("_mode", F.lit(k)) for k, p in enumerate(parts)]
    every = marked[0]
    for p in marked[1:]:
        every = every.unionByName(p)
    columns = [c for c in every.columns if c not in ("id", "_mode")]
    first = F.min_by(F.struct(*columns), F.struct("_mode", "source_uri", "chunk_index")).alias("r")
    return every.groupBy("id").agg(first).select("id", "r.*")
