import os
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
#: Columns that operators make themselves.
CLASHES = ("n_words", "base_failed", "rejected_host", "matches", "body", "kept", "mark_id", "mark_hit", "maybe_gone", "w", "size", "score")


def prose(rng, n):
    return " ".join(f"w{k}" for k in rng.integers(0, 400, n))


def odd_rows():
    rng = np.random.default_rng(5)
    base, near, shared = prose(rng, 120), None, "a passage that many documents share among them and that is long "
    near = base.split()
    near[60] = "zz"
    return [
        (1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, base, "a"), (5, base, "a"), (6, " ".join(near), "b"), (7, prose(rng, 9000), "hot"),
        (8, "x", "hot"), (9, "two words", None), (10, "TWO Words", None), (11, shared + prose(rng, 40), "hot"), (12, prose(rng, 30) + " " + shared, "hot"),
        (13, "ünïcödé “quotes” 日本語 text " * 8, "b"), (14, "same same " * 50, "c"), (15, "line\nline\n\nline\n" * 10, "c"), (16, "a" * 60, "c"), (17, "b" + "a" * 60, "c"),
        (18, "’" * 40, "d"), (19, "’" * 41, "d"), (20, "\x00 it's <|endoftext|>  2024\r\n\tÄrger 12345", "d"), (4, base, "a"),
    ]


def write(folder, rows, benchmark=((1, "a passage that many documents share"), (2, None), (3, "x")), labels=(), extra=True):
    folder.mkdir(parents=True, exist_ok=True)
    d = pd.DataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], columns=SCHEMA.names)
    t = pa.Table.from_pandas(d, SCHEMA, preserve_index=False)
    for c in CLASHES if extra else ():
        t = t.append_column(c, pa.array(["mine"] * len(rows), pa.string()))
    pq.write_table(t, folder / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([b[0] for b in benchmark], pa.int64()), "text": pa.array([b[1] for b in benchmark], pa.string())}), folder / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([1] * len(labels), pa.int64()), "toxic": pa.array([x[1] for x in labels], pa.int64())}), folder / "labels.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    return write(tmp_path_factory.mktemp("odd") / "t", odd_rows())


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty") / "t", [], ())


@pytest.fixture(scope="session")
def nulls(tmp_path_factory):
    """Rows without a doc_id among others."""
    return write(tmp_path_factory.mktemp("nulls") / "t", [(None, "a b c d e f g h " * 9, None), (None, None, "a"), *odd_rows()[:8]], ((None, "a b c"), (1, None)))
