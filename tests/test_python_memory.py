"""Chunks and pages of large batches leave little in a Python worker."""

import subprocess
import sys
from pathlib import Path

CODE = """
import resource, sys
import pyarrow as pa
from curlew.functions.memory import lean
from curlew.functions.text import chunks_of
cut = lean(lambda x: chunks_of(x, 3000, 200), pa.list_(pa.string()))
batch = pa.array([("mot é. " * 1500)] * 5000)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
out = next(cut(iter([batch])))
assert len(out) == 5000 and out[4999].as_py() == chunks_of("mot é. " * 1500, 3000, 200)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / batch.nbytes)
"""


def test_batch_is_never_whole_in_python():
    out = subprocess.run([sys.executable, "-c", CODE], cwd=Path(__file__).parent.parent, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 3  # results and their copy into one array; as Python strings it was more
