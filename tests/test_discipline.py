"""The library core stays on the executors: no row collection to the driver,
no pandas conversion, no Python UDFs, no RDD code, no local checkpoints."""

import pathlib
import re

CORE = pathlib.Path(__file__).resolve().parents[1] / "valora"
FORBIDDEN = [r"\.toPandas\(", r"\budf\(", r"pandas_udf", r"\.rdd\b", r"localCheckpoint", r"\.collect\(\)",
             r"crossJoin"]
# file listing is metadata (paths), not rows
ALLOWED = {("sources/delimited.py", r"\.collect\(\)")}


def test_core_has_no_driver_side_row_work():
    bad = []
    for path in CORE.rglob("*.py"):
        rel = str(path.relative_to(CORE))
        if rel.startswith("llm"):
            continue
        text = path.read_text()
        for pat in FORBIDDEN:
            if (rel, pat) in ALLOWED:
                continue
            for m in re.finditer(pat, text):
                line = text[: m.start()].count("\n") + 1
                bad.append(f"{rel}:{line} {pat}")
    assert not bad, bad
