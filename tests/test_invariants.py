"""Source-level invariants of the library (not the tests or tools)."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "stockledger"
# the optional training-data operators choose their style operator by operator; their tests say which
SOURCES = {p: p.read_text() for p in PKG.rglob("*.py") if "llm" not in p.relative_to(PKG).parts}

FORBIDDEN = {
    r"\.collect\(": "rows pulled to the driver",
    r"\.toPandas\(": "rows pulled to the driver",
    r"localCheckpoint": "lineage cut on executor-local storage",
    r"crossJoin": "cartesian product",
    r"\.rdd\b": "RDD code outside Catalyst",
    r"\budf\(|pandas_udf|applyInPandas|mapInPandas": "Python in the row path",
    r"\.cache\(\)|\.persist\(": "memory caching instead of a written table",
}


def test_no_forbidden_calls():
    hits = [
        f"{p.relative_to(PKG)}: {why} ({pat})"
        for p, src in SOURCES.items()
        for pat, why in FORBIDDEN.items()
        if re.search(pat, src)
    ]
    assert not hits, hits


def test_driver_actions_are_one_row_aggregates():
    """The only actions in the library read one aggregated row (sizes, counts)."""
    for p, src in SOURCES.items():
        for m in re.finditer(r"\.first\(\)", src):
            line = src[: m.start()].rsplit("\n", 1)[-1]
            assert "agg(" in line or "agg(" in src[max(0, m.start() - 400): m.start()], f"{p}: {line}"
