"""Summarize the physical plans of the headline queries: join strategies,
exchanges, scans with their pushed filters, codegen stages.

Usage: python tests/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ("sales_fact", "scd2_merge", "landing_incremental", "surrogate_key_initial",
            "sales_fact_incremental", "merge_upsert", "revenue_by_dimension")

OPERATORS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
             "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
             "BroadcastExchange", "Union", "Generate")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def summarize(text: str) -> dict:
    ops = Counter()
    for op in OPERATORS:
        ops[op] = len(re.findall(rf"\b{op}\b", text))
    exchanges = Counter(m.group(1) for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", text))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", text)
    codegen = len(re.findall(r"\*\(\d+\) ", text))
    return {"operators": {k: v for k, v in ops.items() if v}, "exchanges": dict(exchanges),
            "scans": len(scans), "scans_with_pushed_filters": sum(1 for _, f in scans if f.strip()),
            "codegen_operators": codegen}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(HEADLINE)
    from starloom.registry import QUERIES
    from starloom.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()   # executes this DataFrame, so explain() shows the final adaptive plan
        s = summarize(plan_text(df).split("== Initial Plan ==")[0])
        print(f"{name}: {s}")


if __name__ == "__main__":
    main()
