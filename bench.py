"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; the best time counts).
"""

from __future__ import annotations

import json
import os
import time

from docquarry.checks.fixtures import mixed_documents, order_documents, table
from docquarry.checks.queries import registered
from docquarry.operators import Manifest, discover_paths, flatten, keyset_page, page, path_coverage, where
from docquarry.plans import ExportSpec, run_export
from docquarry.session import local_session, scratch_path


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _lines(spark, sf):
    return table(spark, sf, "lineitem")


def _export(format, source, json_mode="canonical", compression="none"):
    """A whole strict export: write, digest, publish."""

    def run(spark, sf):
        df = source(spark, sf)
        spec = ExportSpec(
            output=scratch_path(spark, "bench"),
            format=format,
            manifest=Manifest.of(df.columns) if format in ("csv", "parquet") else None,
            json_mode=json_mode,
            compression=compression,
            create_dirs=True,
        )
        run_export(df, spec)

    return run


HEADLINE = {
    "scan_filter_count": lambda spark, sf: where(
        _lines(spark, sf), {"l_quantity": {"$gte": 25}, "l_returnflag": "R"}
    ).count(),
    "flatten_lineitem": lambda spark, sf: _noop(flatten(_lines(spark, sf), _lines(spark, sf).columns)),
    "export_csv": _export("csv", _lines),
    "export_csv_gzip": _export("csv", _lines, compression="gzip"),
    "export_parquet": _export("parquet", _lines),
    "export_jsonl_canonical": _export("jsonl", _lines),
    "export_jsonl_plain": _export("jsonl", _lines, "plain"),
    "export_json_array": _export("json", _lines, "plain"),
    "export_bson": _export("bson", _lines),
    "export_nested_canonical": _export("jsonl", order_documents),
    "discover_paths_typed": lambda spark, sf: discover_paths(_lines(spark, sf)).collect(),
    "discover_paths_variant": lambda spark, sf: discover_paths(mixed_documents(spark, sf), "doc").collect(),
    "path_coverage_variant": lambda spark, sf: path_coverage(mixed_documents(spark, sf), "doc").collect(),
    "ordered_page": lambda spark, sf: _noop(page(_lines(spark, sf), "l_extendedprice:-1,l_orderkey:1", 1000, 1000)),
    "large_slice": lambda spark, sf: _noop(page(_lines(spark, sf), "l_extendedprice:-1,l_orderkey:1", skip=200_000)),
    "keyset_page": lambda spark, sf: _noop(
        keyset_page(table(spark, sf, "orders"), 50_000, limit=10_000, key="o_orderkey")
    ),
}

# Registered queries timed as they are.
REGISTERED = (
    "filter_regex",
    "flatten_csv",
    "flatten_parquet",
    "flatten_typed",
    "render_array",
    "render_double",
    "json_canonical",
    "json_canonical_mixed",
    "infer_manifest",
    "classify_error",
    "error_stats",
    "run_report",
    "stream_resume",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    jobs = dict(HEADLINE)
    for name in REGISTERED:
        jobs[name] = lambda spark, sf, run=registered()[name]: _noop(run(spark, sf))
    seconds = {}
    for name, job in jobs.items():
        best = None
        for _ in range(repeat):
            start = time.perf_counter()
            job(spark, sf)
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
