"""Print the SURVEY §2 operator coverage table (ID -> registered queries)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelens.plans.registry import load_all  # noqa: E402

# IDs exercised by tests rather than by a registered query (file or driver
# behaviour, no query of their own), with the test module covering them.
TEST_ONLY = {
    "S-5": "tests/test_sources_pipeline.py::test_csv_code_padding_and_resolve_source",
    "S-7": "tests/test_sources_pipeline.py::test_csv_code_padding_and_resolve_source",
    "S-8": "tests/test_sources_pipeline.py::test_competitor_panel_defaults",
    "S-11": "tests/test_sources_pipeline.py::test_write_clean_partitioned_with_csv_twin",
    "S-12": "tests/test_sources_pipeline.py::test_land_records_never_overwrites",
    "S-20": "tests/test_sources_pipeline.py::test_manifest_reports_missing_pairs",
}


def main() -> None:
    by_id: dict[str, list[tuple[str, bool]]] = {}
    for name, q in load_all().items():
        for i in q.ids:
            by_id.setdefault(i, []).append((name, q.sql is not None))
    for i in TEST_ONLY:
        by_id.setdefault(i, [])

    def key(i):
        m = re.match(r"([A-Z])-(\d+)", i)
        return (m.group(1), int(m.group(2)))

    print("| ID | registered queries (∎ = DuckDB twin, ◇ = invariants) | tests |")
    print("|---|---|---|")
    for i in sorted(by_id, key=key):
        qs = ", ".join(f"`{n}` {'∎' if sql else '◇'}" for n, sql in sorted(by_id[i]))
        print(f"| {i} | {qs or '—'} | {TEST_ONLY.get(i, '')} |")


if __name__ == "__main__":
    main()
