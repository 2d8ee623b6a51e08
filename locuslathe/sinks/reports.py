"""Short texts for people: comparison statistics, process manifest, validation report; the report as JSON."""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame

_SHOWN = 3


def shorten(values: list, most: int = _SHOWN) -> str:
    """Up to ``most`` values joined; of more, the first ``most - 1`` and how many are left."""
    texts = [str(v) for v in values]
    if len(texts) <= most:
        return ", ".join(texts)
    return f"{', '.join(texts[: most - 1])} (+{len(texts) - most + 1} more)"


def number(value, least: int = 1000) -> str:
    """Decimals with two digits, integers from ``least`` with separators."""
    if isinstance(value, float):
        return f"{value:.2f}"
    return f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) and abs(value) >= least else str(value)


def detail(value) -> str:
    """A value among the details of a check: short lists whole, long ones by their size, integers from 10,000 with separators."""
    if isinstance(value, list):
        if len(value) <= _SHOWN:
            return ", ".join(map(str, value)) or "(none)"
        return f"{len(value)} items ({', '.join(str(v) for v in value[:2])}, ...)"
    if isinstance(value, dict):
        return f"{len(value)} entries" if len(str(value)) > 80 else str(value)
    return number(value, 10_000) if not isinstance(value, float) else str(value)


def comparison_text(compared: DataFrame, ref: str, mod: str) -> str:
    """Four lines about the one row of ``compare_multisets``."""
    r = compared.head()
    lines = [f"unmapped reads: {ref} against {mod}", f"in both: {r['shared']}", f"only {ref}: {r['ref_only']}", f"only {mod}: {r['mod_only']}"]
    return "\n".join(lines) + "\n"


def manifest_text(summary: DataFrame, failed: DataFrame, header: dict[str, Any] | None = None, trace: DataFrame | None = None) -> str:
    """Header lines, the whole trace, task counts of the one row of ``trace_summary``, then all failed tasks by name.

    The text is made for a person who follows one run, so it passes through the driver, row by row.
    """
    r = summary.head().asDict()
    lines = [f"# {k}: {v}" for k, v in (header or {}).items()]
    if trace is not None:
        lines.append("\t".join(trace.columns))
        lines += ["\t".join("" if v is None else str(v) for v in row) for row in trace.toLocalIterator()]
    lines += [f"{k}: {r[k]}" for k in ("total", "completed", "cached", "failed", "aborted")]
    lines += [f"  {f['name']} (exit {f['exit']})" for f in failed.orderBy("name").toLocalIterator()]
    return "\n".join(lines) + "\n"


def _status(results: list[dict], checks: list[dict], fatal: list[str]) -> str:
    bad = fatal or any(r.get("fatal") for r in results) or any(not c.get("passed") for c in checks)
    return "FAILED" if bad else "PASSED"


def report_data(results: list[dict], checks: list[dict], fatal: list[str] = (), seconds: float = 0.0) -> dict[str, Any]:
    """The report as plain values: when it was made, the summary, every file and every check between files."""
    kinds = [("plasmid" if (r.get("settings") or {}).get("is_plasmid") else r["validator_type"]) for r in results]
    passed = sum(bool(c.get("passed")) for c in checks)
    return {
        "report_metadata": {"generated": datetime.now().isoformat(), "duration_seconds": seconds, "version": "1.0.0"},
        "summary": {
            "total_files": len(results),
            **{f"{k}_files": kinds.count(k) for k in ("genome", "plasmid", "read", "feature")},
            "interfile_validations": len(checks),
            "interfile_passed": passed,
            "interfile_failed": len(checks) - passed,
            "fatal_errors": list(fatal),
            "overall_status": _status(results, checks, list(fatal)),
        },
        "file_validations": [
            {"validator_type": r["validator_type"], "input_settings": r.get("settings"), "output_data": {"input_file": r["input_file"]} | r.get("metadata", {})}
            for r in results
        ],
        "inter_file_validations": [
            {
                "validation_type": c["name"], "status": "PASSED" if c.get("passed") else "FAILED", "passed": bool(c.get("passed")),
                "errors": c.get("errors", []), "warnings": c.get("warnings", []), "metadata": c.get("metadata", {}),
            }
            for c in checks
        ],
    }


def report_json(results: list[dict], checks: list[dict], fatal: list[str] = (), seconds: float = 0.0) -> str:
    return json.dumps(report_data(results, checks, fatal, seconds), indent=2, ensure_ascii=False, default=str)


def validation_report(results: list[dict], checks: list[dict], fatal: list[str] = ()) -> str:
    """Summary, files and inter-file checks. FAILED if a file has a fatal error or a check has failed."""
    out = [f"status: {_status(results, checks, list(fatal))}", f"files: {len(results)}", f"checks: {len(checks)}"]
    out += [f"fatal: {m}" for m in fatal]
    for r in results:
        kind = f"{r['validator_type']}, plasmid" if (r.get("settings") or {}).get("is_plasmid") else r["validator_type"]
        out.append(f"[{kind}] {r['input_file']}")
        out += [f"  {k}: {number(v) if not isinstance(v, list) else shorten(v)}" for k, v in sorted(r.get("metadata", {}).items()) if v is not None]
        out += [f"  {level}: {m}" for level, m in r.get("issues", [])]
    for c in checks:
        out.append(f"[{c['name']}] {'passed' if c.get('passed') else 'failed'}")
        out += [f"  error: {m}" for m in c.get("errors", [])] + [f"  warning: {m}" for m in c.get("warnings", [])]
        out += [f"  {k}: {detail(v)}" for k, v in sorted(c.get("metadata", {}).items()) if v is not None]
    return "\n".join(out) + "\n"
