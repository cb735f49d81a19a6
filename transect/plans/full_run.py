"""All sets one after the other, each file of a set in parallel; a summary and a table that follow the run."""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from transect.config import ExportConfig, safe_stem
from transect.functions.scalars import utilisation
from transect.plans.export import export_set
from transect.plans.files import write_text
from transect.sources.survey import discover_sets


@dataclass
class SetRun:
    """What became of one set: files by state, seconds on the clock, CPU seconds of the kernels in the workers."""

    set_id: str
    files: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("ok", "partial", "failed"), 0))
    wall_s: float = 0.0
    cpu_s: float = 0.0
    previews: int = 0
    outputs: dict | None = None
    problem: str | None = None

    @property
    def state(self) -> str:
        return "failed" if self.problem else "ok" if sum(self.files.values()) == self.files["ok"] else "partial"


def table_of(runs: list[SetRun], slots: int) -> str:
    """One line for each set and one of totals: files by state, seconds, files a second, and the share of the slots that the kernels kept busy."""
    head = ["set", "state", "ok", "partial", "failed", "wall s", "CPU s", "files/s", "busy"]
    total = SetRun("all", {k: sum(r.files[k] for r in runs) for k in ("ok", "partial", "failed")}, sum(r.wall_s for r in runs), sum(r.cpu_s for r in runs))
    lines = [head]
    for r in [*runs, total]:
        state = r.state if r is not total else f"{sum(x.state == 'ok' for x in runs)} of {len(runs)} ok"
        wall = max(r.wall_s, 1e-9)
        lines.append([r.set_id, state, *(str(n) for n in r.files.values()), f"{r.wall_s:.1f}", f"{r.cpu_s:.1f}", f"{sum(r.files.values()) / wall:.2f}", f"{utilisation(r.cpu_s, wall, slots)['efficiency_percent']:.0f} %"])
    widths = [max(len(x[k]) for x in lines) for k in range(len(head))]
    return "".join("  ".join(x[k].ljust(widths[k]) if k < 2 else x[k].rjust(widths[k]) for k in range(len(head))).rstrip() + "\n" for x in lines)


def full_run(spark: SparkSession, data_root: str, out_dir: str, config: ExportConfig, sets: list[str] | None = None) -> dict:
    """Export every set; full_run_summary.json and full_run_report.txt are written again after each. A set's failure is told in its entry."""
    root, out = data_root.rstrip("/"), out_dir.rstrip("/")
    labels, slots = discover_sets(spark, root, sets), spark.sparkContext.defaultParallelism
    began, runs = datetime.now(UTC), []

    def told() -> dict:
        done = len(runs) == len(labels)
        use = utilisation(sum(r.cpu_s for r in runs), max(sum(r.wall_s for r in runs), 1e-9), slots)
        run = {"data": root, "out": out, "slots": slots, "began": began.isoformat(timespec="seconds"), "ended": datetime.now(UTC).isoformat(timespec="seconds") if done else None}
        run |= {"sets": len(labels), "complete": done and all(r.state == "ok" for r in runs), "speedup": use["speedup"], "busy_percent": use["efficiency_percent"]}
        return {"schema_version": 2, "run": run, "sets": [asdict(r) | {"state": r.state} for r in runs]}

    for label in labels:
        at, cpu, name = time.time(), spark.sparkContext.accumulator(0.0), f"set_{safe_stem(label)}"
        entry = SetRun(label)
        here = replace(config, set_dir=f"{root}/{label}", out_dir=f"{out}/{name}", index_json=f"{out}/.indexes/{name}_3dc_index.json", checkpoint_dir=f"{out}/.checkpoints", output_name=f"{name}_rut_results")
        try:
            done = export_set(spark, here, cpu)
            entry.files = {k: done[f"files_{k}"] for k in entry.files}
            entry.outputs, entry.previews = done["outputs"], len(done["previews"])
        except Exception as e:  # noqa: BLE001  one set's failure is an entry of the summary
            entry.problem = f"{type(e).__name__}: {e}"
        entry.wall_s, entry.cpu_s = time.time() - at, cpu.value
        runs.append(entry)
        write_text(f"{out}/full_run_summary.json", json.dumps(told(), indent=2, allow_nan=False))
        write_text(f"{out}/full_run_report.txt", table_of(runs, slots))
    return told()
