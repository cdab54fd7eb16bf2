"""Run independent stages of one application concurrently.

Spark schedules jobs submitted from several driver threads side by side, so
stages that do not depend on each other (e.g. the SILVER models of different
entities) overlap instead of leaving executors idle between small jobs.
The reference runs its models with 4 to 8 threads and its load task groups in
parallel; this is the same idea with plain threads and a dependency map.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait


def run_stages(tasks: dict[str, Callable[[], object]], deps: dict[str, set[str]] | None = None,
               threads: int = 4) -> dict[str, object]:
    """Run `tasks` respecting `deps` (name -> names it waits for); returns results.

    The first failure is raised after running tasks finish; tasks that depend
    on a failed one are not started.
    """
    deps = {k: set((deps or {}).get(k, ())) for k in tasks}
    unknown = {d for ds in deps.values() for d in ds} - set(tasks)
    if unknown:
        raise ValueError(f"unknown dependencies: {sorted(unknown)}")
    results: dict[str, object] = {}
    pending = dict(tasks)
    running = {}
    error: BaseException | None = None
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        while pending or running:
            if error is None:
                for name in [n for n in pending if deps[n] <= results.keys()]:
                    running[pool.submit(pending.pop(name))] = name
            if not running:
                if pending and error is None:
                    raise ValueError(f"dependency cycle among {sorted(pending)}")
                break
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for f in done:
                name = running.pop(f)
                try:
                    results[name] = f.result()
                except BaseException as e:  # noqa: BLE001 - re-raised below
                    error = error or e
            if error is not None:
                pending.clear()
    if error is not None:
        raise error
    return results
