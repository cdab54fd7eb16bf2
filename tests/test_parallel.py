import threading
import time

import pytest

from tidemark.plans.parallel import run_stages


def test_dependencies_are_respected_and_independent_tasks_overlap():
    log, lock = [], threading.Lock()

    def task(name, pause=0.05):
        def run():
            with lock:
                log.append(("start", name))
            time.sleep(pause)
            with lock:
                log.append(("end", name))
            return name
        return run
    out = run_stages({"a": task("a"), "b": task("b"), "c": task("c")}, {"c": {"a"}}, threads=3)
    assert out == {"a": "a", "b": "b", "c": "c"}
    assert log.index(("end", "a")) < log.index(("start", "c"))
    assert log.index(("start", "b")) < log.index(("end", "a"))  # a and b ran side by side


def test_failure_stops_dependants():
    ran = []

    def boom():
        raise RuntimeError("x")
    with pytest.raises(RuntimeError):
        run_stages({"a": boom, "b": lambda: ran.append("b")}, {"b": {"a"}}, threads=2)
    assert ran == []


def test_unknown_dependency():
    with pytest.raises(ValueError):
        run_stages({"a": lambda: 1}, {"a": {"zzz"}})
