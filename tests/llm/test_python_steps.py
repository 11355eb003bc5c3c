"""No task of the pipeline computes in two Python workers at once."""

from __future__ import annotations

import re
import sys

import pytest

from tidegauge.operators import scratch

pytest.importorskip("xxhash")
import corpus_pipeline  # noqa: E402


def most_in_a_task(plan: str) -> int:
    """The most Python steps on a way down the plan between two exchanges."""
    most, above = 0, []
    for line in plan.split("\n"):
        found = re.match(r"^([ :+\-|*()0-9]*)([A-Z]\w+)", line)
        if not found:
            continue
        depth, name = len(found[1]), found[2]
        while above and above[-1][0] >= depth:
            above.pop()
        n = above[-1][1] if above and "Exchange" not in name else 0
        n += bool(re.match("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", name))
        most = max(most, n)
        above.append((depth, n))
    return most


def test_one_python_step_a_task(spark, monkeypatch):
    real, met = scratch.materialize, {}

    def seen(df, name):
        met[name] = max(met.get(name, 0), most_in_a_task(df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    for module in list(sys.modules.values()):
        if getattr(module, "materialize", None) is real and module is not scratch:
            monkeypatch.setattr(module, "materialize", seen)
    corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"exact-differing", "exact_dedup", "sets", "pieces"} <= set(met)
    assert met["exact-differing"] == 1
    assert {k: n for k, n in met.items() if n > 1} == {}
