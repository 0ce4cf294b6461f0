"""Keyed stream processors over more rows of a key than are in pandas at a time."""

import itertools
from types import SimpleNamespace

import pandas as pd
import pytest

from test_controlled_stream import made_runs, plain_runs
from wharfline.streaming import stateful as st
from wharfline.streaming.controlled import ControlledRunner


class State:
    def __init__(self):
        self.value = None

    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def put(self, value):
        self.value = value

    update = put

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, State())

    getListState = getValueState
    listTimers = lambda self: iter(self.timers)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


def begun(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def test_triggers_are_decided_some_at_a_time(monkeypatch):
    """Rows of one key came out as one frame, so a micro-batch was held whole in pandas, and more than once."""
    rows = pd.DataFrame({
        "partition": 0, "offset": range(60), "run_id": [f"r{k // 4}" for k in range(60)], "mode": ["manual" if k % 5 == 0 else "x" for k in range(60)],
        "start_us": [k * 10 for k in range(60)], "duration_us": [25 if k % 3 else 0 for k in range(60)],
    })
    mixed = rows.sample(frac=1, random_state=1)

    def decided(size):
        monkeypatch.setattr(st, "SLICE", size)
        runner = st.TriggerRunner()
        handle = begun(runner)
        out = list(runner.handleInputRows(("p", "s"), iter([mixed[:25], mixed[25:]]), None))
        return out, handle.states["runner"].value

    whole, last = decided(1000)
    cut, cut_last = decided(7)
    assert max(map(len, cut)) == 7 and last == cut_last
    pd.testing.assert_frame_equal(pd.concat(whole, ignore_index=True), pd.concat(cut, ignore_index=True))


@pytest.mark.parametrize("remember", [True, False])
@pytest.mark.parametrize("cut", [1, 3])
def test_runs_are_settled_some_at_a_time(monkeypatch, remember, cut):
    """All triggers and results of a key were merged at once; results of runs that never were stayed in the state for ever."""
    triggers, results = made_runs()
    triggers = [t for t in triggers if t[4] is not None]
    monkeypatch.setattr(st, "SLICE", 7)
    us = lambda at: int(at.timestamp() * 1e6)
    got, biggest = [], 0
    for product in ("p0", "p1", "p2"):
        runner = ControlledRunner(900 * 10**6, remember)
        handle = begun(runner)
        asked = [dict(kind="trigger", partition=t[2], offset=t[3], run_id=t[4], mode="manual" if (t[5] or "").strip() == "MANUAL" else "automatic", at_us=us(t[6])) for t in triggers if t[0] == product]
        ended = [dict(kind="result", partition=r[2], offset=r[3], run_status=r[4], run_error=r[5], duration_us=r[6], at_us=us(r[7])) for r in results if r[0] == product]
        rows = pd.DataFrame(asked + ended).sample(frac=1, random_state=3).assign(product=product, stage="s")
        if cut > 1:
            rows = rows.sort_values("offset", kind="stable")
        for frame in (rows[k : k + -(-len(rows) // cut)] for k in range(0, len(rows), -(-len(rows) // cut))):
            out = list(runner.handleInputRows((product, "s"), iter([frame[:5], frame[5:]]), None))
            biggest = max([biggest, *map(len, out)])
            got += out
        if cut == 1 and remember:  # of results whose trigger came, none waits for one
            came = {(t["partition"], t["offset"]) for t in asked}
            assert not [r for r in handle.states["early"].value or [] if (r[0], r[1]) in came]
        for _ in itertools.count():
            if not handle.timers:
                break
            clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**13)
            got += list(runner.handleExpiredTimer((product, "s"), clock, None))
    told = pd.concat(got)
    told = told[told["kind"] == "status"].astype(object)
    seen = sorted(map(str, told.where(told.notna(), None)[["product", "stage", "partition", "offset", "run_id", "decision", "status", "error", "duration_ms"]].itertuples(index=False, name=None)))
    assert seen == sorted(map(str, plain_runs(triggers, results, remember, 900).elements()))
    assert biggest <= 7


@pytest.mark.parametrize("kind", ["trigger", "result"])
def test_one_side_alone(kind):
    row = dict(kind=kind, partition=0, offset=1, run_id="r", mode="automatic", run_status="completed", run_error=None, duration_us=5, at_us=7)
    runner = ControlledRunner(900 * 10**6, True)
    handle = begun(runner)
    out = list(runner.handleInputRows(("p", "s"), iter([pd.DataFrame([row])]), None))
    assert [len(handle.states[n].value or []) for n in ("open", "early")] == ([1, 0] if kind == "trigger" else [0, 1])
    assert sum(map(len, out)) == (kind == "trigger")
