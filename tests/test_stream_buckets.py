"""Custom stream state by bucket: one call handles all aircraft of a bucket."""

import pandas as pd
import pytest

from flight_engine.streaming import stateful as st


class State:
    """A GroupState over calls."""

    def __init__(self):
        self.get, self.hasTimedOut, self.watermark, self.due = None, False, 0, None

    @property
    def exists(self):
        return self.get is not None

    def update(self, value):
        self.get = value

    def remove(self):
        self.get = None

    def getCurrentWatermarkMs(self):  # noqa: N802 - GroupState API
        return self.watermark

    def setTimeoutTimestamp(self, at):  # noqa: N802
        assert at > self.watermark
        self.due = at


def call(fn, state, rows, watermark=0):
    state.watermark, state.hasTimedOut = watermark * 1000, rows is None
    pdfs = [] if rows is None else [pd.DataFrame(rows[i::2], columns=["icao24", "timestamp", "time_position", "longitude", "latitude", "vertical_rate"])
                                    for i in range(2) if rows[i::2]]
    return [r for out in fn((0,), iter(pdfs), state) for r in out.to_dict("records")]


def fixes(aircraft, at, rate=-20.0):
    return [(aircraft, t, t, 1.0, 2.0, rate) for t in at]


def test_descents_of_many_aircraft_in_one_call():
    fn, state = st._descent_fn(-15.0, 3), State()
    rows = [*fixes("a", [30, 10]), *fixes("b", [20, 40, 10]), *fixes("c", [10, 20], 0.0), *fixes("c", [30, 40])]
    assert [(r["icao24"], r["start_timestamp"], r["timestamp"]) for r in call(fn, state, rows)] == [("b", 10, 40)]
    # a's run goes on from the state, c's third falling fix comes now, b's run is not reported again; late and replayed rows count for nothing
    found = call(fn, state, [*fixes("a", [30, 20, 50]), *fixes("b", [50]), *fixes("c", [40, 60])])
    assert sorted((r["icao24"], r["start_timestamp"], r["timestamp"]) for r in found) == [("a", 10, 50), ("c", 30, 60)]


def test_silent_aircraft_are_forgotten_beside_others():
    fn, state = st._descent_fn(-15.0, 3), State()
    late = 100 + st.IDLE_TIMEOUT_MS // 1000
    call(fn, state, [*fixes("a", [90, 100]), *fixes("b", [100])])
    call(fn, state, fixes("b", [late]), late + 1)
    assert state.get[0] == ["b"]
    assert call(fn, state, fixes("a", [late + 5]), late + 1) == []
    call(fn, state, None, 2 * late + 10)
    assert not state.exists


@pytest.mark.parametrize("together", [True, False])
def test_latest_rows_and_tombstones(together):
    fn, state = st._latest_ttl_fn(["icao24", "timestamp", "time_position", "vertical_rate"], 60), State()
    seen = call(fn, state, [*fixes("a", [10, 30, 20]), *fixes("b", [5]), *fixes("c", [40])])
    assert sorted((r["icao24"], r["timestamp"], r["evicted"]) for r in seen) == [("a", 30, False), ("b", 5, False), ("c", 40, False)]
    assert state.due == 65_000
    # a is behind the watermark by more than its TTL, b is heard of (an old row), c has a newer row
    rows = [*fixes("b", [4]), *fixes("c", [95])]
    out = call(fn, state, rows if together else None, 91)
    want = [("a", 30, True), ("c", 95, False)] if together else [("a", 30, True), ("b", 5, True)]
    assert sorted((r["icao24"], r["timestamp"], r["evicted"]) for r in out) == want
    assert sorted(state.get[0]) == (["b", "c"] if together else ["c"])
