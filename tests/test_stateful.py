"""The keyed state of a station against a plain computation, and the stream against the batch."""

import random

import pandas as pd
import pytest

from helpers import rows
from plumelake.operators.features import features
from plumelake.sources import readers, schemas
from plumelake.streaming import stateful

DAY = 86400


class FakeHandle:
    """State and timers of one station, as the engine keeps them."""

    def __init__(self):
        self.kept, self.timers = [], []

    def getListState(self, name, schema):
        return self

    def get(self):
        return iter(self.kept)

    def put(self, rows):
        self.kept = list(rows)

    def registerTimer(self, at):
        self.timers.append(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def batch(*given):
    """(second, aqi, pm25) as the engine hands them over."""
    frame = pd.DataFrame([(int(s * 1_000_000), "S", 1.0, 2.0, a, "c", p, 2.0, 3.0, 4.0, 5.0,
                           None if p is None else round(p * 100)) for s, a, p in given],
                         columns=["micros", *stateful._STORED.names])
    return frame.assign(station_id="a")


def plain(known, at):
    """Features of one reading of all that are known."""
    def frame(width, col):
        return [r[col] for r in known if at[0] // 1 - width <= r[0] // 1 <= at[0] // 1 and r[col] is not None]
    before = [r for r in known if r[0] < at[0]]
    last = max(before)[1] if before else None
    mean = lambda v, by=1.0: sum(v) / (len(v) * by) if v else None     # noqa: E731
    units = lambda w: mean([round(p * 100) for p in frame(w, 2)], 100.0)     # noqa: E731
    return (units(DAY), units(DAY // 4), mean(frame(DAY, 1)), max(frame(DAY, 1), default=None), mean(frame(3600, 1)),
            at[1] - last if before and at[1] is not None and last is not None else None)


def run(processor, handle, given):
    out = pd.concat(processor.handleInputRows(("a",), iter([batch(*given)]), None))
    return {r[0] / 1e6: tuple(None if v is pd.NA or v != v else v for v in r[1:]) for r in out[
        ["micros", *[s.out for s in stateful.FEATURE_SPECS], stateful.TREND]].itertuples(index=False)}


@pytest.mark.parametrize("seed", range(5))
def test_state_equals_a_plain_computation(seed):
    """Batches with readings up to two days late and gaps: the rows that come out, on top
    of each other, are those of all readings."""
    draw = random.Random(seed)
    given = [(float(draw.randrange(12 * DAY)) + draw.choice([0, 0.5]), draw.choice([None, 1, 2, 3, 4, 5]),
              draw.randrange(9000) / 100) for _ in range(150)]
    given = sorted({r[0]: r for r in given if not 5 * DAY < r[0] < 7 * DAY}.values())
    given.sort(key=lambda r: r[0] + draw.choice([0, 0, DAY, 2 * DAY - 1]))
    processor, handle, table, known = stateful.StationHistory(2 * DAY, 2), FakeHandle(), {}, []
    processor.init(handle)
    for at in range(0, len(given), 12):
        part = given[at:at + 12]
        known += part
        table |= run(processor, handle, part)
        newest = max(r[0] for r in known)
        assert sum(r[0] / 1e6 < newest - 3 * DAY for r in handle.kept) <= 1
    assert table == {r[0]: plain(known, r) for r in known}


def test_repeats_and_silence():
    """A known reading comes out only if its values win; a timer leaves the last reading."""
    processor, handle = stateful.StationHistory(0, 2), FakeHandle()
    processor.init(handle)
    run(processor, handle, [(0.0, 3, 5.0), (60.0, 2, 5.0)])
    assert list(processor.handleInputRows(("a",), iter([batch((60.0, 2, 5.0))]), None)) == []
    assert list(processor.handleInputRows(("a",), iter([batch((60.0, 4, 5.0))]), None)) == []
    assert run(processor, handle, [(60.0, None, 5.0)])[60.0][-1] is None     # nulls first
    assert list(processor.handleExpiredTimer(("a",), None, Expired(0))) == [] and len(handle.kept) == 2
    processor.handleExpiredTimer(("a",), None, Expired(handle.timers[-1]))
    assert [r[0] for r in handle.kept] == [60_000_000]
    assert run(processor, handle, [(9.0 * DAY, 1, 1.0)])[9.0 * DAY][:1] == (1.0,)


def test_memory_of_many_readings_of_a_station(monkeypatch):
    """Readings stay in arrays, and rows come out and go to the state in steps."""
    import tracemalloc

    class Listed(FakeHandle):
        most = 0

        def put(self, rows):
            self.kept, self.most = len(rows), max(self.most, len(rows))

        def get(self):
            return iter([])

        def appendList(self, rows):
            self.kept, self.most = self.kept + len(rows), max(self.most, len(rows))
    monkeypatch.setattr(stateful, "STEP", 1000, raising=False)
    processor, handle, n = stateful.StationHistory(2 * DAY, 2), Listed(), 40_000
    processor.init(handle)
    tracemalloc.start()
    given = (batch(*[(a * 30.0 + k * 30.0, k % 5, k / 100) for k in range(1000)]) for a in range(0, n, 1000))
    sizes = [len(f) for f in processor.handleInputRows(("a",), given, None)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == n and max(sizes) <= 1000 and handle.most <= 1000 and handle.kept >= 3 * DAY // 30
    assert peak / n < 500


def test_stream_equals_batch_with_late_rows(spark, clean_of, tmp_path):
    draw = random.Random(6)
    given = [(draw.choice("ab"), float(draw.randrange(6 * DAY)), draw.choice([None, 1, 3, 5]), draw.randrange(9000) / 100)
             for _ in range(120)]
    given.sort(key=lambda r: r[1])
    late = [r for n, r in enumerate(given[:80]) if n % 9 == 0 and r[1] > 2 * DAY]
    parts = [[r for r in given[:80] if r not in late], late + given[80:]]
    src, feats, ckpt = (str(tmp_path / n) for n in ("clean", "features", "c"))
    for part in parts:
        clean_of(*part).coalesce(1).write.mode("append").partitionBy(*schemas.CLEAN_PARTITIONS).parquet(src)
        stateful.stateful_features(spark, src, feats, ckpt, late="4 days").awaitTermination()
    got, want = readers.read_features(spark, feats), features(clean_of(*given), scale=2)
    order = ["station_id", "timestamp_parsed"]
    assert rows(got, *order) == rows(want, *order)
