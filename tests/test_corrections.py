"""The stream of raw records: late corrections count once, after restarts and behind the watermark too."""

from __future__ import annotations

from datetime import datetime, timedelta

from gridloom.plans.ingest import ingest_files
from gridloom.plans.pipeline import METER_FEED
from gridloom.schemas import DQ_QUARANTINE, STG_READINGS
from gridloom.sources.landing import METER_FILES
from gridloom.streaming.corrections import stream_corrections
from tests.conftest import RUN, rows

HEAD = "meter_id,reading_timestamp,consumption_kwh,unit\n"


def test_late_corrections(wh, landing, tmp_path):
    checkpoint, at = str(tmp_path / "checkpoint"), [RUN]

    def deliver(name: str, *lines: str) -> int:
        landing(f"meter_readings/readings_{name}.csv", HEAD + "".join(f"{line},kWh\n" for line in lines))
        at[0] += timedelta(days=1)
        ingest_files(wh, METER_FILES, landing.readings, at[0])
        return stream_corrections(wh, METER_FEED, checkpoint, lambda: at[0], keep="10 days")

    def stored():
        return [(m, str(t), float(k), i) for m, t, k, i in rows(wh.read(STG_READINGS), "meter_id", "reading_timestamp", "consumption_kwh", "_raw_id")]

    assert stream_corrections(wh, METER_FEED, checkpoint, lambda: at[0]) == 0  # no raw table yet
    assert deliver("1", "M1,2024-01-10 08:00,1", "M2,2024-01-10 08:00,2", "M2,bad,2") == 0
    first = {m: (k, i) for m, _, k, i in stored()}
    assert (first["M1"][0], first["M2"][0]) == (1, 2)
    deliver("2", "M1,2024-01-10 08:00,5", "M1,2024-01-10 08:00,6")  # a correction, corrected in its own file
    second = {m: (k, i) for m, _, k, i in stored()}
    assert second["M1"][0] == 6 and second["M2"] == first["M2"]
    assert deliver("3") == 0 and {m: (k, i) for m, _, k, i in stored()} == second  # a file without rows
    # Newer readings move the watermark past the first ones; a correction then comes behind it.
    deliver("4", "M1,2024-03-10 08:00,7")
    assert deliver("5", "M2,2024-01-10 08:00,9", "M1,2024-03-10 08:15,8") == 1
    last = {(m, str(t)): (k, i) for m, t, k, i in stored()}
    assert last["M2", "2024-01-10 08:00:00"][0] == 9 and last["M1", "2024-01-10 08:00:00"] == second["M1"]
    assert len(last) == 4
    assert rows(wh.read(DQ_QUARANTINE), "reason") == [("invalid_timestamp: bad",)]
    assert all(r[0] <= datetime(2024, 3, 1) for r in rows(wh.read(STG_READINGS), "_loaded_at"))
