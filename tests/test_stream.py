"""Activity stream: overlapping extracts, restarts, late and repeated files."""

import json

from helpers import rows
from tenantlens.sources.tables import TableStore
from tenantlens.streaming.activity import activity_stream


def event(number, day):
    return {"Id": f"a{number}", "CreationTime": f"2026-08-{day:02d}T09:00:00", "IsSuccess": True}


def test_overlapping_files_and_restarts(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    landing.mkdir()
    store = TableStore(spark, str(tmp_path / "tables"))

    def land(name, *events):
        lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
        (landing / f"{name}.json").write_text("\n".join(lines) + "\n")

    def run(place=checkpoint, **options):
        activity_stream(spark, str(landing), store, str(place), **options).awaitTermination()
        return [r[0] for r in rows(store.read("bronze.activity"), "Id")]

    land("day1", event(1, 1), event(2, 1))
    land("day2", event(2, 1), event(3, 2), "broken line")
    assert run() == ["a1", "a2", "a3"]
    land("day3", event(1, 1), event(3, 2), event(4, 3))
    land("late", event(0, 1))
    assert run(max_files_per_batch=1) == ["a0", "a1", "a2", "a3", "a4"]
    assert run() == ["a0", "a1", "a2", "a3", "a4"]
    assert [r[0] for r in rows(store.read("quarantine.activity_stream"), "line")] == ["broken line"]
    # without its checkpoint the stream reads all files again and adds nothing
    assert run(tmp_path / "new checkpoint") == ["a0", "a1", "a2", "a3", "a4"]
