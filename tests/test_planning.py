"""Every branch of the window rules."""

import datetime

import pytest

from chartloom.plans.windows import export_windows, plan_windows, read_sync_log, sync_cycle, task_messages

START = datetime.datetime(2024, 1, 1)


def minutes(n):
    return START + datetime.timedelta(minutes=n)


def planned(spark, lag, end=100_000, interval=15, multiplier=4, cycles=3):
    frame = spark.createDataFrame(
        [(START, minutes(lag), minutes(end))], "last timestamp, now timestamp, end timestamp"
    )
    rows = plan_windows(frame, interval, multiplier, cycles).orderBy("window_start").collect()
    return [
        ((r.window_start - START).seconds // 60, (r.window_end - START).seconds // 60) for r in rows
    ]


@pytest.mark.parametrize(
    ("lag", "end", "expected"),
    [
        (14, 1000, []),
        (15, 1000, [(0, 15)]),
        (29, 1000, [(0, 15)]),
        (15, 10, [(0, 10)]),
        (15, 0, []),
        (30, 1000, []),
        (59, 1000, []),
        (60, 1000, [(0, 60)]),
        (130, 1000, [(0, 60), (60, 120)]),
        (600, 1000, [(0, 60), (60, 120), (120, 180)]),
        (600, 90, [(0, 60), (60, 90)]),
        (600, 120, [(0, 60), (60, 120)]),
        (-5, 1000, []),
    ],
)
def test_windows(spark, lag, end, expected):
    assert planned(spark, lag, end) == expected


def test_export_windows_drop_or_keep_the_rest(spark):
    frame = spark.createDataFrame(
        [(START, START + datetime.timedelta(days=16))], "start timestamp, end timestamp"
    )
    assert export_windows(frame, 7, ["Patient"]).count() == 2
    kept = export_windows(frame, 7, ["Patient"], keep_rest=True).orderBy("since").collect()
    assert len(kept) == 3 and kept[-1].till == START + datetime.timedelta(days=16)


def test_message_folder_has_no_separators(spark):
    columns = "resource_type string, start_time string, end_time string, page_number int, " + (
        "fhir_url string, retry_count int, retry_message boolean"
    )
    rows = [("Patient", "2024-01-01T00:00:00", "2024-01-01T00:15:00", 1, "u", 0, False)]
    message = task_messages(spark.createDataFrame(rows, columns), "now").first()
    assert message.folder_name == "20240101T001500"


def test_each_sync_cycle_goes_on_where_the_log_ends(spark, tmp_path):
    log = f"{tmp_path}/log"

    def cycle(number, now):
        span = ("2024-01-01", "2030-01-01", now)
        tasks = sync_cycle(spark, log, number, *span, ["Patient", "Encounter"], 15, 4, 3).collect()
        return sorted((t.resource_type, t.start_time[11:16], t.end_time[11:16]) for t in tasks)

    first = [(r, "00:00", "00:15") for r in ("Encounter", "Patient")]
    assert cycle(1, "2024-01-01 00:15:00") == first
    assert cycle(2, "2024-01-01 00:20:00") == []
    assert cycle(3, "2024-01-01 00:31:00") == [(r, "00:15", "00:30") for r in ("Encounter", "Patient")]
    assert cycle(1, "2024-01-01 00:15:00") == first
    assert read_sync_log(spark, log).count() == 2
