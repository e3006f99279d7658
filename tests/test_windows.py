"""Closed windows, corrections and restarts against the batch view."""

import random
from datetime import datetime, timedelta

import pytest

from tallyhouse.sources import commits
from tallyhouse.streaming import refresh, windows

from .conftest import rows

START = datetime(2024, 3, 1)


def stage_files(table, draw, folder, first, hours, n, name):
    found = [
        {"id": first + i, "channel": draw.choice((None, "Store", "Website")), "status": draw.choice(("Completed", "Cancelled", "Pending")), "total_amount": draw.choice((None, 5, 7.25)),
         "order_timestamp": draw.choice((None, *(START + timedelta(minutes=draw.randrange(hours[0] * 60, hours[1] * 60)) for _ in range(8))))}
        for i in range(n)
    ]
    df = table("orders", *found)
    df.coalesce(1).write.parquet(f"{folder}/{name}")
    return df


@pytest.mark.parametrize("seed", [1])
def test_equal_to_the_batch_view_with_late_rows_and_restarts(spark, table, tmp_path, seed):
    draw, staged, out = random.Random(seed), str(tmp_path / "staged"), str(tmp_path / "out")
    every = None

    def arrive(hours, n, name, close):
        nonlocal every
        df = stage_files(table, draw, staged, 1000 * len(name) + 100 * ord(name[-1]), hours, n, name)
        every = df if every is None else every.unionByName(df)
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(staged)
        windows.sort_arrivals(stream, out, str(tmp_path / "c1")).awaitTermination()
        if close:  # each run starts from its checkpoint
            windows.close_windows(spark, out, str(tmp_path / "c2")).awaitTermination()
        assert rows(windows.windowed_totals(spark, out)) == rows(refresh.windowed_sales(every))

    arrive((0, 4), 30, "a", True)
    arrive((3, 8), 30, "b", False)  # the second stream falls behind
    arrive((0, 9), 40, "c", True)  # some of these are late
    arrive((20, 21), 5, "d", True)
    delivered = windows.closed_sales(spark, out)
    closed = delivered.where("kind = 'closed'")
    assert closed.count() == closed.select("window_start", "channel").distinct().count() > 10  # each window once
    assert delivered.where("kind = 'late'").count() > 0
    parts = commits.current(spark, f"{out}/sums")[0].count()
    assert windows.merge_batches(spark, out) == parts > 4 and commits.current(spark, f"{out}/sums")[0].count() == 1
    assert rows(windows.windowed_totals(spark, out)) == rows(refresh.windowed_sales(every))
    arrive((0, 22), 20, "e", True)
    # A batch that is repeated finds itself delivered.
    windows._deliver(closed, f"{out}/sums", "closed-batch=0")
    assert rows(windows.windowed_totals(spark, out)) == rows(refresh.windowed_sales(every))
