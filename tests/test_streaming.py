"""Snapshots taken batch by batch against all of them at once."""

import datetime
import json
import random

from staylink.streaming import snapshots as sn


def payload(ids, day):
    return json.dumps({"offers": [{"id": i, "location": {"lat": 39.0, "lng": 2.0}, "details": {"name": f"{i} on {day}", "bedroomsCount": 1, "guestsCount": 2,
                                                                                             "apartmentTypeTitle": "Villa"}} for i in ids]})


def test_batches_equal_the_whole(spark, tmp_path):
    rng = random.Random(3)
    days = [3, 1, 2, 5, 4]  # out of order: the second batch holds earlier captures
    rows = [(k, payload(rng.sample([f"h{i}" for i in range(40)], 15) + ["h0", "h0"], days[k // 4]), datetime.datetime(2025, 6, days[k // 4], k % 4)) for k in range(20)]
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    seen = []
    for part in (rows[:4], rows[4:12], [], rows[12:]):
        if part:
            spark.createDataFrame(part, sn.PAYLOADS).write.mode("append").parquet(source)
        sn.ingest(spark, source, table, check, "holidu").awaitTermination()
        seen += part
        want = sn.captures(spark.createDataFrame(seen, sn.PAYLOADS), "holidu")
        got = sn.first_seen_table(spark, table, "holidu").select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # the log grows by new and earlier captures only
    assert spark.read.parquet(table).count() < 3 * got.count()
