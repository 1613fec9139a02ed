"""The worst hour is looked for among all hours with at least 50 test flights, as first registered."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq

from oracle_compare import duck
from punctuo.plans.oracle import ORACLE
from punctuo.plans.queries import REGISTRY


def test_hours_with_50_to_99_flights_take_part(spark, tmp_path):
    rows = []
    for hour, n, value in ((5, 120, 0.0), (6, 50, 60.0), (7, 49, 60.0)):  # every flight of 6 and 7 is late
        rows += [{"event_id": 1000 * hour + i, "ts": dt.datetime(2024, 1, 1, hour), "user_id": i, "value": value, "event_type": "view"} for i in range(n)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "events.parquet")
    got = [r.asDict() for r in REGISTRY["pred_worst_hour"](spark, str(tmp_path)).collect()]
    assert [(r["hour"], r["n"]) for r in got] == [(6, 50)]
    cur = duck(tmp_path).execute(ORACLE["pred_worst_hour"])
    assert [dict(zip((d[0] for d in cur.description), r, strict=True)) for r in cur.fetchall()] == got
