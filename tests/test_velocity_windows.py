"""Windows kept from stream state equal the batch table, open ones included, also after a crash."""

import datetime as dt

import pytest

from ledgerlake.config import DEFAULT, scratch_path
from ledgerlake.operators import kpis
from ledgerlake.sources import tables
from ledgerlake.streaming import live

from conftest import T0, make_txns, txn

FEW = DEFAULT.with_(velocity_min_count=1)


def test_windows_from_state(spark, monkeypatch):
    at = lambda day, minute, n: [txn(day * 1000 + minute * 10 + k, T0 + dt.timedelta(days=day, minutes=minute), customer_id=str(k % 2)) for k in range(n)]
    arrivals = [at(0, 0, 5) + at(0, 4, 2), at(0, 4, 3) + at(1, 0, 4), at(1, 1, 6)]
    landing, table, ckpt = (scratch_path(spark, f"t-vel-{p}") for p in ("landing", "table", "ckpt"))
    replace = tables.replace_parts

    def crashing(*args, **options):
        replace(*args, **options)
        raise RuntimeError("driver lost")

    for n, rows in enumerate(arrivals):
        make_txns(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        if n == 1:  # lost after the publication, before the stream commits the batch
            with monkeypatch.context() as m:
                m.setattr(live, "replace_parts", crashing)
                with pytest.raises(Exception):
                    live.run_velocity_windows(live.table_stream(spark, landing), table, ckpt, FEW)
        live.run_velocity_windows(live.table_stream(spark, landing), table, ckpt, FEW)
        every = make_txns(spark, [r for a in arrivals[: n + 1] for r in a])
        want = kpis.kpi_transaction_velocity(every, FEW).select("window.start", "window.end", "customer_id", "count")
        got = live.velocity_windows(spark, table, FEW).select("window_start", "window_end", "customer_id", "count")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
