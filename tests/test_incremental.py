"""A forecast kept up to date batch by batch equals the one made from the whole log."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from supplyscope.operators import history as H
from supplyscope.operators import incremental as I
from supplyscope.operators.forecast import forecast_ema
from supplyscope.plans import jobs
from supplyscope.plans.forecast_jobs import fleet_forecast_ema, incremental_forecast, time_batches
from supplyscope.session import scratch_path
from supplyscope.sources import fixtures as X
from supplyscope.sources.tables import HISTORY_SCHEMA, read_history

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def log_row(seq, ip, stamp, level, modelo="M", estado="OK", nombre="n", kit=None):
    stamp = stamp if isinstance(stamp, str) or stamp is None else stamp.strftime("%Y-%m-%d %H:%M:%S")
    return (seq, nombre, ip, modelo, level, None, None, None, kit, None, estado, stamp)


def frame(spark, rows):
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def dirty_log(days=60, devices=12, seed=4):
    """Levels that fall, rise, stall and go missing; repeated rows, bad stamps, null keys, other statuses."""
    rng, rows, seq = random.Random(seed), [], 0
    level = {i: 100.0 for i in range(devices)}
    for day in range(days):
        for i in range(devices):
            if rng.random() < 0.3:
                continue
            t = T0 + dt.timedelta(days=day, hours=rng.randint(0, 23))
            level[i] = 100.0 if level[i] < 4 else level[i] - rng.choice([0, 0, 0.5, 3, -1])
            for _ in range(1 + (rng.random() < 0.2)):
                seq += 1
                stamp = "not a date" if rng.random() < 0.03 else t
                rows.append(log_row(seq, None if i == 0 else f"10.0.0.{i}", stamp,
                                    rng.choice(["", "--", None, f"{level[i]:.1f}%"]) if rng.random() < 0.1 else f"{level[i]:.1f}%",
                                    modelo=None if i == 1 and day % 3 else f"M{i % 3}", nombre=f"P{i}-{day // 20}",
                                    estado=rng.choice(["OK", " OK ", "OK", "Fuera de Red"]),
                                    kit=f"{level[i] / 2:.1f}%" if i % 4 == 0 else None))
    return rows


def by_time(rows, n, days=60):
    """Cut by reading time as a log grows; unparsed stamps by their place."""
    out = [[] for _ in range(n)]
    for r in rows:
        try:
            part = int((dt.datetime.fromisoformat(r[-1]) - T0).days * n // (days + 1))
        except ValueError:
            part = r[0] * n // (len(rows) + 1)
        out[min(n - 1, part)].append(r)
    return out


def same(got, want):
    got, want = ({(r.ip, r.modelo, r.consumible): r for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c in w.__fields__:
            g, v = got[k][c], w[c]
            assert g == v or (isinstance(v, float) and abs(g - v) < 1e-9), (k, c, g, v)


@pytest.mark.parametrize("n", [1, 3, 7])
def test_batches_equal_the_whole_log(spark, n):
    rows = dirty_log()
    want = fleet_forecast_ema(frame(spark, rows))
    same(incremental_forecast([frame(spark, b) for b in by_time(rows, n)], mode="off"), want)


def test_fixture_log_in_time_batches(spark):
    raw = X.history_raw(spark, SF)
    parts = time_batches(raw, 3)
    assert sum(p.count() for p in parts) == raw.count()
    same(incremental_forecast(parts), fleet_forecast_ema(raw))


def test_a_hot_device_goes_in_blocks(spark):
    rows = [log_row(i, "hot" if i % 3 == 0 else f"d{i % 40}", T0 + dt.timedelta(hours=i), f"{100 - (i * 7 % 90)}%") for i in range(900)]
    half = [r for r in rows if r[0] < 450], [r for r in rows if r[0] >= 450]
    want = forecast_ema(H.clean_history(frame(spark, rows)), mode="off")
    same(incremental_forecast([frame(spark, h) for h in half], alerts=False, mode="force"), want)


def _read_paths(df):
    """Folders that the plan scans."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", plan)), plan


def test_a_batch_reads_itself_and_the_state_only(spark):
    rows, root = dirty_log(30, 6), scratch_path(spark, "inc")
    state, files = I.empty_state(spark), []
    for i, b in enumerate(by_time(rows, 3, 30)):
        frame(spark, b).write.parquet(f"{root}/batch{i}")
        batch = read_history(spark, f"{root}/batch{i}")
        nxt, late = I.update(state, batch, mode="off")
        for f in I.SCHEMAS:
            found, plan = _read_paths(getattr(nxt, f))
            files = [p for x in found for p in x.split(", ")]
            assert all(p.endswith(f"batch{i}") or f"state{i - 1}/" in p for p in files), files
            assert "Python" not in plan
        state = I.write_state(nxt, f"{root}/state{i}")
    assert any("state1/" in p for p in files) or files
    found, plan = _read_paths(I.forecast_of(state))
    assert all("state2/" in p for x in found for p in x.split(", "))
    assert late.count() == 0


def test_late_rows_come_back_and_rebuild_mends(spark):
    rows = [log_row(i, f"d{i % 3}", T0 + dt.timedelta(days=i), f"{100 - i}%") for i in range(30)]
    first, second = rows[:20], rows[20:] + [
        log_row(100, "d1", rows[4][-1], "50%"),                             # repeats a reading that was taken
        log_row(101, "d2", T0 + dt.timedelta(days=3, hours=5), "80%")]      # came too late
    state, late0 = I.update(I.empty_state(spark), frame(spark, first), mode="off")
    state = I.write_state(state, scratch_path(spark, "late"))
    state, late = I.update(state, frame(spark, second), mode="off")
    assert late0.count() == 0 and {r.seq for r in late.collect()} == {100, 101}
    log = frame(spark, first + second)
    mended = I.rebuild(state, log, late.select("ip"), mode="off")
    same(I.forecast_of(mended), fleet_forecast_ema(log))


def test_empty_batches_change_nothing(spark):
    rows = dirty_log(20, 5)
    whole = fleet_forecast_ema(frame(spark, rows))
    same(incremental_forecast([frame(spark, []), frame(spark, rows), frame(spark, [])], mode="off"), whole)
    assert incremental_forecast([frame(spark, [])], mode="off").collect() == []


def test_state_is_one_row_a_series(spark):
    state, _ = I.update(I.empty_state(spark), frame(spark, dirty_log()), mode="off")
    assert state.series.count() == state.series.select("ip", "modelo", "consumible").distinct().count()
    assert state.clock.count() == state.clock.select("ip").distinct().count()
    assert state.series.agg(F.max("n")).first()[0] > 20


def test_job_over_stored_tables(spark):
    root = scratch_path(spark, "inc-job")
    rows = dirty_log(30, 6)
    for i, b in enumerate(by_time(rows, 2, 30)):
        frame(spark, b).write.parquet(f"{root}/b{i}")
    assert jobs.update_forecast_job(spark, f"{root}/b0", None, f"{root}/s0", f"{root}/f0") == 0
    assert jobs.update_forecast_job(spark, f"{root}/b1", f"{root}/s0", f"{root}/s1", f"{root}/f1", f"{root}/l1") == 0
    same(spark.read.parquet(f"{root}/f1"), fleet_forecast_ema(frame(spark, rows)))
    with pytest.raises(ValueError):
        jobs.update_forecast_job(spark, f"{root}/b1", f"{root}/s1", f"{root}/s1", f"{root}/f2")
