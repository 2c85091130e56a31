"""Features as of the row, labels as of a date, gaps of a stream that stops and goes on."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txwarden.operators.asof import with_history, with_known_label
from txwarden.streaming.gaps import stream_gaps
from txwarden.streaming.velocity import open_windows, stream_velocity, write_available

START = datetime(2024, 1, 1)
SCHEMA = "eventId long, accountNumber long, transactionTime timestamp_ntz, transactionAmount double"


def _rows(n):
    """Account 1 in a third of the rows, null accounts and amounts, equal times."""
    for i in range(n):
        account = 1 if i % 3 == 0 else None if i % 11 == 0 else i % 17
        yield i, account, START + timedelta(hours=(i * 7) % 200), None if i % 5 == 0 else float(i)


def test_history_equals_brute_force(spark):
    rows = list(_rows(600))
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    got = with_history(df, {"accountNumber": ("n", "mean")})
    assert got.columns == [*df.columns, "n", "mean"]
    found = {r["eventId"]: (r["n"], r["mean"]) for r in got.collect()}
    assert len(found) == 600
    for i, account, time, _ in rows:
        if account is None:
            assert found[i] == (None, None)
            continue
        before = [r for r in rows if r[1] == account and (r[2], r[0]) < (time, i)]
        known = [r[3] for r in before if r[3] is not None]
        assert found[i][0] == len(before)
        assert found[i][1] == (pytest.approx(sum(known) / len(known)) if known else None)


def test_history_of_repeated_rows_and_of_none(spark):
    df = spark.createDataFrame([(1, 4, START, 2.0)] * 50, SCHEMA).repartition(4)
    got = with_history(df, {"accountNumber": ("n", "mean")}).collect()
    assert sorted(r["n"] for r in got) == list(range(50))
    assert {r["mean"] for r in got} == {None, 2.0}
    assert with_history(df.where("false"), {"accountNumber": ("n", "mean")}).count() == 0


def test_known_label(spark):
    times = [(1, START), (2, START + timedelta(days=40)), (3, None)]
    df = spark.createDataFrame(times, "eventId long, reportedTime timestamp_ntz")
    known = with_known_label(df, F.lit(START + timedelta(days=30)).cast("timestamp_ntz"))
    assert {r["eventId"]: r["known_fraud"] for r in known.collect()} == {1: 1, 2: 0, 3: 0}


def test_stream_gaps_go_on_after_a_stop(spark, tmp_path):
    rows = [r[:3] for r in _rows(300)]
    schema = SCHEMA.rsplit(",", 1)[0]
    rows.sort(key=lambda r: (r[2], r[0]))
    rows.append((999, 1, START - timedelta(days=1)))  # far too late
    rows.append((1000, 2, None))
    source = str(tmp_path / "in")
    for part in (rows[:120], rows[120:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = stream_gaps(spark.readStream.schema(schema).parquet(source))
        write_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = {r["eventId"]: r["time_since_last_transaction"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(found) == len(rows)
    last = {}
    for i, account, time in rows[:-2]:
        expected = (time - last[account]).total_seconds() if account is not None and account in last else None
        assert found[i] == expected, i
        if account is not None:
            last[account] = time
    assert found[999] is None and found[1000] is None


def test_open_and_closed_windows_are_all_windows(spark, tmp_path):
    schema = SCHEMA.rsplit(",", 1)[0]
    df = spark.createDataFrame([r[:3] for r in _rows(400)], schema)
    df.write.parquet(str(tmp_path / "in"))
    stream = stream_velocity(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    write_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "out"))
    found = closed.unionByName(open_windows(spark, str(tmp_path / "state")))
    day = F.date_trunc("day", "transactionTime").cast("timestamp_ntz").alias("window_start")
    expected = df.where("accountNumber is not null").groupBy("accountNumber", day).count()
    same = found.select("accountNumber", "window_start", "transaction_velocity")
    assert same.exceptAll(expected).count() == 0 and expected.exceptAll(same).count() == 0
