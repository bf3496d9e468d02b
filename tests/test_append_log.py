"""The append log: new rows only are written, and any kill leaves a state that can be read and repeated."""

import random
from pathlib import Path

import pytest

from tallyglass.operators.dedupe import keep_last
from tallyglass.schema import struct
from tallyglass.streaming import append_log as al

SCHEMA = struct("id int", "v", "seq int", "filing_year int")


def rows(df):
    return sorted(map(tuple, df.select("id", "v", "seq", "filing_year").collect()), key=str)


def files(path):
    return {p for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def log(spark, tmp_path):
    return al.AppendLog(spark, str(tmp_path / "table"), SCHEMA, "id", "seq")


def test_random_deliveries_equal_one_merge(spark, log):
    rnd, sent = random.Random(2), []
    assert rows(log.read()) == []
    for n in range(6):
        batch = [(rnd.choice([None, *range(40)]), f"v{n}-{i}", 100 * n + i, rnd.choice([None, 2021, 2022, 2023])) for i in range(25)]
        sent += batch
        log.append(spark.createDataFrame(batch, SCHEMA), n)
        want = rows(keep_last(spark.createDataFrame(sent, SCHEMA), ["id"], "seq"))
        assert rows(log.read()) == want  # not compacted yet
        if n % 2:
            log.compact()
            assert rows(log.read()) == want
    log.compact()  # nothing to do
    assert rows(log.read()) == want


def test_batches_write_their_rows_only(spark, log):
    log.append(spark.createDataFrame([(i, "a", 0, 2020 + i % 4) for i in range(400)], SCHEMA), 0)
    log.compact()
    base = files(f"{log.path}/base")
    for n in range(1, 4):
        log.append(spark.createDataFrame([(n, "b", n, 2021)], SCHEMA), n)
        assert files(f"{log.path}/base") == base
        assert spark.read.parquet(log._batch("batch", n)).count() == 1
    log.compact()
    # Keys 1, 2, 3 lay in 2021, 2022, 2023: the year 2020 keeps its files.
    assert {p for p in base if "filing_year=2020" in str(p)} <= files(f"{log.path}/base/version=0")
    assert not list(Path(f"{log.path}/base/version=1").glob("filing_year=2020"))
    assert {r[:1] + r[3:] for r in rows(log.read()) if r[1] == "b"} == {(1, 2021), (2, 2021), (3, 2021)}
    assert log.read().count() == 400


def test_kill_before_the_manifest(spark, log, monkeypatch):
    """A filing that moves to another year is in one year whatever happens."""
    log.append(spark.createDataFrame([(1, "old", 1, 2023), (2, "stay", 1, 2024)], SCHEMA), 0)
    log.compact()
    log.append(spark.createDataFrame([(1, "moved", 2, 2024)], SCHEMA), 1)
    want = [(1, "moved", 2, 2024), (2, "stay", 1, 2024)]

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(log, "_publish", killed)
        with pytest.raises(RuntimeError):
            log.compact()
    assert rows(log.read()) == want
    with monkeypatch.context() as m:
        m.setattr(log, "_sweep", killed)  # published, old files still there
        with pytest.raises(RuntimeError):
            log.compact()
    assert rows(log.read()) == want
    log.append(spark.createDataFrame([(1, "moved", 2, 2024)], SCHEMA), 1)  # sent again: skipped
    assert not log._pending(log._live()[1])
    log.compact()
    assert rows(log.read()) == want


def test_unfinished_batch_is_not_read(spark, log):
    log.append(spark.createDataFrame([(1, "a", 1, 2023)], SCHEMA), 0)
    Path(log._batch("batch", 0), "_SUCCESS").unlink()
    assert rows(log.read()) == []
    log.append(spark.createDataFrame([(1, "a", 1, 2023)], SCHEMA), 0)
    assert rows(log.read()) == [(1, "a", 1, 2023)]


def test_stream_killed_between_append_and_commit(spark, tmp_path, log, monkeypatch):
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")

    def deliver(data):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(src)

    deliver([(1, "a", 1, 2023), (2, "b", 1, 2024)])
    whole = log.append

    def append_and_die(*args):
        whole(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(log, "append", append_and_die)
        with pytest.raises(Exception, match="killed"):
            al.ingest_log(log, src, SCHEMA, ckpt)
    al.ingest_log(log, src, SCHEMA, ckpt)  # the batch is sent again
    assert rows(log.read()) == [(1, "a", 1, 2023), (2, "b", 1, 2024)]
    deliver([(2, "B", 2, 2023), (3, "c", 2, 2024)])
    al.ingest_log(log, src, SCHEMA, ckpt)
    al.ingest_log(log, src, SCHEMA, ckpt)  # nothing new
    want = [(1, "a", 1, 2023), (2, "B", 2, 2023), (3, "c", 2, 2024)]
    assert rows(log.read()) == want
    al.ingest_log(log, src, SCHEMA, str(tmp_path / "new"))  # a new checkpoint sends all files again, as a stream of its own
    assert rows(log.read()) == want
