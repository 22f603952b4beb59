"""Files as they arrive, their archive, and status as stream state."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

from lotkeeper.operators import availability as A
from lotkeeper.operators import market
from lotkeeper.operators.weekly import merge_snapshot
from lotkeeper.session import scratch_path
from lotkeeper.sources.listing_files import scan_listing_csv
from lotkeeper.sources.state import KeyedState
from lotkeeper.streaming import files as FS
from lotkeeper.streaming import ingest as IN
from lotkeeper.streaming import status as ST
from rows import values

NOW = "2026-01-10 00:00:00"
COLUMNS = ["ads_id", "subject", "price"]
SCHEMA = "ads_id bigint, subject string, price bigint, first_seen_at string, last_seen_at string, availability_status string"
FILES = [("a/cars.csv", "ads_id,subject,price\n1,First,RM 5\n2,Two,\n"), ("b/cars.csv", "price,ads_id\nRM 7,1\n\"1,500\",3\n"),
         ("c/cars.csv", "subject,ads_id\nLast,1\nnew,4\n"), ("d/more.csv", "ads_id,price\n4,RM 9\n")]


def deliver(folder, files, start=1_000):
    for i, (name, text) in enumerate(files):
        path = f"{folder}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        os.utime(path, (start + i, start + i))


def run(spark, folder, state, checkpoint, archive=None, per_batch=1):
    FS.stream_snapshots(spark, folder, state, checkpoint, "cars", NOW, COLUMNS, per_batch, archive, SCHEMA).awaitTermination()


@pytest.mark.parametrize("per_batch", [1, 2])
def test_files_as_they_arrive_give_what_all_files_give(spark, tmp_path, per_batch):
    folder = str(tmp_path / "in")
    deliver(folder, FILES)
    empty = spark.createDataFrame([], SCHEMA)
    want = values(merge_snapshot(empty, scan_listing_csv(spark, [f"{folder}/{n}" for n, _ in FILES], COLUMNS), "cars", NOW))
    stream = str(tmp_path / "stream")
    state, checkpoint = KeyedState(spark, scratch_path(spark, "t"), buckets=2), scratch_path(spark, "cp")
    state.write(empty, 0)
    archive = FS.Archive(spark, str(tmp_path / "old"), scratch_path(spark, "journals"))
    deliver(stream, FILES[:3])
    run(spark, stream, state, checkpoint, archive, per_batch)
    left = [f for _, _, names in os.walk(stream) for f in names if f.endswith(".csv")]
    assert left == []
    deliver(stream, FILES[3:], 2_000)
    run(spark, stream, state, checkpoint, archive, per_batch)
    assert values(state.read(SCHEMA)) == want
    assert sorted(f for f in os.listdir(archive.root) if f.endswith(".csv")) == ["cars.csv", "cars_1.csv", "cars_2.csv", "more.csv"]


def test_a_replayed_batch_finishes_its_moves(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    deliver(folder, FILES[:2])
    state, checkpoint = KeyedState(spark, scratch_path(spark, "t"), buckets=2), scratch_path(spark, "cp")
    state.write(spark.createDataFrame([], SCHEMA), 0)
    archive = FS.Archive(spark, str(tmp_path / "old"), scratch_path(spark, "journals"))
    lost = lambda self, batch: (_ for _ in ()).throw(OSError("lost"))
    with monkeypatch.context() as m:
        m.setattr(FS.Archive, "finish", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, folder, state, checkpoint, archive, 2)
    assert state.version() == 1 and not os.path.isdir(archive.root)
    before = values(state.read())
    run(spark, folder, state, checkpoint, archive, 2)
    run(spark, folder, state, checkpoint, archive, 2)
    assert values(state.read()) == before and state.version() == 1
    assert sorted(f for f in os.listdir(archive.root) if f.endswith(".csv")) == ["cars.csv", "cars_1.csv"]


def probes(seed, n=120):
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    hours = sorted(rng.sample(range(24 * 40), n))
    return [(rng.choice([1, 1, 2, 3, 4]), start + timedelta(hours=h),
             rng.choice(["available", "removed", "soft_404", "removed", "blocked", "transient"])) for h in hours]


@pytest.fixture
def state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ST.STATE_STORE)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def streamed(spark, parts, initial=None, **options):
    source, checkpoint, out = (scratch_path(spark, x) for x in ("probes", "cp", "out"))
    schema = "ads_id long, checked_at timestamp, detected_status string"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        rows = ST.stream_status(IN.file_stream(spark, source, spark.createDataFrame([], schema).schema), initial, **options)
        (rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).start().awaitTermination())
    return spark.read.parquet(out)


@pytest.mark.parametrize("cuts", [(), (50,), (10, 11, 100)])
def test_any_split_gives_the_running_status(spark, state_store, cuts):
    rows = probes(3)
    bounds = [0, *cuts, len(rows)]
    initial = spark.createDataFrame([(1, "available"), (2, None), (9, "unavailable")], "ads_id long, availability_status string")
    whole = spark.createDataFrame(rows, "ads_id long, checked_at timestamp, detected_status string")
    found = streamed(spark, [rows[a:b] for a, b in zip(bounds, bounds[1:])], initial)
    columns = ["ads_id", "checked_at", "detected_status", "status"]
    assert values(found, *columns) == values(A.running_status(whole, initial), *columns)
    last = {r.ads_id: r for r in sorted(found.collect(), key=lambda r: r.checked_at)}
    assert sorted((i, r.failing_since) for i, r in last.items() if r.failing_since) == [
        tuple(r) for r in values(market.confirmed_unavailable(whole))]


def test_ads_without_news_are_closed(spark, state_store):
    day = lambda d: datetime(2026, 1, d)
    found = streamed(spark, [[(1, day(1), "removed"), (2, day(2), "available")], [(3, day(16), "available")], [(1, day(20), "removed")]],
                     close_days=14)
    closed = found.where("event = 'closed'")
    assert values(closed, "ads_id", "checked_at", "status") == [(1, day(15), "unavailable")]
    assert values(found.where("event = 'probe'"), "ads_id", "status") == [
        (1, "unavailable"), (1, "unavailable"), (2, "available"), (3, "available")]


def test_ads_without_an_id_do_not_disturb_others(spark, state_store):
    rows = probes(5) + [(None, at, status) for _, at, status in probes(6)]
    rows.sort(key=lambda r: r[1])
    initial = spark.createDataFrame([(i, "unknown") for i in range(40)], "ads_id long, availability_status string")
    whole = spark.createDataFrame(rows, "ads_id long, checked_at timestamp, detected_status string")
    found = streamed(spark, [rows[:80], rows[80:160], rows[160:]], initial)
    columns = ["ads_id", "checked_at", "detected_status", "status"]
    assert values(found, *columns) == values(A.running_status(whole, initial), *columns)


def test_an_ad_is_followed_by_plain_rows():
    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        ad = Held()

        def getValueState(self, name, schema):  # noqa: N802
            return self.ad

    ad = ST.AdStatus({"available": "available", "removed": "unavailable"}, 2, None)
    ad.init(Handle())
    probes = [Row(at=at, detected_status=d) for at, d in ((3, "removed"), (None, "available"), (2, "removed"), (1, "available"))]
    assert [(r.checked_at, r.status, r.failing_since) for r in ad.handleInputRows((7,), iter(probes), None)] == [
        (1, "available", None), (2, "unavailable", None), (3, "unavailable", 2), (None, "unavailable", 2)]
    assert Handle.ad.value == ("unavailable", [2, 3], 3)
