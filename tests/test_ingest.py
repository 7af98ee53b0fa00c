"""Incremental ingest: portions arrive, each is staged once, a run without new files reads nothing."""

import gzip
import json

from pyspark.sql import functions as F

import checks.adapter
import checks.ingest
from freightloom.sources.events import EVENT_SCHEMA
from freightloom.streaming.ingest import ingest, quarantine, staged_events


def _drop(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_portions_are_staged_once(spark, tmp_path):
    landing, staged, checkpoint = tmp_path / "landing", str(tmp_path / "staged"), str(tmp_path / "cp")
    reads = []
    for portion in range(3):
        orders = [json.dumps({"event_type": "OrderCreated", "order_reference": f"O-{portion}-{i}", "timestamp": f"2024-01-0{portion + 1}T10:00:00"}) for i in range(5)]
        _drop(landing / "erp" / f"p{portion}", "orders.json", orders)
        _drop(landing / "erp" / f"bad{portion}", "broken.json", ["{\"event_type\": ", "[1, 2"])
        _drop(landing / "tms" / f"p{portion}", "carriers.json", [json.dumps({"event_type": "CarrierCreated", "carrier_id": f"C{portion}", "timestamp": "2024-02-01T00:00:00"})])
        reads.append(ingest(spark, str(landing), staged, str(checkpoint)))
    reads.append(ingest(spark, str(landing), staged, str(checkpoint)))
    assert reads == [8, 8, 8, 0]
    events = staged_events(spark, staged)
    good = events.where(F.col("_corrupt_record").isNull())
    assert good.count() == 18 and good.select("order_reference").distinct().count() == 16  # 15 orders and the carriers' null
    assert {(r.system, r.event_type, str(r.event_day)) for r in good.select("system", "event_type", "event_day").distinct().collect()} == {
        ("erp", "OrderCreated", "2024-01-01"), ("erp", "OrderCreated", "2024-01-02"), ("erp", "OrderCreated", "2024-01-03"), ("tms", "CarrierCreated", "2024-02-01")
    }
    assert quarantine(events).count() == 6
    assert events.where("event_type = 'CarrierCreated' AND event_day = '2024-02-01'").count() == 3


def test_dropping_bad_lines(spark, tmp_path):
    landing = tmp_path / "landing"
    _drop(landing / "wms" / "p0", "a.json", [json.dumps({"event_type": "WarehouseSKUCreated", "sku": "S1", "timestamp": "2024-01-01T00:00:00"}), "{oops"])
    assert ingest(spark, str(landing), str(tmp_path / "s"), str(tmp_path / "c"), on_bad="drop") == 1
    assert staged_events(spark, str(tmp_path / "s")).count() == 1


def test_a_folder_gets_few_files(spark, tmp_path):
    """Twenty files with the same sixty days of one type make a file for each month, whatever the number of tasks."""
    landing, staged = tmp_path / "landing", tmp_path / "staged"
    days = [f"2024-0{m}-{d:02d}" for m in (1, 2, 3) for d in range(1, 21)]
    for k in range(20):
        lines = [json.dumps({"event_type": "CarrierCreated", "carrier_id": f"C{k}-{day}", "timestamp": f"{day}T00:00:00"}) for day in days]
        _drop(landing / "tms" / f"p{k}", "carriers.json", lines)
    assert ingest(spark, str(landing), str(staged), str(tmp_path / "c")) == 1200
    assert len(list(staged.rglob("part-*.parquet"))) == 3
    events = staged_events(spark, str(staged))
    assert events.select("carrier_id").distinct().count() == 1200
    assert events.where("event_day = '2024-02-11'").count() == 20


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_run_stages_a_bounded_number_of_bytes_at_a_time(spark, tmp_path):
    """Seven files in batches of one file: each is staged once, all are counted, and the shuffle of a batch goes with it."""
    landing, staged, checkpoint = tmp_path / "landing", tmp_path / "staged", tmp_path / "c"
    for k in range(7):
        _drop(landing / "tms" / f"p{k}", "carriers.json", [json.dumps({"event_type": "CarrierCreated", "carrier_id": f"C{k}", "timestamp": "2024-02-01T00:00:00"})])
    before = _shuffle_files(spark)
    assert ingest(spark, str(landing), str(staged), str(checkpoint), batch_bytes=1) == 7
    assert len([f for f in (checkpoint / "commits").iterdir() if f.name.isdigit()]) == 7
    assert _shuffle_files(spark) - before == set()
    assert ingest(spark, str(landing), str(staged), str(checkpoint), batch_bytes=1) == 0
    assert sorted(r.carrier_id for r in staged_events(spark, str(staged)).collect()) == [f"C{k}" for k in range(7)]


class _Few:
    """Two sources of one system, none of the others."""

    def __init__(self, spark):
        self.spark, self.unstaged = spark, False
        given = lambda kind, n: spark.range(n).select(
            *[{"event_type": F.lit(kind), "sku": F.format_string("%s-%d \u00e4\n", F.lit(kind), "id"), "timestamp": F.lit("2024-01-01T00:00:00")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
        )
        self.wms_parts = lambda: [given("WarehouseSKUCreated", 40), given("NodeProcessed", 20)]
        self.erp_parts = self.tms_parts = list

    def unstage(self):
        self.unstaged = True


def test_events_land_compressed_and_once(spark, tmp_path, monkeypatch):
    """The landed lines are the only other copy of the events: nothing of what they were written from stays."""
    monkeypatch.setattr(checks.ingest, "shared_dir", lambda spark: str(tmp_path))
    d, before = _Few(spark), _shuffle_files(spark)
    events, read = checks.ingest.land_and_ingest(d, "quarantine")
    assert _shuffle_files(spark) - before == set()
    assert d.unstaged and sum(read) == 60 + 18 and read[3] == 0
    (base,) = tmp_path.glob("ingest-*")
    files = [f for f in base.rglob("part-*") if "staged" not in f.parts]
    assert files and all(f.name.endswith(".json.gz") and "landing" in f.parts for f in files)
    lines = [json.loads(line) for f in files for line in gzip.open(f, "rt", encoding="utf-8")]
    skus = sorted([f"WarehouseSKUCreated-{k} \u00e4\n" for k in range(40)] + [f"NodeProcessed-{k} \u00e4\n" for k in range(20)])
    assert sorted(x["sku"] for x in lines) == skus
    good = events.where("_corrupt_record IS NULL")
    assert sorted(r.sku for r in good.select("sku", "system").where("system = 'wms'").collect()) == skus
    assert quarantine(events).count() == 18


def test_staged_tables_go_when_nothing_reads_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checks.adapter, "shared_dir", lambda spark: str(tmp_path))
    d = checks.adapter.Driver(spark, str(tmp_path / "none"))
    assert d.stage("numbers", lambda: spark.range(3)).count() == 3
    assert list(tmp_path.glob("numbers-*"))
    d.unstage()
    assert not list(tmp_path.glob("numbers-*"))
    assert d.stage("numbers", lambda: spark.range(4)).count() == 4
