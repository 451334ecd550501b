"""Snapshot sources and sinks on small hand-made files."""
import json
import os

from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.operators.normalize import normalize_abuse, normalize_state
from ipscope.sinks.store import publish_json, snapshot_manifest, write_snapshot
from ipscope.sources.snapshots import newest_file, read_envelope, read_json_lines, read_parquet_snapshot


def test_envelope_object_list_and_empty(spark, tmp_path):
    recs = [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": "100.0", "lastReportedAt": "2024-01-02"},
            {"ipAddress": "", "abuseConfidenceScore": 5},
            {"ipAddress": "1.1.1.1", "abuseConfidenceScore": "7", "countryCode": "DE"}]
    (tmp_path / "a.json").write_text(json.dumps({"source": "blacklist", "ingestion_time": "t0",
                                                  "record_count": 3, "data": recs}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(recs[:1]))
    (tmp_path / "c.json").write_text(json.dumps({"source": "x"}))
    (tmp_path / "d.json").write_text(json.dumps({"source": "x", "data": []}))
    df = read_envelope(spark, str(tmp_path), S.RAW_ABUSE_RECORD)
    by_file = {os.path.basename(r.source_file): r for r in
               df.groupBy("source_file").agg(F.count("*").alias("n")).collect()}
    assert by_file["a.json"].n == 3 and by_file["b.json"].n == 1
    assert "c.json" not in by_file and "d.json" not in by_file
    a = normalize_abuse(df.filter(F.col("source_file").endswith("a.json")), None, "p").orderBy("pos").collect()
    assert [r.abuse_confidence_score for r in a] == [100, 5, 7]
    assert a[0].ingestion_time == "t0"
    st = normalize_state(df.filter(F.col("source_file").endswith("a.json"))).collect()
    assert [r.ip_address for r in st] == ["1.1.1.1", "1.1.1.1"]


def test_newest_file_and_missing(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for i, n in enumerate(["old.json", "new.json", "skip.txt"]):
        p = tmp_path / "x" / n
        p.write_text("[]")
        os.utime(p, (1000 + i, 1000 + i))
    assert newest_file(spark, str(tmp_path / "x"), ".json").endswith("new.json")
    assert newest_file(spark, str(tmp_path / "nope"), ".json") is None
    assert read_parquet_snapshot(spark, str(tmp_path / "nope"), S.PULSE).count() == 0


def test_snapshot_writers_and_publish(spark, tmp_path):
    df = spark.createDataFrame([("1.1.1.1", None), ("2.2.2.2", "DE")], "ip_address string, country_code string")
    write_snapshot(df, str(tmp_path / "snap"), "2024-04-05T06:07:08Z")
    back = spark.read.parquet(str(tmp_path / "snap"))
    assert set(back.columns) >= {"year", "month", "day", "run_id"}
    assert back.select("month").first()[0] == "04"
    assert snapshot_manifest(df, "blacklist", "t").first().record_count == 2
    publish_json(df, fmt="text", path=str(tmp_path / "pub"))
    vals = sorted(r.value for r in spark.read.text(str(tmp_path / "pub")).collect())
    assert vals[0] == '{"ip_address":"1.1.1.1","country_code":null}'


def test_json_lines_positions(spark, tmp_path):
    lines = [json.dumps({"ipAddress": f"1.1.1.{i}"}) for i in range(50)]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    df = read_json_lines(spark, str(tmp_path / "r.jsonl"), S.RAW_ABUSE_RECORD)
    got = [r.ipAddress for r in df.orderBy("pos").collect()]
    assert got == [f"1.1.1.{i}" for i in range(50)]


def test_snapshot_gate_first_run_commit_and_change(spark, tmp_path):
    from ipscope import standin
    from ipscope.sinks.state import SnapshotGate
    from sf_dirs import SF_SMALL
    gate = SnapshotGate(spark, str(tmp_path / "state"))
    prev = standin.view(spark, SF_SMALL, "v_prev").select("pos", "ip_address", "abuse_confidence_score",
                                                           "last_reported_at", "country_code")
    curr = standin.view(spark, SF_SMALL, "v_curr").select(*prev.columns)
    first = gate.detect(prev).first()
    assert first.changed and first.previous_fingerprint is None
    assert gate.commit(prev, "raw/prev.json", "t1") == 1
    same = gate.detect(prev).first()
    assert not same.changed and same.new_ip_count == same.removed_ip_count == same.changed_ip_count == 0
    moved = gate.detect(curr).first()
    assert moved.changed
    from ipscope.operators.changes import diff_snapshots, diff_summary
    exp = diff_summary(diff_snapshots(prev, curr)).first()
    assert (moved.new_ip_count, moved.changed_ip_count, moved.removed_ip_count) == tuple(exp)
    assert gate.commit(curr, "raw/curr.json", "t2") == 2
    assert not gate.should_run(curr)


def test_normalize_typed_tolerant(spark):
    from ipscope.operators.normalize import normalize_typed
    df = spark.createDataFrame([("1.1.1.1", "12.5", "7.9", '["a", " "]', "yes")],
                               "ip_address string, otx_reputation string, otx_pulse_count string, "
                               "otx_pulse_names string, geo_is_eu string")
    r = normalize_typed(df, S.PULSE).first()
    assert r.otx_reputation == 12.5 and r.otx_pulse_count == 7 and list(r.otx_pulse_names) == ["a"]
    g = normalize_typed(df, S.GEO).first()
    assert g.geo_is_eu is True


def test_carry_forward_retry_errors(spark):
    from ipscope.operators.changes import carry_forward
    old = spark.createDataFrame([("1.1.1.1", "ok", "t0", "1"), ("2.2.2.2", "ReadTimeout", "t0", "1")],
                                "ip string, status string, first_ingestion_time string, seen_count string")
    cands = spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",), ("3.3.3.3",)], "ip string")
    fresh = spark.createDataFrame([("2.2.2.2", "ok", "t1", "1"), ("3.3.3.3", "ok", "t1", "1")],
                                  old.schema)
    snap, cnt = carry_forward(old, cands, fresh)
    assert {r.ip: r.status for r in snap.collect()}["2.2.2.2"] == "ReadTimeout"
    assert tuple(cnt.first()) == (1, 0, 2, 3)
    snap, cnt = carry_forward(old, cands, fresh, retry_errors=True)
    rows = {r.ip: r for r in snap.collect()}
    assert rows["2.2.2.2"].status == "ok" and rows["2.2.2.2"].seen_count == "2"
    assert rows["2.2.2.2"].first_ingestion_time == "t0"
    assert tuple(cnt.first()) == (1, 1, 1, 3)


def test_newest_run_is_read_alone_and_typed_in_any_session(spark, tmp_path):
    from ipscope.plans.jobs import latest_processed
    root = str(tmp_path / "processed")
    assert latest_processed(spark, root).count() == 0
    rows = spark.createDataFrame([("1.1.1.1", "DE", 5, "t", "i", "p")], S.ABUSE)
    for run, n in (("2024-01-09T00:00:00Z", 3), ("2024-02-01T00:00:00Z", 1), ("2024-02-01T00:00:00Z", 2)):
        write_snapshot(rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("n"), root, run)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    try:
        for infer in ("true", "false"):
            spark.conf.set(key, infer)
            got = latest_processed(spark, root)
            assert [tuple(r)[-4:] for r in got.collect()] == [("2024", "02", "01", "20240201000000")] * 2
            assert all("/month=02/" in f for f in got.inputFiles())
    finally:
        spark.conf.set(key, before)


def test_raw_snapshot_reads_the_newest_run_only(spark, tmp_path):
    from ipscope.sinks.store import read_raw_snapshot, write_raw_snapshot
    df = spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",)], "ipAddress string")
    for run in ("2024-01-09T00:00:00Z", "2024-02-01T00:00:00Z"):
        write_raw_snapshot(df, str(tmp_path), run, "feed")
    got = read_raw_snapshot(spark, str(tmp_path), df.schema)
    assert {tuple(r) for r in got.collect()} == {("feed", "2024-02-01T00:00:00Z", 2, ip) for ip in ("1.1.1.1", "2.2.2.2")}
    assert all("run_id=20240201000000" in f for f in got.inputFiles())


def test_newest_of_every_prefix_and_ties(spark, tmp_path):
    from ipscope.sources.snapshots import newest_per_prefix, read_newest
    from pyspark.sql.types import StructType
    for name, t in (("a/one.json", 1000), ("a/two.json", 2000), ("b/x.json", 3000), ("b/w.json", 3000), ("c/part/1.json", 10), ("c/part/2.json", 5000),
                    ("c/other/1.json", 4000), ("c/skip.txt", 9000), ("top.json", 9000)):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(json.dumps({"n": name}))
        os.utime(p, (t, t))
    got = {r.prefix: os.path.relpath(r.path.removeprefix("file:"), tmp_path) for r in newest_per_prefix(spark, str(tmp_path), ".json").collect()}
    assert got == {"a": "a/two.json", "b": "b/w.json", "c": "c/part/2.json"}  # of equally new files the first listed
    schema = StructType.fromDDL("n string")
    rows = read_newest(spark, str(tmp_path), schema, ".json", unit="folder").collect()
    assert sorted((r.prefix, r.n) for r in rows if r.prefix == "c") == [("c", "c/part/1.json"), ("c", "c/part/2.json")]
    assert all(r.source_file.endswith(r.n) and r.source_modified for r in rows)
    (tmp_path / "none").mkdir()
    assert read_newest(spark, str(tmp_path / "none"), schema).collect() == []


def test_answers_are_dealt_before_they_are_sorted(spark):
    """One split of many tries, most of one IP, is reduced in several tasks; the answers are the same."""
    from ipscope.sources.responses import answers

    rows = [(f"10.0.0.{i % 7 if i % 3 == 0 else 9}", "passive_dns", 200 if i % 5 == 0 else 429, '{"passive_dns": [{}, {}]}', f"2024-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}Z")
            for i in range(3000)]
    one = spark.createDataFrame(rows, "ip string, kind string, http_status int, body string, landed_at string").coalesce(1)
    found = answers(one, "passive_dns")
    assert {r.ip: (r.passive_dns.http_status, r.passive_dns.value.n) for r in found.collect()} == {f"10.0.0.{i}": (200, 2) for i in [*range(7), 9]}
    plan = found._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    assert plan.index("SortAggregate") < plan.index("REBALANCE_PARTITIONS_BY_COL")
