"""The store keeps every batch once, whatever happens around it."""
import pytest
from pyspark.sql import functions as F

from ipscope import schemas as S
from ipscope.sinks.store import ProfileStore, publish_json, write_snapshot

RUN, LATER = "2024-05-05T00:00:00Z", "2024-06-06T00:00:00Z"


def batch(spark, ips, **values):
    rows = spark.createDataFrame([(ip,) for ip in ips], "ip_address string")
    cols = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in S.PROFILE.fields if f.name != "ip_address"]
    return rows.select("ip_address", *cols)


def ips(store):
    return sorted(r[0] for r in store.profiles().select("ip_address").collect())


def test_writers_number_their_batches_on_their_own(spark, tmp_path):
    one, two = (ProfileStore(spark, str(tmp_path / name)) for name in ("a", "b"))
    assert ips(one) == []
    one.merge(batch(spark, ["1.1.1.1"]), 1, RUN, writer="stream:/x=1/y z")
    one.merge(batch(spark, ["2.2.2.2"]), 1, RUN, writer="lookup")
    two.merge(batch(spark, ["9.9.9.9"]), 1, RUN)
    assert ips(one) == ["1.1.1.1", "2.2.2.2"] and ips(two) == ["9.9.9.9"]


@pytest.mark.parametrize("policy", ["table", "document"])
def test_a_batch_merged_again_takes_its_own_place(spark, tmp_path, policy):
    store = ProfileStore(spark, str(tmp_path / "s"), policy)
    for n, city in enumerate(("Oslo", "Lima", "Rome")):
        store.merge(batch(spark, ["1.1.1.1", f"2.2.2.{n}"], geo_city=city), n, RUN)
    before = sorted(map(tuple, store.profiles().collect()))
    store.merge(batch(spark, ["1.1.1.1", "2.2.2.1"], geo_city="Lima"), 1, RUN)
    assert sorted(map(tuple, store.profiles().collect())) == before
    store.merge(batch(spark, ["2.2.2.1"], geo_city="Bonn"), 1, RUN)  # a batch that was wrong is replaced whole
    assert {r.ip_address: r.geo_city for r in store.profiles().collect()} == {
        "1.1.1.1": "Rome", "2.2.2.0": "Oslo", "2.2.2.1": "Bonn", "2.2.2.2": "Rome"}


@pytest.mark.parametrize("policy", ["table", "document"])
def test_a_compacted_store_goes_on(spark, tmp_path, policy):
    store = ProfileStore(spark, str(tmp_path / "s"), policy)
    store.merge(batch(spark, ["1.1.1.1"], geo_city="Oslo", first_seen_at=RUN), 10, RUN)
    store.merge(batch(spark, ["1.1.1.1", "2.2.2.2"], geo_city="Lima", first_seen_at=LATER), 11, LATER)
    small = store.compact_to(str(tmp_path / "t"))
    assert sorted(map(tuple, small.profiles().collect())) == sorted(map(tuple, store.profiles().collect()))
    for s in (store, small):
        s.merge(batch(spark, ["1.1.1.1"], geo_asn_number="AS1"), 12, LATER)
    assert sorted(map(tuple, small.profiles().collect())) == sorted(map(tuple, store.profiles().collect()))


def test_rows_for_few_and_many_keys(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "s"))
    store.merge(batch(spark, [f"1.1.{k // 50}.{k % 50}" for k in range(200)]), 0, RUN)
    for n in (0, 3, 60):
        keys = [f"1.1.{k // 50}.{k % 50}" for k in range(n)]
        frame = spark.createDataFrame([(k,) for k in keys + keys[:1] + ["8.8.8.8", None]], "ip_address string")
        assert sorted(r.ip_address for r in store.rows_for(frame).collect()) == sorted(keys)


def _rows_out_of_scans(df):
    """Rows that the scans of an executed plan handed on."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []
    def visit(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(p.executedPlan())
        if name.startswith("Scan"):
            out.append(p.metrics().apply("numOutputRows").value())
        for child in ([p.plan()] if "QueryStage" in name else [p.children().apply(i) for i in range(p.children().size())]):
            visit(child)
    visit(plan)
    return sum(out)


def test_bloom_filters_keep_files_unread_for_few_keys(spark, tmp_path):
    """Batches span the whole range of IPs, so only the Bloom filters tell them apart."""
    store = ProfileStore(spark, str(tmp_path / "s"))
    for n in range(4):
        store.merge(batch(spark, [f"10.{k % 7}.{k // 7}.{4 * (k % 60) + n}" for k in range(400)]).coalesce(1), n, RUN)
    keys = spark.createDataFrame([("10.3.0.13",), ("10.5.1.49",)], "ip_address string")  # both of batch 1
    assert sorted(r.ip_address for r in store.rows_for(keys).collect()) == ["10.3.0.13", "10.5.1.49"]
    assert _rows_out_of_scans(store.rows_for(keys)) <= 400 < 1600 == _rows_out_of_scans(store.profiles())


def test_each_write_says_whether_it_keeps_the_stored_time(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "s"))
    store.merge(batch(spark, ["1.1.1.1"], enriched_at=RUN), 0, RUN)
    store.merge(batch(spark, ["1.1.1.1"]), 0, LATER, writer="lookup", keep_old_enriched_at=True)
    assert store.profiles().first().enriched_at is not None
    store.merge(batch(spark, ["1.1.1.1"]), 1, LATER)
    assert store.profiles().first().enriched_at is None


def test_counters_come_with_the_write_and_an_empty_required_snapshot_raises(spark, tmp_path):
    rows = spark.createDataFrame([("1.1.1.1", "a"), ("2.2.2.2", "b")], "ip_address string, _flag string")
    got = write_snapshot(rows, str(tmp_path / "p"), RUN, counters={"a_count": F.count_if(F.col("_flag") == "a")}, drop=("_flag",))
    assert got == {"record_count": 2, "a_count": 1}
    assert "_flag" not in spark.read.parquet(str(tmp_path / "p")).columns
    assert write_snapshot(rows.limit(0), str(tmp_path / "p"), LATER)["record_count"] == 0
    for nothing in (rows.limit(0), rows.filter("ip_address = 'x'")):
        with pytest.raises(ValueError):
            write_snapshot(nothing, str(tmp_path / "p"), LATER, required=True)


def test_running_a_snapshot_or_a_publication_again_gives_each_row_once(spark, tmp_path):
    rows = spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",)], "ip_address string")
    for _ in range(2):
        write_snapshot(rows, str(tmp_path / "p"), RUN)
        publish_json(rows, "text", str(tmp_path / "q"), run_id="20240505")
    write_snapshot(rows, str(tmp_path / "p"), LATER)
    publish_json(rows, "text", str(tmp_path / "q"), run_id="20240606")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4
    assert spark.read.text(str(tmp_path / "q")).count() == 4


def test_a_daily_run_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    import json

    from ipscope.plans import jobs

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text(json.dumps({"data": [
        {"ipAddress": "1.1.1.1", "countryCode": "NO", "abuseConfidenceScore": 90, "lastReportedAt": "2024-05-01T00:00:00Z"}]}))
    args = (spark, str(tmp_path / "raw"), str(tmp_path / "done"), str(tmp_path / "state"), str(tmp_path / "out"), RUN)

    def stop(self, *a):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(jobs.SnapshotGate, "commit", stop)
        with pytest.raises(RuntimeError):
            jobs.run_daily(*args)
    assert jobs.run_daily(*args)["changed"]
    assert jobs.latest_processed(spark, str(tmp_path / "done")).count() == 1
    assert spark.read.text(str(tmp_path / "out")).count() == 1


def test_a_retried_call_keeps_its_good_answer_and_an_ip_has_one_profile(spark):
    from ipscope.operators.lookup import lookup
    from ipscope.sources.responses import parse_pulses

    good = '{"reputation": 1, "pulse_info": {"pulses": [{"name": "ssh"}]}}'
    geo = '{"ip": "1.1.1.1", "location": {"city": "%s"}}'
    answers = spark.createDataFrame([
        ("1.1.1.1", "pulse_general", 429, None, "1"), ("1.1.1.1", "pulse_general", 200, good, "2"),
        ("1.1.1.1", "pulse_general", 429, None, "3"), ("1.1.1.1", "geo", 200, geo % "Oslo", "1"),
        ("1.1.1.1", "geo", 200, geo % "Lima", "2")], "ip string, kind string, http_status int, body string, landed_at string")
    r = parse_pulses(answers, RUN).first()
    assert (r.general_status, r.pulse_count) == ("ok", "1")
    store = spark.createDataFrame([], S.PROFILE)
    profiles, _ = lookup(spark.createDataFrame([("1.1.1.1",), (" 1.1.1.1\t",)], "ip string"), store, answers, RUN)
    assert [(p.ip_address, p.geo_city, p.otx_pulse_count) for p in profiles.collect()] == [("1.1.1.1", "Lima", 1)]
