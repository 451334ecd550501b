"""Profile store merge laws and the streaming job end to end (file source)."""
import json

from pyspark.sql import functions as F

from ipscope import standin
from ipscope.operators.enrich import enrich_and_score
from ipscope.plans import catalog
from ipscope.plans.render import render
from ipscope.operators.quarantine import judge_values, land, landed
from ipscope.sinks.store import ProfileStore
from ipscope.streaming.enrich_stream import parse_values, read_source, start_enrichment

from sf_dirs import SF_SMALL

RUN = standin.RUN_TS


def _sorted(df):
    return sorted(tuple(r) for r in render(df).collect())


def test_store_merge_replay_and_keys(spark, tmp_path):
    e, i = catalog.merge_inputs(spark, SF_SMALL)
    store = ProfileStore(spark, str(tmp_path / "store"), policy="table")
    store.merge(e, 0, catalog.PREV_RUN_TS)
    store.merge(i, 1, RUN)
    first = _sorted(store.profiles())
    store.merge(i, 1, RUN)  # a replayed batch changes nothing
    assert _sorted(store.profiles()) == first
    # key-unique and equal to the pure merge
    prof = store.profiles()
    assert prof.count() == prof.select("ip_address").distinct().count()
    from ipscope.operators.merge import merge_profiles
    assert first == _sorted(merge_profiles(e, i, "table"))


def test_table_policy_keeps_oldest_first_seen(spark):
    e, i = catalog.merge_inputs(spark, SF_SMALL)
    from ipscope.operators.merge import merge_profiles
    m = merge_profiles(e, i, "table").alias("m").join(e.alias("e"), "ip_address")
    bad = m.filter(F.col("m.first_seen_at") > F.col("e.first_seen_at")).count()
    assert bad == 0


def test_document_policy_keeps_geo_when_incoming_lacks_it(spark):
    e, i = catalog.merge_inputs(spark, SF_SMALL)
    from ipscope.operators.merge import merge_profiles
    m = merge_profiles(e, i, "document", run_ts=RUN).alias("m").join(e.alias("e"), "ip_address")
    lost = m.filter(F.col("e.geo_country_name").isNotNull() & F.col("m.geo_country_name").isNull()).count()
    assert lost == 0


def test_stream_equals_batch_and_dead_letters(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rep = standin.abuse_reports(spark, SF_SMALL).orderBy("pos").collect()
    half = len(rep) // 2
    for n, chunk in enumerate((rep[:half], rep[half:])):
        with open(src / f"part{n}.json", "w") as fh:
            for r in chunk:
                fh.write(json.dumps({"ip_address": r.ip_address, "country_code": r.country_code,
                                     "abuse_confidence_score": float(r.abuse_confidence_score),
                                     "last_reported_at": r.last_reported_at}) + "\n")
            fh.write("this is not json\n")
            fh.write(json.dumps({"country_code": "X"}) + "\n")
    pulses = standin.pulse_snapshot(spark, SF_SMALL)
    geo = standin.geo_snapshot(spark, SF_SMALL)
    store = ProfileStore(spark, str(tmp_path / "store"), policy="table")
    docs = ProfileStore(spark, str(tmp_path / "docs"), policy="document")
    q = start_enrichment(
        spark, read_source(spark, "text", str(src), {"maxFilesPerTrigger": "1"}), [store, docs],
        lambda: pulses, lambda: geo, str(tmp_path / "ckpt"), str(tmp_path / "dead"),
        trigger={"availableNow": True}, run_ts=RUN)
    q.awaitTermination(300)
    # two micro-batches merged under the table policy == batch enrichment of all reports
    batch = enrich_and_score(standin.abuse_reports(spark, SF_SMALL), pulses, geo, run_ts=RUN)
    got = store.profiles().select("ip_address", "risk_score", "abuse_confidence_score", "last_merged_at")
    exp = batch.select("ip_address", "risk_score", "abuse_confidence_score", "last_merged_at")
    assert _sorted(got) == _sorted(exp)
    # the document store saw the two micro-batches as two sequential merges
    from ipscope.operators.merge import merge_profiles
    cols = ["ip_address", "country_code", "abuse_confidence_score", "last_reported_at"]
    b0 = spark.createDataFrame([tuple(r[c] for c in cols) for r in rep[:half]], "ip_address string, "
                               "country_code string, abuse_confidence_score int, last_reported_at string")
    b1 = spark.createDataFrame([tuple(r[c] for c in cols) for r in rep[half:]], b0.schema)
    p0 = enrich_and_score(b0, pulses, geo, run_ts=RUN)
    p1 = enrich_and_score(b1, pulses, geo, run_ts=RUN)
    seq = merge_profiles(merge_profiles(spark.createDataFrame([], p0.schema), p0, "document", RUN),
                         p1, "document", RUN)
    assert _sorted(docs.profiles()) == _sorted(seq)
    dead = landed(spark, str(tmp_path / "dead"), "quarantine")
    # one bad line and one key-less record per file
    assert sorted(r.reason for r in dead.collect()) == ["not_json", "not_json", "null_key", "null_key"]
    assert {r.raw_value for r in dead.collect()} == {"this is not json", '{"country_code": "X"}'}
    # the last batch's commit is lost: it is replayed on restart, and nothing changes
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "ckpt" / name).unlink()
    q2 = start_enrichment(
        spark, read_source(spark, "text", str(src), {"maxFilesPerTrigger": "1"}), [store, docs], lambda: pulses, geo,
        str(tmp_path / "ckpt"), str(tmp_path / "dead"), trigger={"availableNow": True}, run_ts=RUN)
    q2.awaitTermination(300)
    assert _sorted(store.profiles().select("ip_address", "risk_score", "abuse_confidence_score",
                                           "last_merged_at")) == _sorted(exp)
    assert _sorted(docs.profiles()) == _sorted(seq)
    assert landed(spark, str(tmp_path / "dead"), "quarantine").count() == 4
    assert (tmp_path / "ckpt" / "commits" / "1").exists()


def test_a_pinned_snapshot_stays_and_a_function_is_asked_for_every_batch(spark, tmp_path):
    from ipscope.streaming.enrich_stream import make_batch_fn
    reports = standin.abuse_reports(spark, SF_SMALL).limit(20).select(F.to_json(F.struct("*")).alias("value"))
    pulses, geo, asked = standin.pulse_snapshot(spark, SF_SMALL), standin.geo_snapshot(spark, SF_SMALL), []
    store = ProfileStore(spark, str(tmp_path / "s"))
    fn = make_batch_fn([store], pulses, lambda: asked.append(1) or geo, str(tmp_path / "landing"), RUN)
    fn(reports, 0)
    fn(reports, 1)
    fn(reports.limit(0), 2)
    assert len(asked) == 2 and store.profiles().count() == len({r.ip_address for r in standin.abuse_reports(spark, SF_SMALL).limit(20).collect()})


def test_reason_codes(spark, tmp_path):
    good = '{"ip_address":" 1.2.3.4 ","abuse_confidence_score":100.0}'
    cases = {good: None, "garbage": "not_json", "": "not_json", "[1, 2]": "not_json", "7": "not_json", '"x"': "not_json",
             '{"ip_address":"1.1.1.1"': "not_json", "{}": "null_key", '{"ip_address":null}': "null_key", '{"ip_address":" \\t"}': "blank_key",
             '{"ip_address":"1.1.1.1","abuse_confidence_score":"many"}': "wrong_type",
             '{"ip_address":"1.1.1.1","abuse_confidence_score":{"a":1}}': "wrong_type",
             '{"ip_address":"1.1.1.1","abuse_confidence_score":null,"other":5}': None}
    df = spark.createDataFrame([(v, 1) for v in cases] + [(None, 1)], "value string, reason int")
    got = {r.raw_value: r for r in judge_values(df).collect()}
    assert {k: r.reason for k, r in got.items()} == cases | {None: "not_json"}
    assert got[good].ip_address == "1.2.3.4" and got[good].abuse_confidence_score == 100
    assert got['{"ip_address":"1.1.1.1"'].ip_address is None
    for _ in range(2):  # landed again, a batch replaces itself
        land(judge_values(df), str(tmp_path / "l"), 3)
    assert landed(spark, str(tmp_path / "l"), "good", 3).count() == 2
    assert landed(spark, str(tmp_path / "l"), "quarantine").count() == len(cases) - 1
    assert landed(spark, str(tmp_path / "l"), "good", 4).count() == 0


def test_parse_values_tolerates_float_score(spark):
    df = spark.createDataFrame([('{"ip_address":" 1.2.3.4 ","abuse_confidence_score":100.0}',),
                                ("garbage",)], "value string")
    rows = parse_values(df).collect()
    assert rows[0].ip_address == "1.2.3.4" and rows[0].abuse_confidence_score == 100
    assert rows[1].ip_address is None


def test_country_spike_stream_counts(spark, tmp_path):
    from ipscope.streaming.enrich_stream import country_spike_stream
    src = tmp_path / "spk"
    src.mkdir()
    rep = standin.abuse_reports(spark, SF_SMALL).orderBy("last_reported_at", "pos").collect()
    half = len(rep) // 2
    for n, chunk in enumerate((rep[:half], rep[half:])):
        with open(src / f"p{n}.json", "w") as fh:
            for r in chunk:
                fh.write(json.dumps({"ip_address": r.ip_address, "country_code": r.country_code,
                                     "last_reported_at": r.last_reported_at}) + "\n")
    parsed = parse_values(read_source(spark, "text", str(src), {"maxFilesPerTrigger": "1"}))
    q = (country_spike_stream(parsed).writeStream.outputMode("update").format("memory")
         .queryName("spikes_t").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.start, r.country_code): r.n for r in spark.sql(
        "SELECT window.start AS start, country_code, max(reports) AS n FROM spikes_t GROUP BY 1, 2").collect()}
    exp_df = (standin.view(spark, SF_SMALL, "v_abuse")
              .groupBy(F.window(F.col("reported_ts").cast("timestamp"), "1 hour").start.alias("start"),
                       "country_code").count())
    exp = {(r.start, r.country_code): r["count"] for r in exp_df.collect()}
    assert got == exp


def test_store_equals_merge_after_merge(spark, tmp_path):
    """Three batches folded from the store equal one merge after the other, before and after compaction."""
    from ipscope.operators.merge import merge_profiles
    e, i = catalog.merge_inputs(spark, SF_SMALL)
    third = i.filter(F.col("risk_score") >= 30).withColumn("geo_city", F.lit(""))
    for policy in ("table", "document"):
        store = ProfileStore(spark, str(tmp_path / policy), policy=policy)
        seq = spark.createDataFrame([], e.schema)
        for n, (b, ts) in enumerate([(e, catalog.PREV_RUN_TS), (i, RUN), (third, "2024-03-01T00:00:00Z")]):
            store.merge(b, n, ts)
            seq = merge_profiles(seq, b, policy, ts)
            if n == 1:
                store = store.compact_to(str(tmp_path / f"{policy}_compact"))
        assert _sorted(store.profiles()) == _sorted(seq), policy
