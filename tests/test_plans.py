"""Plan shape: no Python evaluation nodes, pushdown reaches the scan, fingerprint laws."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from ipscope import standin
from ipscope.operators import changes
from ipscope.plans import catalog

from sf_dirs import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_plan(spark):
    for name, fn in catalog.queries().items():
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_prunes_columns(spark):
    p = _plan(E.queries()["document_keywords"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_fingerprint_order_independent_and_sensitive(spark):
    s = standin.view(spark, SF_SMALL, "v_curr").select(*changes.STATE_COLUMNS)
    a = changes.fingerprint(s).first()
    b = changes.fingerprint(s.repartition(7).orderBy(F.rand(3))).first()
    assert a == b
    one_changed = s.withColumn("abuse_confidence_score",
                               F.when(F.col("ip_address") == s.first().ip_address, F.lit(-1))
                               .otherwise(F.col("abuse_confidence_score")))
    assert changes.fingerprint(one_changed).first().fingerprint != a.fingerprint
    dup = s.unionByName(s.limit(1))
    assert changes.fingerprint(dup).first().fingerprint != a.fingerprint


def test_diff_classes_disjoint_and_complete(spark):
    prev = standin.view(spark, SF_SMALL, "v_prev").select("pos", *changes.STATE_COLUMNS)
    curr = standin.view(spark, SF_SMALL, "v_curr").select("pos", *changes.STATE_COLUMNS)
    d = changes.diff_snapshots(prev, curr)
    keys = prev.select("ip_address").union(curr.select("ip_address")).distinct().count()
    assert d.count() == keys == d.select("ip_address").distinct().count()


def _exchanges(df):
    return _plan(df).count("Exchange hashpartitioning")


def test_merge_adds_no_shuffle_to_its_inputs(spark):
    """The full outer merge reuses the ip partitioning both inputs already have."""
    from ipscope.operators.merge import merge_profiles
    e, i = catalog.merge_inputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for policy in ("table", "document"):
            m = merge_profiles(e, i, policy, run_ts=standin.RUN_TS)
            assert _exchanges(m) == _exchanges(e) + _exchanges(i), policy
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


def test_enrichment_shuffles_reports_once(spark):
    """Without broadcasts: reports, pulses and geo are each shuffled once by ip."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(catalog.profiles(spark, SF_SMALL))
        assert p.count("Exchange hashpartitioning(ip_address") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


def test_word_boundary_option(spark):
    from ipscope.functions.scoring import classify
    df = spark.createDataFrame([(["SSH Brute Force"],)], "n array<string>")
    c, w = classify("n", word_boundary=True)
    r = df.select(c.alias("c"), w.alias("w")).first()
    assert list(r.w) == ["brute force", "ssh"] and list(r.c) == ["Brute Force"]


def test_store_point_lookup_reaches_the_scan(spark, tmp_path):
    from ipscope.sinks.store import ProfileStore
    e = catalog.stored_profiles(spark, SF_SMALL)
    store = ProfileStore(spark, str(tmp_path / "s"))
    store.merge(e, 0, catalog.PREV_RUN_TS)
    ip = e.select("ip_address").orderBy("ip_address").first()[0]
    assert f"EqualTo(ip_address,{ip})" in _plan(store.point(ip))
    got = store.point(ip).collect()
    assert len(got) == 1 and got[0].ip_address == ip
    few = store.rows_for(e.select("ip_address").limit(2))
    assert "PushedFilters: [In(ip_address" in _plan(few) and few.count() == 2


def test_a_diff_reads_only_the_buckets_that_changed(spark, tmp_path):
    from ipscope.sinks.state import SnapshotGate
    rows = spark.range(500).select(F.format_string("10.0.%d.%d", (F.col("id") / 250).cast("int"), F.col("id") % 250).alias("ip_address"),
                                   F.lit(5).alias("abuse_confidence_score"), F.lit("t").alias("last_reported_at"), F.lit("DE").alias("country_code"))
    gate = SnapshotGate(spark, str(tmp_path / "s"), buckets=40)
    assert gate.diff(rows).count() == 500 and gate.commit(rows, "a", "t") == 1
    assert not gate.detect(rows).first().changed and gate.diff(rows).count() == 0
    one = rows.withColumn("country_code", F.when(F.col("ip_address") == "10.0.1.7", "FR").otherwise(F.col("country_code")))
    again = SnapshotGate(spark, str(tmp_path / "s"), buckets=7)  # the commit's bucket count holds
    d = again.diff(one)
    assert [(r.ip_address, r.change) for r in d.collect()] == [("10.0.1.7", "changed")]
    bucket = rows.filter("ip_address = '10.0.1.7'").select(changes.bucket_of("ip_address", 40)).first()[0]
    assert f"PartitionFilters: [isnotnull(bucket" in _plan(d) and f"= {bucket})]" in _plan(d)
    full = changes.diff_snapshots(again.committed_records(), one).filter("change <> 'same'")
    assert sorted(full.collect()) == sorted(d.collect())
    assert again.commit(one.limit(0), "b", "u") == 2 and again.committed_records().count() == 0
    assert again.diff(one).filter("change = 'new'").count() == 500


def test_two_commits_at_once_do_not_mix(spark, tmp_path, monkeypatch):
    from ipscope.sinks.state import SnapshotGate
    rows = lambda ip: spark.createDataFrame([(ip, 1, "t", "DE")], "ip_address string, abuse_confidence_score int, last_reported_at string, country_code string")
    one, two = SnapshotGate(spark, str(tmp_path / "s")), SnapshotGate(spark, str(tmp_path / "s"))
    monkeypatch.setattr(two, "latest", lambda: None)  # has not seen the first
    assert one.commit(rows("1.1.1.1"), "a", "t") == two.commit(rows("2.2.2.2"), "b", "t") == 1
    got = one.committed_records().collect()
    assert len(got) == 1 and one.latest().source_object_name == {"1.1.1.1": "a", "2.2.2.2": "b"}[got[0].ip_address]


def test_ordered_files_do_not_overlap(spark, tmp_path):
    from ipscope.sinks import ordered
    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"))
    ordered.write_ordered(rows, str(tmp_path / "o"), "k", 5)
    ranges = sorted((r.least, r.greatest, r.rows) for r in ordered.file_ranges(spark, str(tmp_path / "o"), "k").collect())
    assert len(ranges) == 5 and sum(r[2] for r in ranges) == 3000
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    ordered.write_ordered(rows.limit(0), str(tmp_path / "e"), "k", 5)
    assert ordered.positions(spark, str(tmp_path / "e"), "k").count() == 0
