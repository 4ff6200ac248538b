import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import checks, ingest
from sedimenta.operators import store
from sedimenta.operators.store import SCHEMAS, Conflict, Store, fingerprint, new_numbered, numbered, only_new

S = "19970203040506"
NOW = datetime.datetime(2024, 1, 1)


def evidence(spark, rows):
    """rows of (id, domain, source_id, year, type, value, method)."""
    return spark.createDataFrame([(i, d, s, y, t, v, None, m, None, NOW, "f", "line 1") for i, d, s, y, t, v, m in rows], SCHEMAS["evidence"])


CLEAN = [
    (1, "a.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} a.com", "ia_cdx_year_query"),
    (2, "a.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} www.a.com", "ia_cdx_year_query"),
    (3, "b.com", 2, 1998, "link_target", "host_link_graph:1998", "ukwa_host_link_graph"),
]


def clean(spark):
    def df(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])

    return {
        "source": df("source", [(1, "captures", "timestamped", None), (2, "links", "candidate_only", None)]),
        "domain": df("domain", [("a.com", "com", 1, 1, NOW), ("b.com", "com", 2, 1, NOW)]),
        "evidence": evidence(spark, CLEAN),
        "domain_year": df("domain_year", [("a.com", 1997, 1, NOW)]),
        "hostname_year": df("hostname_year", [("www.a.com", "a.com", 1997, 2, NOW)]),
        "domain_language": df("domain_language", []),
        "shipped": spark.createDataFrame([("a.com", 1997), ("www.a.com", 1997)], "name string, year int"),
        "shipped_domains": spark.createDataFrame([("a.com", 1997)], "name string, year int"),
        "held": spark.createDataFrame([("z.com", 1997)], "name string, year int"),
        "web_source": spark.createDataFrame([("captures", True)], "name string, any_method boolean"),
        "error_capture": spark.createDataFrame([("captures", "ia_cdx_year_query", S, "other.com")], "source string, method string, ts string, hostname string"),
        "first_own_id": spark.createDataFrame([(1,)], "evidence_id long"),
    }


def test_clean_store_passes(spark):
    t = clean(spark)
    got = {r["name"]: r["offending"] for r in checks.report(t).collect()}
    assert len(got) == 23 and not any(got.values()), got
    assert checks.skipped({"domain": t["domain"]}) and "registered_domain_format" not in checks.skipped({"domain": t["domain"]})


def planted(spark):
    t = clean(spark)

    def ev(*row):
        return {"evidence": t["evidence"].union(evidence(spark, [row]))}

    def add(name, *row):
        return {name: t[name].union(spark.createDataFrame([row], t[name].schema))}

    return {
        "evidence_wall_intact": add("domain_year", "b.com", 1998, 1, NOW),
        "no_candidate_leakage": add("domain_year", "b.com", 1998, 3, NOW),
        "every_pair_has_master_evidence": add("domain_year", "b.com", 1999, 3, NOW),
        "within_year_unique": add("domain_year", "a.com", 1997, 1, NOW),
        "assigned_year_in_window": add("domain_year", "a.com", 2003, 1, NOW),
        "registered_domain_format": add("domain", "A_.com.", "com", 1, 1, NOW),
        "no_idn_tld_in_window": add("domain_year", "a.xn--p1ai", 1997, 1, NOW),
        "evidence_year_matches_its_value": ev(9, "a.com", 1, 1998, "cdx_timestamp", f"cdx capture {S} a.com", "x"),
        "additions_not_double_counted": add("held", "a.com", 1997),
        "no_arpa_in_the_shipped_files": add("shipped", "1.in-addr.arpa", 1997),
        "no_tld_predates_its_own_delegation": add("shipped", "a.info", 1999),
        "no_tld_that_never_existed_in_the_window": add("shipped", "a.sucks", 1999),
        "hostname_wall_intact": add("hostname_year", "x.b.com", "b.com", 1998, 1, NOW),
        "hostname_is_below_its_parent": add("hostname_year", "a.com", "a.com", 1997, 2, NOW),
        "hostname_observed_serving_web": {"web_source": t["web_source"].where("false")},
        "a_host_record_has_its_own_evidence": add("hostname_year", "w2.a.com", "a.com", 1997, 2, NOW),
        "a_registrable_record_has_its_own_capture": add("shipped_domains", "b.com", 1998),
        "nothing_earned_is_left_unassigned": ev(9, "a.com", 1, 1999, "artifact_listing", "listed 1999", "x"),
        "no_master_record_points_to_an_error_capture": add("error_capture", "captures", "ia_cdx_year_query", S, "a.com"),
        "evidence_id_unique": ev(*CLEAN[0]),
        "domain_wall_intact": ev(9, "z.com", 1, 1997, "link_target", "x 1997", "x"),
        "source_wall_intact": ev(9, "a.com", 7, 1997, "link_target", "x 1997", "x"),
        "new_rows_have_location": {"evidence": t["evidence"].withColumn("record_location", F.when(F.col("evidence_id") == 1, None).otherwise(F.col("record_location")))},
    }


def test_every_planted_defect_is_found(spark):
    t, cases = clean(spark), planted(spark)
    assert set(cases) == set(checks.CHECKS)
    out = None
    for name, change in cases.items():
        one = checks.CHECKS[name][1](t | change).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.union(one)
    assert all(r["n"] >= 1 for r in out.collect()), out.collect()


def test_assignment_ranks(spark):
    rows = [
        *CLEAN,
        (4, "c.com", 1, 1999, "artifact_listing", "listed 1999", "unheard"),
        (5, "c.com", 1, 1999, "cdx_timestamp", "cdx capture 19990203040506 c.com", "ia_cdx_year_query"),
        (6, "c.com", 1, 1999, "cdx_timestamp", "cdx capture 19990203040506 status 404 w.c.com", "ia_cdx_year_query"),
        (7, "c.com", 1, 1999, "cdx_timestamp", "cdx capture 19990203040507 w.c.com", "ia_cdx_year_query"),
    ]
    for order in (rows, rows[::-1]):
        e = evidence(spark, order)
        assert sorted(map(tuple, ingest.assign_years(e).collect())) == [("a.com", 1997, 1), ("c.com", 1999, 5)]
        assert sorted(map(tuple, ingest.assign_hosts(e).collect())) == [("w.c.com", "c.com", 1999, 7), ("www.a.com", "a.com", 1997, 2)]


def test_class_skip(spark):
    held = evidence(spark, [(1, "a.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} status 404 a.com", "ia_cdx_year_query"), (2, "b.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} b.com", "ia_cdx_year_query")])
    new = evidence(
        spark,
        [
            (11, "a.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} a.com", "ia_cdx_year_query"),
            (12, "a.com", 1, 1997, "cdx_timestamp", f"cdx capture {S} status 500 a.com", "ia_cdx_year_query"),
            (13, "b.com", 1, 1997, "cdx_timestamp", f"cdx capture {S}7 b.com", "ia_cdx_year_query"),
            (14, "b.com", 1, 1998, "cdx_timestamp", "cdx capture 19980203040506 b.com", None),
        ],
    )
    assert sorted(r["evidence_id"] for r in ingest.class_skip(new, held).collect()) == [11, 14]


def test_marks(spark):
    e = ingest.mark(evidence(spark, CLEAN), spark.createDataFrame([(1,), (1,)], "evidence_id long"), "replay failed")
    got = {r["evidence_id"]: r["evidence_value"] for r in e.collect()}
    assert got[1] == f"cdx capture {S} replay failed a.com" and got[2] == CLEAN[1][5]
    assert {r["domain"] for r in ingest.assign_years(e).collect()} == {"a.com"}


def test_store(spark, tmp_path):
    st = Store(spark, f"file://{tmp_path}")
    assert st.table("evidence").count() == 0
    assert st.source_id("captures", "timestamped") == st.source_id("captures", "timestamped") == 1
    assert st.source_id("links", "candidate_only") == 2
    with pytest.raises(ValueError, match="is timestamped"):
        st.source_id("captures", "candidate_only")
    t = clean(spark)
    st.commit(append={n: t[n] for n in ("domain", "evidence", "domain_year", "hostname_year")})
    more = only_new(evidence(spark, [*CLEAN, (8, "d.com", 1, 1999, "link_target", "v", "m"), (8, "d.com", 1, 1999, "link_target", "v", "m")]), st.table("evidence"), ["evidence_id"])
    st.commit(append={"evidence": more})
    assert st.table("evidence").count() == 4
    a, b = fingerprint(st.table("evidence").orderBy("evidence_id")).first(), fingerprint(st.table("evidence").orderBy(F.desc("evidence_id"))).first()
    assert a == b and a["n"] == 4
    st.drop_source(1)
    assert [r["domain"] for r in st.table("evidence").collect()] == ["b.com"]
    assert st.table("domain_year").count() == st.table("hostname_year").count() == 0
    assert [r["domain"] for r in st.table("domain").collect()] == ["b.com"]
    st.record("ingest", "captures", F.struct(F.lit(3).alias("rows")))
    assert st.table("run_metrics").first()["metrics_json"] == '{"rows":3}'
    ids = numbered(evidence(spark, CLEAN).drop("evidence_id"), ["domain", "evidence_value"])
    assert ids.select("evidence_id").distinct().count() == 3


def test_of_two_writers_one_gets_through(spark, tmp_path):
    st = Store(spark, f"file://{tmp_path}")
    t = clean(spark)
    st.commit(append={"domain": t["domain"]})
    at = st.version()[0]
    st.commit(append={"evidence": t["evidence"]})  # another writer
    with pytest.raises(Conflict):
        st.commit(append={"domain": t["domain"]}, since=at)
    st.commit(append={"domain": t["domain"].where("domain = 'a.com'")})  # appends alone come after one another
    assert st.table("domain").count() == 3 and st.table("evidence").count() == 3 and st.version()[0] == 3


def test_equal_ids_of_unequal_rows_lose_no_row(spark, monkeypatch):
    key = ["domain", "evidence_value"]
    whole = store.numbered

    def narrow(rows, key, salt=0):  # all ids equal until they are salted
        return whole(rows, key, salt) if salt else rows.withColumn("evidence_id", F.lit(1).cast("long"))

    monkeypatch.setattr(store, "numbered", narrow)
    rows = evidence(spark, CLEAN).drop("evidence_id")
    got = new_numbered(rows.union(rows), evidence(spark, CLEAN[:1]), key)
    assert got.count() == got.select("evidence_id").distinct().count() == 2


def test_ledger(spark):
    led = spark.createDataFrame([("s", "a", "1", 5, NOW)], SCHEMAS["ingested_file"])
    new, changed = ingest.fresh_files(spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "9")], "file_name string, sha256 string"), led, "s")
    assert [tuple(r) for r in new.collect()] == [("b", "2")] and [tuple(r) for r in changed.collect()] == [("a", "9")]
    up = ingest.ledger_upsert(led, spark.createDataFrame([("s", "a", "9", 2, datetime.datetime(2025, 1, 1))], SCHEMAS["ingested_file"])).first()
    assert (up["sha256"], up["record_rows"]) == ("9", 7)


def test_ingest_by_spec(spark, tmp_path):
    from sedimenta.sources.specs import SPECS
    from sedimenta.streaming.ingest import ingest_files

    assert len(SPECS) == 76 and all(callable(s.parse) for s in SPECS.values())
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.cdx").write_text(f"k {S} http://www.a.com/ t 200 x\nk {S} http://b.sucks/ t 200 x\nk 20050203040506 http://c.com/ t 200 x\nk {S} http://d.co.uk/ t 404 x\n")
    st = Store(spark, f"file://{tmp_path}/store")
    counts = ingest_files(st, "early_web", f"{tmp_path}/in")
    assert counts == {"kept": 2, "out_of_window": 1, "non_200": 1}
    assert [r["domain"] for r in st.table("evidence").collect()] == ["a.com"] and st.table("domain").count() == 1
    assert '"no known suffix":1' in st.table("run_metrics").first()["metrics_json"]
    (tmp_path / "in/b.cdx").write_text(f"k {S} http://e.ru/ t 200 x\nk {S} http://www.a.com/ t 200 x\n")
    ingest_files(st, "early_web", f"{tmp_path}/in")
    assert sorted(r["domain"] for r in st.table("evidence").collect()) == ["a.com", "e.ru"] and st.table("ingested_file").count() == 2
    (tmp_path / "in/b.cdx").write_text("changed\n")
    with pytest.raises(ValueError, match="changed"):
        ingest_files(st, "early_web", f"{tmp_path}/in")
