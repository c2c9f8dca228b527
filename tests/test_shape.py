from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentrylake import schemas as S
from sentrylake.operators import capture, dedup, quality, shape
from sentrylake.operators import upsert as U
from sentrylake.sources import feeds

AT = datetime(2026, 10, 1, tzinfo=UTC)


def record(id_="CVE-2024-0001", published="2024-01-10T12:00:00.000", modified="2026-09-01T00:00:00.000", **more):
    return {"id": id_, "published": published, "lastModified": modified} | more


def bronze(spark, *batches):
    out = None
    for batch, rows in batches:
        texts = spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in rows], "raw_json string")
        made = capture.bronze_cves(texts, source_uri="u", load_type="FULL", batch_id=batch, loaded=AT)
        out = made if out is None else out.unionByName(made)
    return shape.parsed(out)


def metric(kind, score, severity="LOW"):
    return {"type": kind, "cvssData": {"baseScore": score, "baseSeverity": severity, "vectorString": f"{kind}:{score}"}}


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_text_and_hash_are_verbatim(spark, tmp_path):
    entry = '{"id": "CVE-2024-0001",  "n": 1.0, "s": "\\u00e9"}'
    (tmp_path / "page.json").write_text('{"totalResults": 1, "vulnerabilities": [{"cve": ' + entry + "}]}")
    texts = feeds.cve_texts(feeds.cve_pages(spark, str(tmp_path / "page.json")))
    row = only(capture.bronze_cves(texts, source_uri=None, load_type="FULL", batch_id="b", loaded=AT))
    import hashlib

    assert row["raw_json"] == entry
    assert row["payload_sha256"] == hashlib.sha256(entry.encode()).hexdigest()


def test_files_without_json_and_empty_pages_give_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("no json at all")
    (tmp_path / "b.json").write_text('{"vulnerabilities": []}')
    assert feeds.cve_texts(feeds.cve_pages(spark, str(tmp_path))).count() == 0
    assert feeds.no_rows(spark, S.BRONZE_CVE).count() == 0


def test_catalog_header_goes_on_every_entry(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"catalogVersion": "2026.10.04", "dateReleased": "d", "vulnerabilities": [{"cveID": "CVE-2024-0001"}, {"cveID": "CVE-2024-0002"}]}))
    rows = capture.bronze_kev(feeds.kev_texts(feeds.kev_catalog(spark, str(tmp_path))), source_uri=None, load_type="FULL", batch_id="b", loaded=AT).collect()
    assert [(r["cve_id"], r["catalog_version"]) for r in rows] == [("CVE-2024-0001", "2026.10.04"), ("CVE-2024-0002", "2026.10.04")]


def test_primary_metric_of_the_newest_version_wins(spark):
    r = record(metrics={"cvssMetricV31": [metric("Secondary", 5.0), metric("Primary", 9.8, "critical")], "cvssMetricV30": [metric("Primary", 1.0)]})
    row = only(shape.shaped_cves(bronze(spark, ("b", [r])), AT))
    assert (row["cvss_v3_score"], row["cvss_v3_severity"], row["cvss_vector"]) == (9.8, "CRITICAL", "Primary:9.8")


def test_score_as_text_counts_in_the_chosen_entry(spark):
    r = record(metrics={"cvssMetricV31": [metric("Secondary", 5.0), metric("Primary", "7.5")]})
    assert only(shape.shaped_cves(bronze(spark, ("b", [r])), AT))["cvss_v3_score"] == 7.5
    r = record(metrics={"cvssMetricV30": [metric("Secondary", "n/a")]})
    assert only(shape.shaped_cves(bronze(spark, ("b", [r])), AT))["cvss_v3_score"] is None


def test_description_contact_and_drift(spark):
    r = record(descriptions=[{"lang": "es", "value": "x"}, {"lang": "en", "value": "y"}], sourceIdentifier="a@b", brandNewField=1)
    row = only(shape.shaped_cves(bronze(spark, ("b", [r])), AT))
    assert (row["description_en"], row["has_source_identifier"], row["unknown_keys"]) == ("y", True, ["brandNewField"])
    assert only(shape.drift(shape.shaped_cves(bronze(spark, ("b", [record(zz=1), record(aa=1)])), AT)))[0] == ["aa", "zz"]


def test_rejected_rows_have_their_first_reason(spark):
    rows = [record(None), record(" "), record("CVE-XYZ", published="bad"), record(published="bad", modified="bad"), record("CVE-2024-0002", modified="bad"), record("CVE-2024-0003")]
    valid, rejected = shape.silver_cves(bronze(spark, ("b", rows)), AT)
    assert [r["cve_id"] for r in valid.collect()] == ["CVE-2024-0003"]
    assert sorted(r["reason"] for r in rejected.collect()) == sorted(["missing_cve_id"] * 2 + ["invalid_cve_id_format", "unparseable_published", "unparseable_last_modified"])
    assert rejected.columns == S.QUARANTINE.names


def test_unknown_conditions_break_nothing(spark):
    rows = spark.createDataFrame([(None,)], "x int")
    assert quality.tagged(rows, [(F.col("x") > 1, "a"), (F.isnull("x"), "b")]).first()["reason"] == "b"


def test_newest_version_wins_however_often_bronze_repeats(spark):
    old, new = record(), record(modified="2030-01-01T00:00:00.000")
    b = bronze(spark, ("b1", [old]), ("b2", [new]), ("b3", [old]))
    assert only(shape.silver_cves(b, AT)[0])["batch_id"] == "b2"
    assert shape.silver_cves(b.unionByName(b), AT)[0].collect() == shape.silver_cves(b, AT)[0].collect()


def node(*matches):
    return [{"nodes": [{"cpeMatch": [{"criteria": c, "vulnerable": v} | more for c, v, more in matches]}]}]


def cpe(vendor="acme", product="widget", part="a", version="1"):
    return f"cpe:2.3:{part}:{vendor}:{product}:{version}:*:*:*:*:*:*:*"


def test_products_are_parsed_and_rejected_each_with_its_hash(spark):
    r = record(configurations=node((cpe(r"foo\:bar", "baz"), True, {}), (cpe("*"), True, {}), ("not-a-cpe", True, {}), (cpe(part="x"), True, {})))
    valid, rejected = shape.silver_products(bronze(spark, ("b", [r])), AT)
    row = only(valid)
    assert (row["vendor"], row["product"], row["version"]) == ("foo:bar", "baz", "1")
    bad = rejected.collect()
    assert {r["reason"] for r in bad} == {"invalid_cpe_criteria"} and len({r["payload_sha256"] for r in bad}) == 3


def test_vulnerable_entry_of_a_criterion_wins(spark):
    r = record(configurations=node((cpe(), False, {}), (cpe(), True, {"versionEndExcluding": "2"}), (cpe(), True, {"versionEndExcluding": "3"})))
    row = only(shape.silver_products(bronze(spark, ("b", [r])), AT)[0])
    assert row["vulnerable"] and row["version_end_excluding"] == "3"


def test_children_come_of_the_newest_version_even_if_it_is_rejected(spark):
    old = record(configurations=node((cpe("old"), True, {})))
    new = record(modified="2030-01-01T00:00:00.000", published="bad", configurations=node((cpe("new"), True, {})))
    b = bronze(spark, ("b1", [old]), ("b2", [new]))
    assert only(shape.silver_products(b, AT)[0])["vendor"] == "new"
    assert only(shape.silver_cves(b, AT)[0])["batch_id"] == "b1"


def test_weaknesses(spark):
    d = lambda lang, v: {"description": [{"lang": lang, "value": v}]}
    r = record(weaknesses=[d("en", "CWE-416"), d("en", "CWE-416"), d("es", "CWE-999"), d("en", "Use after free"), d("en", "NVD-CWE-noinfo")])
    valid, rejected = shape.silver_cwes(bronze(spark, ("b", [r, record("CVE-2024-0009"), record(None)])), AT)
    assert sorted(x["cwe_id"] for x in valid.collect()) == ["CWE-416", "NVD-CWE-noinfo"]
    assert only(rejected)["reason"] == "invalid_cwe_id"


def test_kev_dates_and_order(spark):
    texts = spark.createDataFrame([("2026.10.04", "d", json.dumps({"cveID": " CVE-2024-0001 ", "product": "p ", "dateAdded": "2024-01-25", "dueDate": "x"})), ("2026.10.05", "d", json.dumps({"cveID": "CVE-2024-0001", "product": "q", "dateAdded": "2024-01-26"})), ("1", "d", json.dumps({"cveID": "CVE-2024-0002", "dateAdded": "?"}))], "catalog_version string, date_released string, raw_json string")
    valid, rejected = shape.silver_kev(capture.bronze_kev(texts, source_uri=None, load_type="FULL", batch_id="b", loaded=AT), AT)
    row = only(valid)
    assert (row["product"], str(row["date_added"]), row["due_date"]) == ("q", "2024-01-26", None)
    assert only(rejected)["reason"] == "unparseable_date_added"


def test_filter_bounds_are_inclusive_and_reach_the_scan(spark, tmp_path):
    b = bronze(spark, ("b", [record()])).select(*S.BRONZE_CVE.names)
    assert shape.filter_bronze(b, from_date="2026-10-01", to_date="2026-10-01").count() == 1
    assert shape.filter_bronze(b, to_date="2026-09-30").count() == 0
    assert shape.filter_bronze(b, batch_id="other").count() == 0
    b.write.parquet(str(tmp_path / "t"))
    plan = shape.filter_bronze(spark.read.parquet(str(tmp_path / "t")), from_date="2026-10-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(load_timestamp" in plan


def test_latest_keeps_one_row_per_key(spark):
    rows = spark.createDataFrame([(1, 2, "a"), (1, None, "b"), (2, None, "c"), (1, 3, "d")], "k int, o int, v string")
    assert {r["k"]: r["v"] for r in dedup.latest(rows, "k", ["o", "v"]).collect()} == {1: "d", 2: "c"}


KEYS = st.one_of(st.none(), st.integers(0, 5))
SIDE = st.dictionaries(st.integers(0, 6), st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3))), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=SIDE, new=SIDE)
def test_upsert_laws(spark, old, new):
    schema = "k int, last_modified_at int, x int"
    frames = [spark.createDataFrame([(k, a, b) for k, (a, b) in side.items()], schema) for side in (old, new)]
    planned = U.plan(*frames, ["k"], U.newer)
    rows = {r["k"]: r for r in planned.collect()}
    assert set(rows) == set(old) | set(new)
    for k, r in rows.items():
        taken = k not in old or (k in new and new[k][0] > old[k][0])
        assert (r["last_modified_at"], r["x"]) == (new if taken else old)[k]
        assert r["_action"] == ("insert" if k not in old else "update" if taken else "keep")
    again = U.counts(U.plan(planned.drop("_action"), frames[1], ["k"], U.newer))
    assert again == {"inserted": 0, "updated": 0}


def test_null_keys_are_always_inserted_and_change_is_null_safe(spark):
    t = spark.createDataFrame([(None, 1), (1, None), (2, 5)], "k int, x int")
    s = spark.createDataFrame([(None, 1), (1, None), (2, 6)], "k int, x int")
    actions = sorted((r["k"] is None, r["_action"]) for r in U.plan(t, s, ["k"], U.changed(["k", "x"])).collect())
    assert actions == [(False, "keep"), (False, "update"), (True, "insert"), (True, "keep")]
    none = U.plan(t, s, ["k"], U.changed(["batch_id"], ("batch_id",)))
    assert none.where("_action = 'update'").count() == 0


@pytest.mark.parametrize("version, sha, taken", [("2026.10.05", "b", True), ("2026.10.03", "b", False), ("2026.10.05", "a", False)])
def test_catalog_condition(spark, version, sha, taken):
    schema = "cve_id string, payload_sha256 string, catalog_version string"
    t, s = spark.createDataFrame([("c", "a", "2026.10.04")], schema), spark.createDataFrame([("c", sha, version)], schema)
    assert (U.plan(t, s, ["cve_id"], U.newer_catalog).first()["_action"] == "update") == taken
