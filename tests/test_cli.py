from __future__ import annotations

import json

from sentrylake import cli
from sentrylake.plans import reports
from sentrylake.sources import landing


def test_fetched_windows_have_a_manifest(tmp_path):
    args = cli.parser().parse_args(["cves", "--out", str(tmp_path), "--start", "2026-10-01", "--end", "2026-10-02"])
    fields = cli.fetch_cves(args, lambda url, key: {"totalResults": 1, "vulnerabilities": [{"cve": {"id": "CVE-2024-0001"}}]}, lambda s: None)
    known = landing.read_manifest(tmp_path / fields["batch_id"])
    assert (known["load_type"], known["records"], known["pages"], known["window_start"]) == ("BACKFILL", 1, 1, "2026-10-01T00:00:00+00:00")


def test_fetched_catalog(tmp_path):
    fields = cli.fetch_kev(cli.parser().parse_args(["kev", "--out", str(tmp_path)]), lambda url, key: {"catalogVersion": "v", "vulnerabilities": [1]})
    assert landing.read_manifest(tmp_path / fields["batch_id"])["catalog_version"] == "v"


def test_commands(tmp_path, capsys):
    assert cli.main(["model"]) == 0 and "# Gold model" in capsys.readouterr().out
    (tmp_path / "source_manifest.json").write_text(json.dumps([{"file": "gone.json"}]))
    assert cli.main(["check-samples", str(tmp_path)]) == 1 and "gone.json: missing" in capsys.readouterr().out


def test_operations(spark):
    log = spark.sql("SELECT * FROM VALUES ('a', 'SUCCESS', timestamp '2026-01-01'), ('a', 'FAILURE', timestamp '2026-01-02'), ('b', 'SUCCESS', timestamp '2026-01-03') AS t(batch_id, status, finished_at)")
    marks = spark.sql("SELECT timestamp '2026-01-05' AS watermark_ts")
    row = reports.operations(log, marks, spark.range(3)).first()
    assert (row["runs"], row["failed_runs"], row["last_finished"].day, row["last_watermark"].day, row["quarantined"]) == (2, 1, 3, 5, 3)
