"""Commands that need no Spark: fetching feeds into landing folders, checking samples, printing the model.

    python -m sentrylake.cli cves --out DIR [--start T] [--end T] [--hours N] [--api-key KEY]
    python -m sentrylake.cli kev --out DIR
    python -m sentrylake.cli check-samples DIR
    python -m sentrylake.cli model
"""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from .functions.clock import utc_now
from .plans import model
from .plans.params import new_batch_id
from .sources import acquire, landing, samples


def fetch_cves(args: argparse.Namespace, fetch=acquire.get_json, sleep=None) -> dict:
    """Fetches a window's pages and writes the manifest that a load reads; returns the manifest's fields."""
    now, batch = utc_now(), new_batch_id()
    load_type, start, end = landing.resolve_window(args.start, args.end, args.hours, now)
    folder = Path(args.out) / batch
    more = {} if sleep is None else {"sleep": sleep}
    got = acquire.fetch_pages(start, end, folder, args.api_key, fetch, **more)
    fields = {"source": "nvd", "load_type": load_type, "batch_id": batch, "window_start": start, "window_end": end, "fetched_at": now, "source_uri": acquire.CVE_SERVICE, "records": got.records, "pages": got.pages, "requests": got.requests, "total_results": got.total_results}
    landing.write_manifest(folder, **fields)
    return fields


def fetch_kev(args: argparse.Namespace, fetch=acquire.get_json) -> dict:
    batch = new_batch_id()
    folder = Path(args.out) / batch
    _, head = acquire.fetch_catalog(folder, fetch)
    fields = {"source": "cisa_kev", "load_type": "FULL", "batch_id": batch, "fetched_at": utc_now(), "source_uri": acquire.KEV_SERVICE, **head}
    landing.write_manifest(folder, **fields)
    return fields


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sentrylake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    cves = sub.add_parser("cves")
    cves.add_argument("--out", required=True)
    for name in ("--start", "--end"):
        cves.add_argument(name)
    cves.add_argument("--hours", type=float)
    cves.add_argument("--api-key", default=os.environ.get("NVD_API_KEY"))
    sub.add_parser("kev").add_argument("--out", required=True)
    sub.add_parser("check-samples").add_argument("folder")
    sub.add_parser("model")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "model":
        print(model.dictionary())
        return 0
    if args.command == "check-samples":
        found = samples.problems(args.folder)
        print("\n".join(found) or "all samples are as listed")
        return int(bool(found))
    print(json.dumps({"cves": fetch_cves, "kev": fetch_kev}[args.command](args), default=str, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
