"""Checks sample files against their manifest: presence, JSON form, SHA-256 and number of records."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path


def problems(folder: str | Path, manifest: str = "source_manifest.json") -> list[str]:
    """What is wrong with the samples that the manifest lists; empty if nothing is."""
    root, found = Path(folder), []
    listed = json.loads((root / manifest).read_text(encoding="utf-8"))
    for entry in listed["files"] if isinstance(listed, dict) else listed:
        path = root / Path(entry["file"]).name
        if not path.is_file():
            found.append(f"{path.name}: missing")
            continue
        data = path.read_bytes()
        if entry.get("sha256") and hashlib.sha256(data).hexdigest() != entry["sha256"]:
            found.append(f"{path.name}: sha256 differs")
        try:
            body = json.loads(data)
        except ValueError:
            found.append(f"{path.name}: not JSON")
            continue
        n = len(body.get("vulnerabilities") or [])
        if entry.get("records") not in (None, n):
            found.append(f"{path.name}: {n} records, {entry['records']} expected")
    return found
