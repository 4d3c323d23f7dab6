"""The command line, run as a separate process (it owns and stops its session)."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args, timeout=300):
    out = subprocess.run([sys.executable, "-m", "stopflow", "--master", "local[2]", *args], cwd=REPO,
                         capture_output=True, text=True, timeout=timeout)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_clean_analyse_inspect_from_a_raw_folder(tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    rows = [{"number": f"{12 + i % 3}", "trainName": "A", "station": f"S{i % 4}", "station_name": f"N{i % 4}",
             "arrival": f"08:{i:02d}:00", "departure": f"08:{i + 1:02d}:00", "day": 1, "id": i} for i in range(40)]
    rows.append(dict(rows[0]))
    with open(os.path.join(raw, "schedules.json"), "w") as fh:
        json.dump(rows, fh, indent=1)
    st = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"code": f" S{i} ", "state": f"St{i}", "zone": "Z"}} for i in range(4)]}
    with open(os.path.join(raw, "stations.json"), "w") as fh:
        json.dump(st, fh, indent=1)
    out = os.path.join(tmp_dir, "out")
    stats = _run("clean", "--raw-dir", raw, "--out", out)
    assert stats == {"raw_rows": 41, "cleaned_rows": 40, "removed_missing": 0, "removed_duplicates": 1}
    summary = _run("analyse", "--out", out)
    assert (summary["cleaned_rows"], summary["distinct_stations"], summary["distinct_trains"]) == (40, 4, 3)
    ins = _run("inspect", os.path.join(raw, "schedules.json"), "--out", out)
    assert ins == {"profiled": ["schedules.json"], "skipped": []}
