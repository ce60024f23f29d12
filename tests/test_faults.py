import json
import os
import subprocess
import sys
from pathlib import Path

HOME = Path(__file__).resolve().parent.parent


def outcome(folder: Path, marked: bool) -> dict:
    marks = folder / "marks"
    marks.mkdir(parents=True)
    if not marked:
        for name in ("encoder-True", "encoder-False", "generator"):
            (marks / name).touch()
    # Two cores, and up to four attempts per task.
    env = os.environ | {"BENCH_CPUS": "2,4", "PYTHONPATH": str(HOME)}
    command = [sys.executable, "-m", "tests.lost_worker", str(folder)]
    subprocess.run(command, cwd=HOME, env=env, check=True, timeout=300, capture_output=True)
    return json.loads((folder / "out.json").read_text())


def test_workers_that_die_change_no_result(tmp_path):
    struck = outcome(tmp_path / "struck", marked=True)
    calm = outcome(tmp_path / "calm", marked=False)
    assert struck["deaths"] == ["encoder-False", "encoder-True", "generator"]
    assert struck["answers"] == calm["answers"] and len(calm["answers"]) == 40
    assert struck["positions"] == calm["positions"]
