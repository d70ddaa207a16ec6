"""Command line over the jobs (in-process)."""

import json
import os

from firelog.__main__ import main

LINE = ("2025-01-05T00:00:01Z fw: action=DROP reason=PORTSCAN SRC=10.0.0.1 DST=198.51.100.1 "
        "LEN=60 TTL=64 PROTO=TCP SPT=1 DPT=22")


def test_cli_ingest_page_lookup(spark, tmp_dir, capsys):
    os.makedirs(f"{tmp_dir}/logs")
    with open(f"{tmp_dir}/logs/a.log", "w") as f:
        f.write(LINE + "\n\nbad line\n")
    with open(f"{tmp_dir}/answers.json", "w") as f:
        f.write(json.dumps({"ip": "10.0.0.1", "status_code": 200, "body": '{"country":"US"}'}) + "\n")
    assert main(["--local", "2", "ingest", "--logs", f"{tmp_dir}/logs", "--store", f"{tmp_dir}/store",
                 "--answers", f"{tmp_dir}/answers.json", "--answers-format", "json",
                 "--geo-out", f"{tmp_dir}/geo", "--as-of", "2024-02-01 00:00:00"]) == 0
    counters = {d["metric"]: d["value"] for d in map(json.loads, capsys.readouterr().out.splitlines())}
    assert counters["lines_read"] == 3 and counters["inserted"] == 1 and counters["geo_completed"] == 1
    assert main(["--local", "2", "page", "--store", f"{tmp_dir}/store", "--limit", "x"]) == 0
    page = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert page == [{"timestamp": "2025-01-05T00:00:01Z", "source_ip": "10.0.0.1",
                     "destination_ip": "198.51.100.1", "protocol": "TCP", "action": "DROP"}]
    assert main(["--local", "2", "lookup", "--geo", f"{tmp_dir}/geo", "--ip", "10.9.9.9"]) == 1
    assert json.loads(capsys.readouterr().out) == {"error": "IP not found"}
