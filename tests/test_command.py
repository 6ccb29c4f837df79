"""The command line on stored tables."""

import csv
import os

from tests.conftest import SMALL
from tidemark import __main__ as command
from tidemark.plans.binding import Bank
from tidemark.plans.stored import NAMES


def test_extracts_and_broken_checks(spark, tmp_path, capsys):
    bank = Bank(spark, SMALL)
    tables = bank.tables()
    for name in NAMES:
        tables[name].write.parquet(f"{tmp_path}/tables/{name}")
    out = tmp_path / "extracts"
    command.main(["--tables", f"{tmp_path}/tables", "--extracts", str(out), "--format", "parquet"])
    assert "launch" in capsys.readouterr().out
    names = sorted(os.listdir(out))
    assert "broken_checks.csv" in names and len(names) == 8
    parts = [f"{out}/broken_checks.csv"]
    if os.path.isdir(parts[0]):
        parts = [f"{parts[0]}/{f}" for f in os.listdir(parts[0]) if f.endswith(".csv")]
    found = [row for part in parts for row in csv.DictReader(open(part))]
    # market segments are no declared channels
    assert ("domain:acquisition_channel", "customers") in {(r["check_name"], r["table_name"]) for r in found}
    assert all(int(r["violations"]) > 0 and r["passed"] == "false" for r in found)
