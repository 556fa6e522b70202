"""Logs read split by split equal logs read file by file, whatever the splits."""

import os
import random

import pytest

from conftest import rows
from govlake.sources import logs

COLS = ["RequestId", "Text", "Success", "absent"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Quoted line breaks, quotes and commas, blank lines, both line ends, differing headers, an empty and a header-only file."""
    rnd = random.Random(7)
    base = tmp_path_factory.mktemp("gw")
    words = ["plain", "two\nlines", 'a ""quoted"" word', "x,y", "", "a\n\nblank", "long " * 30, "é\n語,\n" * 3, '""', "\n"]
    for f, head in enumerate((["RequestId", "Text", "Success"], ["Success", "RequestId", "Text"], ["RequestId", "Text", "Success", "Extra"])):
        end = "\r\n" if f == 1 else "\n"
        lines = [",".join(head)]
        for k in range(60):
            value = {"RequestId": f"{f}-{k}", "Text": '"' + rnd.choice(words) + rnd.choice(words) + '"', "Success": rnd.choice(["Y", "N", ""]), "Extra": "e"}
            lines.append(",".join(value[c] for c in head))
            if k % 17 == 5:
                lines.append("")
        os.makedirs(base / f"d{f}", exist_ok=True)
        (base / f"d{f}" / f"MyReport_{f}.log").write_bytes((end.join(lines) + (end if f else "")).encode())
    (base / "MyReport_empty.log").write_bytes(b"")
    (base / "MyReport_head.log").write_bytes(b"RequestId,Text\n")
    (base / "Other_1.log").write_bytes(b"RequestId\nno\n")
    return str(base)


@pytest.mark.parametrize("size", [37, 64, 300, 1500, 128 << 20])
def test_any_split_gives_the_same_rows(spark, folder, size):
    want = rows(logs.read_report_logs(spark, folder, "MyReport", COLS, True))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if size < 1000:
            assert logs._log_lines(spark, folder, "MyReport").select("file", "at").distinct().count() > 10
        got = rows(logs.read_split_logs(spark, folder, "MyReport", COLS, True))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len(got) == 180


def test_splits_that_are_too_many_to_broadcast(spark, folder, monkeypatch):
    want = rows(logs.read_report_logs(spark, folder, "MyReport", COLS, True))
    monkeypatch.setattr(logs, "BROADCAST_SPLITS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert rows(logs.read_split_logs(spark, folder, "MyReport", COLS, True)) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
