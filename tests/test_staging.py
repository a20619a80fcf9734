"""Byte copies of landing files: equal content, manifest last, nothing twice."""

import hashlib
import os

import pytest

from shelfcast.sources import staging
from shelfcast.sources.files import MissingSourceError, write_csv


def digests(folder):
    out = {}
    for base, _, files in os.walk(folder):
        for f in files:
            if not f.startswith("."):
                path = os.path.join(base, f)
                out[os.path.relpath(path, folder)] = hashlib.sha256(open(path, "rb").read()).hexdigest()
    return out


def test_copies_are_equal_and_made_once(spark, scratch):
    write_csv(spark.range(5000).repartition(4), f"{scratch}/land/sales.csv")
    os.makedirs(f"{scratch}/land", exist_ok=True)
    with open(f"{scratch}/land/stores.csv", "wb") as f:
        f.write("Störe\r\n1,\x00\r\n\r\nlast line without end".encode())
    paths, uri = [f"{scratch}/land/sales.csv", f"{scratch}/land/stores.csv"], f"file://{scratch}/bucket/raw"
    assert staging.stage_files(spark, paths, uri) == ["sales.csv", "stores.csv"]
    source, target = digests(f"{scratch}/land"), digests(f"{scratch}/bucket/raw")
    assert {k: v for k, v in target.items() if not k.startswith("_manifest")} == source
    before = {p: os.stat(f"{scratch}/bucket/raw/{p}").st_mtime_ns for p in source}
    assert staging.stage_files(spark, paths, uri) == []
    assert before == {p: os.stat(f"{scratch}/bucket/raw/{p}").st_mtime_ns for p in source}
    with open(f"{scratch}/land/stores.csv", "ab") as f:
        f.write(b"\nmore")
    assert staging.stage_files(spark, paths, uri) == ["stores.csv"]
    assert {r.name: r.size for r in staging.staged_report(spark, uri).collect()}["stores.csv"] == os.path.getsize(
        f"{scratch}/land/stores.csv")


def test_torn_copy_leaves_no_manifest(spark, scratch, monkeypatch):
    with open(f"{scratch}/a.csv", "w") as f:
        f.write("a\n1\n")
    real = staging.copy_file

    def torn(session, copy):
        real(session, copy)
        os.remove(f"{scratch}/bucket/.a.csv.crc")  # else the file system itself refuses to read it
        with open(f"{scratch}/bucket/a.csv", "w") as f:
            f.write("a\n2\n")

    monkeypatch.setattr(staging, "copy_file", torn)
    with pytest.raises(staging.StagingError):
        staging.stage_files(spark, [f"{scratch}/a.csv"], f"{scratch}/bucket")
    assert staging.read_manifest(spark, f"{scratch}/bucket") == {}
    monkeypatch.setattr(staging, "copy_file", real)
    assert staging.stage_files(spark, [f"{scratch}/a.csv"], f"{scratch}/bucket") == ["a.csv"]
    with pytest.raises(MissingSourceError):
        staging.stage_files(spark, [f"{scratch}/none.csv"], f"{scratch}/bucket")
