"""Whether the files of a snapshot are what was written."""

from datetime import date
from pathlib import Path

import pytest

from martloom.__main__ import main
from martloom.schemas import RAW_SCHEMAS
from martloom.sinks import export_raw
from martloom.sources.manifest import MANIFEST, require_whole, verify_snapshot, write_manifest
from martloom.sources.readers import load_snapshot
from martloom.sources.snapshots import find_snapshot, snapshot_path

DAY = date(2001, 6, 30)


@pytest.fixture(params=["csv", "parquet"])
def written(spark, tables, tmp_path, request):
    """A table in four files, and the path of its folder."""
    export_raw(tables.inventory.repartition(4), str(tmp_path), "inventory", DAY, request.param, manifest=True)
    return snapshot_path(str(tmp_path), "inventory", DAY, request.param)


def statuses(spark, path):
    found = verify_snapshot(spark, {"inventory": path}).collect()
    return sorted(r.status.split(":")[0] for r in found)


def parts(path):
    return sorted(p for p in Path(path).glob("part-*") if p.stat().st_size)


def test_written_files_are_whole(spark, tables, written):
    assert statuses(spark, written) == ["whole"] * 4
    require_whole(spark, {"inventory": written})
    zone, form = str(Path(written).parent), written.rsplit(".", 1)[-1]
    read = load_snapshot(spark, find_snapshot(spark, zone, ["inventory"], DAY))["inventory"]
    assert read.count() == tables.inventory.count()
    rows = sum(r.rows for r in verify_snapshot(spark, {"inventory": written}).collect())
    assert rows == tables.inventory.count() + (4 if form == "csv" else 0)


def test_a_lost_file(spark, written):
    lost = parts(written)[1]
    lost.unlink()
    assert statuses(spark, written) == ["missing"] + ["whole"] * 3
    with pytest.raises(ValueError, match=rf"inventory/{lost.name}: missing"):
        require_whole(spark, {"inventory": written})


def test_a_file_that_came_later(spark, written):
    first = parts(written)[0]
    first.with_name("part-later" + first.suffix).write_bytes(first.read_bytes())
    assert statuses(spark, written) == ["not listed"] + ["whole"] * 4


def test_a_cut_file(spark, written):
    cut = parts(written)[2]
    cut.write_bytes(cut.read_bytes()[:-30])
    cut.with_name(f".{cut.name}.crc").unlink(missing_ok=True)
    found = statuses(spark, written)
    assert found == (["changed"] + ["whole"] * 3 if written.endswith("csv") else ["unreadable"])
    with pytest.raises(ValueError, match="not whole"):
        require_whole(spark, {"inventory": written})


def test_changed_cells_of_the_same_size(spark, tables, tmp_path):
    export_raw(tables.inventory.coalesce(1), str(tmp_path), "inventory", DAY, manifest=True)
    path = snapshot_path(str(tmp_path), "inventory", DAY)
    (file,) = parts(path)
    text = file.read_bytes()
    at = text.rindex(b"2")
    file.write_bytes(text[:at] + b"3" + text[at + 1 :])
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert statuses(spark, path) == ["changed"]
    write_manifest(spark, path)
    assert statuses(spark, path) == ["whole"]


def test_no_manifest(spark, tables, tmp_path):
    export_raw(tables.inventory, str(tmp_path), "inventory", DAY)
    path = snapshot_path(str(tmp_path), "inventory", DAY)
    assert not Path(path, MANIFEST).exists()
    assert statuses(spark, path) == ["no manifest"]


def test_jobs_verify_on_request(spark, tables, tmp_path):
    zone = str(tmp_path / "zone")
    for name, schema in RAW_SCHEMAS.items():
        df = getattr(tables, name) if hasattr(tables, name) else spark.createDataFrame([], schema)
        export_raw(df, zone, name, DAY, "parquet", manifest=True)
    job = ["marketing", "--zone", zone, "--as-of", str(DAY), "--mart", str(tmp_path / "m"), "--verify"]
    main(job)
    parts(snapshot_path(zone, "web_sales", DAY, "parquet"))[0].unlink()
    with pytest.raises(ValueError, match="web_sales"):
        main(job)
