"""Raw CSV read once: staged rows, cells in quarantine, counts; and the jobs that start from them."""

import re
from datetime import date
from pathlib import Path

import pytest

from martloom import schemas
from martloom.__main__ import main
from martloom.plans.marts import MARKETING_INPUTS
from martloom.sinks import export_raw
from martloom.sources.readers import read_raw
from martloom.sources.snapshots import snapshot_path
from martloom.sources.staging import quarantine, read_staged, stage_raw, stage_snapshot, staging_report
from martloom.versions import read_version, versions

DAY = date(2001, 6, 30)
HEADER = "ib_income_band_sk,ib_lower_bound,ib_upper_bound"


def written(folder, *lines, name="income_band", header=HEADER):
    path = Path(folder, f"{name}.csv")
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def cells(spark, folder, *names):
    found = quarantine(spark, folder, names or ["income_band"]).collect()
    return sorted((r.table_name, r.column or "", r.cell, r.reason, r.record) for r in found)


def test_each_kind_of_reject(spark, tmp_path, rows):
    path = written(tmp_path, "1,0,10", "2,x,20", "K3,1,2", "4.0,,", "5", "6,1,2,3", "7.5,y,z", '"8",3," 4"', "9,1.0,2")
    staged = stage_raw(spark, "income_band", path, str(tmp_path / "s"))
    assert cells(spark, str(tmp_path / "s")) == [
        ("income_band", "", "5", "columns", "5"),
        ("income_band", "", "6,1,2,3", "columns", "6,1,2,3"),
        ("income_band", "ib_income_band_sk", "7.5", "key", "7.5,y,z"),
        ("income_band", "ib_income_band_sk", "K3", "key", "K3,1,2"),
        ("income_band", "ib_lower_bound", "1.0", "type", "9,1.0,2"),
        ("income_band", "ib_lower_bound", "x", "type", "2,x,20"),
        ("income_band", "ib_lower_bound", "y", "type", "7.5,y,z"),
        ("income_band", "ib_upper_bound", " 4", "type", '"8",3," 4"'),
        ("income_band", "ib_upper_bound", "z", "type", "7.5,y,z"),
    ]
    assert (staged.rows, staged.rejected) == (9, 7)
    plain = rows(read_raw(spark, "income_band", path))
    assert rows(read_staged(spark, str(tmp_path / "s"), "income_band")) == plain
    assert rows(read_staged(spark, str(tmp_path / "s"), "income_band", with_rejected=False)) == [(1, 0, 10), (4, None, None)]
    assert staged.nulls["ib_income_band_sk"] == sum(r[0] is None for r in plain) == 2


def test_locators_and_clean_tables(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for i in range(3):
        written(folder, f"{i},1,{'bad' if i == 1 else 2}", name=f"part{i}")
    stage_raw(spark, "income_band", str(folder), str(tmp_path / "s"))
    (found,) = quarantine(spark, str(tmp_path / "s"), ["income_band"]).collect()
    assert found.file.endswith("part1.csv") and found.block_start == 0 and found.record == "1,1,bad"
    clean = stage_raw(spark, "income_band", written(tmp_path, "1,2,3"), str(tmp_path / "clean"))
    assert clean.rejected == 0 and cells(spark, str(tmp_path / "clean")) == []
    empty = stage_raw(spark, "income_band", written(tmp_path), str(tmp_path / "empty"))
    assert (empty.rows, empty.rejected) == (0, 0) and set(empty.nulls.values()) == {0}
    assert read_staged(spark, str(tmp_path / "empty"), "income_band").count() == 0
    assert quarantine(spark, str(tmp_path), []).count() == 0


def test_text_is_kept_as_the_reader_keeps_it(spark, tables, tmp_path, rows):
    export_raw(tables.item, str(tmp_path), "item", DAY)
    path = snapshot_path(str(tmp_path), "item", DAY)
    frames, staged = stage_snapshot(spark, {"item": path}, str(tmp_path / "s"))
    assert rows(frames["item"]) == rows(read_raw(spark, "item", path))
    assert frames["item"].dtypes == read_raw(spark, "item", path).dtypes
    report = {r.column: (r.rows, r.nulls, r.rejected_rows) for r in staging_report(spark, staged).collect()}
    assert report["i_item_sk"] == (tables.item.count(), 0, 0)
    assert report["i_formulation"][1] == tables.item.where("i_formulation IS NULL").count()


def test_another_header_is_an_error(spark, tmp_path):
    path = written(tmp_path, "1,2,3", header="ib_lower_bound,ib_income_band_sk,ib_upper_bound")
    with pytest.raises(Exception, match="(?i)header"):
        stage_raw(spark, "income_band", path, str(tmp_path / "s"))


@pytest.fixture(scope="module")
def zone(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("zone"))
    for name, schema in schemas.RAW_SCHEMAS.items():
        df = getattr(tables, name) if hasattr(tables, name) else spark.createDataFrame([], schema)
        export_raw(df, folder, name, DAY)
    return folder


def csv_scans(spark, since):
    """Tables whose CSV files were scanned, once for every scan, in the executions after the first ``since``."""
    store = spark._jsparkSession.sharedState().statusStore()
    done = store.executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(since, done.size())]
    return [t for p in plans for t in re.findall(r"Scan csv[^(]*\n(?:.*\n)*?Location: .*?/(\w+)_\d{4}-\d\d-\d\d\.csv", p)], done.size()


def test_marketing_job_reads_each_csv_table_once(spark, zone, tmp_path):
    _, before = csv_scans(spark, 0)
    main(["marketing", "--zone", zone, "--as-of", str(DAY), "--mart", str(tmp_path / "m"), "--versioned"])
    scans, _ = csv_scans(spark, before)
    assert sorted(scans) == sorted(MARKETING_INPUTS)
    assert read_version(spark, str(tmp_path / "m"), "rpt_clv_marketing").count() > 0
    report = spark.read.parquet(str(tmp_path / "m" / "_load_report"))
    assert report.count() == sum(len(schemas.RAW_SCHEMAS[t]) for t in MARKETING_INPUTS)
    assert spark.read.parquet(str(tmp_path / "m" / "_quarantine")).count() == 0


def test_versioned_marts_publish_any_version(spark, zone, tmp_path):
    marts = {"sales": str(tmp_path / "s"), "marketing": str(tmp_path / "m")}
    for job, mart in marts.items():
        for _ in range(2 if job == "sales" else 1):
            main([job, "--zone", zone, "--as-of", str(DAY), "--mart", mart, "--versioned"])
    assert len(versions(spark, marts["sales"], "fact_sales_inv_weekly")) == 2
    main(["publish", "--mart", marts["sales"], "--marketing-mart", marts["marketing"], "--versioned", "--version", "1"])
    try:
        for name in schemas.SALES_MART + schemas.MARKETING_MART:
            mart = marts["sales" if name in schemas.SALES_MART else "marketing"]
            assert spark.table(f"{name}_table").count() == read_version(spark, mart, name, 1).count()
    finally:
        for name in schemas.SALES_MART + schemas.MARKETING_MART:
            spark.sql(f"DROP TABLE IF EXISTS {name}_table")


def test_jobs_stop_on_too_many_nulls_or_rejects(spark, zone, tables, tmp_path):
    other = str(tmp_path / "zone")
    for name in MARKETING_INPUTS:
        df = getattr(tables, name) if hasattr(tables, name) else spark.createDataFrame([], schemas.RAW_SCHEMAS[name])
        if name == "customer":
            df = df.selectExpr(*[f"IF(c_customer_sk % 50 = 0, NULL, {c}) AS {c}" if c == "c_customer_sk" else c for c in df.columns])
        export_raw(df, other, name, DAY, "parquet")
    job = ["marketing", "--as-of", str(DAY), "--mart", str(tmp_path / "m"), "--max-null-keys", "0"]
    # Days of sales may be null, item and order keys may not.
    main([*job, "--zone", zone, "--max-rejected-rows", "0"])
    with pytest.raises(ValueError, match="customer.c_customer_sk"):
        main([*job, "--zone", other])
