from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom import sinks
from martloom.__main__ import main
from martloom.plans.extract import export_all, extract_snapshot
from martloom.schemas import RAW_SCHEMAS
from martloom.sources import readers, snapshots

DAY = date(2000, 1, 3)


def _calendar(spark, days=5):
    return spark.createDataFrame([(100 + i, date(2000, 1, 1 + i)) for i in range(days)], "d_date_sk int, d_date date")


# --- which rows belong to a snapshot ---------------------------------------------


@pytest.mark.parametrize(
    "column, keeps_null",
    [
        ("ss_sold_date_sk", False),
        ("S_OPEN_DATE_SK", False),
        ("wp_start_date_sk", False),
        ("wp_creation_date_sk", False),
        ("sr_returned_date_sk", False),
        ("cs_ship_date_sk", True),
        ("s_closed_date_sk", True),
        ("cp_end_date_sk", True),
        ("c_first_sales_date_sk", True),
        ("c_first_shipto_date_sk", True),
        ("wp_access_date_sk", True),
        ("inv_date_sk", True),
    ],
)
def test_as_of_filter_by_kind_of_date(spark, column, keeps_null):
    df = spark.createDataFrame([(None,), (9,), (10,), (11,)], f"{column} long")
    kept = {r[0] for r in snapshots.as_of_filter(df, 10, [column]).collect()}
    assert kept == ({None, 9, 10} if keeps_null else {9, 10})


def test_as_of_filter_joins_conditions_and_leaves_other_tables_alone(spark, rows):
    df = spark.createDataFrame([(1, None), (1, 12), (None, 1), (1, 1)], "x_sold_date_sk int, x_ship_date_sk int")
    assert rows(snapshots.as_of_filter(df, 10)) == [(1, 1), (1, None)]
    assert rows(snapshots.as_of_filter(df, 10, ["x_sold_date_sk"])) == [(1, 1), (1, 12), (1, None)]
    plain = spark.range(3)
    assert snapshots.as_of_filter(plain, 0) is plain


def test_date_keys_are_found_like_the_pattern(spark):
    names = ["a_date_sk", "a_date_sk_old", "date_sk", "xdate_sk", "a_dateXsk", "a_time_sk", "_date_sk"]
    df = spark.createDataFrame([(1,) * len(names)], names)
    assert snapshots.date_key_columns(df) == ["a_date_sk", "xdate_sk", "a_dateXsk", "_date_sk"]


def test_as_of_key(spark):
    assert snapshots.as_of_key(_calendar(spark), DAY) == 102
    with pytest.raises(ValueError, match="no key for 1999-01-01"):
        snapshots.as_of_key(_calendar(spark), date(1999, 1, 1))
    bad = spark.createDataFrame([("x", DAY)], "d_date_sk string, d_date date")
    with pytest.raises(TypeError, match="not a whole number"):
        snapshots.as_of_key(bad, DAY)


def test_calendar_range_includes_both_ends(spark):
    edges = [date(1989, 12, 31), date(1990, 1, 1), date(2030, 1, 1), date(2030, 1, 2)]
    df = spark.createDataFrame([(d,) for d in edges], "d_date date")
    assert [r[0] for r in snapshots.calendar_range(df).collect()] == edges[1:3]


def test_list_tables_leaves_views_out(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS listing")
    spark.sql("CREATE TABLE IF NOT EXISTS listing.base (a int) USING parquet")
    spark.sql("CREATE OR REPLACE VIEW listing.seen AS SELECT 1 AS a")
    spark.range(1).createOrReplaceTempView("passing")
    assert snapshots.list_tables(spark, "listing") == ["base"]
    spark.sql("DROP DATABASE listing CASCADE")


# --- which files belong to a snapshot --------------------------------------------


def test_resolve_snapshot():
    paths = snapshots.expected_paths("store://zone/raw/", DAY)
    assert paths[0] == "store://zone/raw/catalog_returns_2000-01-03.csv" and len(paths) == 15
    found = snapshots.resolve_snapshot(paths + ["store://zone/raw/notes.txt", "x/item_2000-01-02.csv/"])
    assert set(found) == set(RAW_SCHEMAS)
    assert found["item"] == "store://zone/raw/item_2000-01-03.csv"
    with pytest.raises(ValueError, match="customer_address, item"):
        snapshots.resolve_snapshot([p for p in paths if "item" not in p and "address" not in p])
    with pytest.raises(ValueError, match="web_sales"):
        snapshots.resolve_snapshot(paths, as_of=date(2000, 1, 4))


# --- reading raw CSV --------------------------------------------------------------


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_keys_become_longs_and_bad_cells_null(spark, tmp_path):
    file = _write(
        tmp_path / "inventory.csv",
        "inv_date_sk,inv_item_sk,inv_warehouse_sk,inv_quantity_on_hand\n1,2,3,4.5\n1.0,x,3,\n1.5,2,2.0E3,1\n",
    )
    df = readers.read_raw(spark, "inventory", file)
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "bigint", "double"]
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3, 4.5), (1, None, 3, None), (None, 2, 2000, 1.0)]
    report = {r.column: (r.rows, r.nulls) for r in readers.null_report(df).collect()}
    assert report["inv_date_sk"] == (3, 1) and report["inv_warehouse_sk"] == (3, 0)


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_a_snapshot_keeps_text_and_large_keys(spark, tmp_path, file_format):
    texts = ["  padded  ", "two\nlines\r\n", 'a "quoted", one', "back\\slash \\n \\b", "", None, " ", '"', "\\"]
    names = RAW_SCHEMAS["customer"].names
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMAS["customer"].fields)
    rows = [[3_000_000_000 + i, t] + [None] * (len(names) - 3) + [t] for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, kinds.replace("c_customer_sk int", "c_customer_sk long"))
    path = snapshots.snapshot_path(str(tmp_path), "customer", DAY, file_format)
    assert sinks.export_raw(df, str(tmp_path), "customer", DAY, file_format) == len(texts)
    back = readers.load_snapshot(spark, {"customer": path})["customer"].orderBy("c_customer_sk").collect()
    assert [(r.c_customer_sk, r.c_customer_id, r.c_last_review_date) for r in back] == [
        (3_000_000_000 + i, t, t) for i, t in enumerate(texts)
    ]


def test_a_failed_export_leaves_nothing_to_read(spark, tmp_path):
    zone = str(tmp_path)
    broken = spark.range(3).select(F.raise_error(F.lit("no such disk")).cast("int").alias("a"))
    assert export_all(spark, {"inventory": broken}, zone, DAY, 1).first().status == "failed"
    with pytest.raises(ValueError, match="inventory"):
        snapshots.find_snapshot(spark, zone, ["inventory"], DAY)
    good = spark.createDataFrame([(1, 2, 3, 4.0)], RAW_SCHEMAS["inventory"])
    for table in (good, broken):  # a failure leaves the earlier export as it was
        export_all(spark, {"inventory": table}, zone, DAY, 1)
    found = snapshots.find_snapshot(spark, zone, ["inventory"], DAY)
    assert readers.load_snapshot(spark, found)["inventory"].count() == 1


def test_the_manifest_check_looks_at_storage(spark, tmp_path):
    zone = tmp_path / "zone"
    everything = ["catalog_sales", "customer", "inventory"]
    for job in ("sales", "marketing"):
        with pytest.raises(ValueError, match="catalog_sales, customer, "):
            main([job, "--zone", str(zone), "--as-of", "2000-01-03", "--mart", str(tmp_path / "mart")])
    for name in everything[:2]:
        sinks.export_raw(spark.range(1), str(zone), name, DAY)
    with pytest.raises(ValueError, match="tables: inventory$"):
        snapshots.find_snapshot(spark, str(zone), everything, DAY)
    (zone / "customer_2000-01-03.csv" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="tables: customer, inventory$"):
        snapshots.find_snapshot(spark, str(zone), everything, DAY)


def test_extract_ends_with_one_if_a_table_failed(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS partly")
    _calendar(spark).write.mode("overwrite").saveAsTable("partly.date_dim")
    spark.range(3).withColumn("x_sold_date_sk", F.lit("text")).write.mode("overwrite").saveAsTable("partly.odd")
    call = ["extract", "--database", "partly", "--zone", str(tmp_path / "z"), "--as-of", "2000-01-03"]
    assert main(call) == 1
    spark.sql("DROP TABLE partly.odd")
    assert main([*call, "--file-format", "parquet"]) == 0
    assert (tmp_path / "z" / "date_dim_2000-01-03.parquet").is_dir()
    spark.sql("DROP DATABASE partly CASCADE")


def test_double_keys_of_facts(spark, tmp_path):
    names = RAW_SCHEMAS["store_sales"].names
    values = ["2451.0", "", "7.0", "NaN"] + ["1.0"] * (len(names) - 4)
    file = _write(tmp_path / "s.csv", ",".join(names) + "\n" + ",".join(values) + "\n")
    row = readers.read_raw(spark, "store_sales", file).first()
    assert (row.ss_sold_date_sk, row.ss_sold_time_sk, row.ss_item_sk, row.ss_customer_sk) == (2451, None, 7, None)


def test_header_in_another_order_is_an_error(spark, tmp_path):
    file = _write(
        tmp_path / "i.csv", "inv_item_sk,inv_date_sk,inv_warehouse_sk,inv_quantity_on_hand\n1,2,3,4\n"
    )
    with pytest.raises(Exception, match="header does not conform"):
        readers.read_raw(spark, "inventory", file).collect()


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "raw.item")
    assert plain == {"url": "jdbc:x", "dbtable": "raw.item", "fetchsize": "10000"}
    split = readers.jdbc_options("jdbc:x", "raw.inventory", "inv_date_sk <= 9", "inv_date_sk", 1, 9, 4)
    assert split["dbtable"] == "(SELECT * FROM raw.inventory WHERE inv_date_sk <= 9) AS extract_source"
    assert [split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "inv_date_sk", "1", "9", "4",
    ]
    with pytest.raises(ValueError, match="upperBound, numPartitions"):
        readers.jdbc_options("jdbc:x", "t", partition_column="k", lower_bound=1)


def test_split_column():
    assert readers.split_column(["c_first_shipto_date_sk", "c_customer_sk", "c_name"]) == "c_customer_sk"
    assert readers.split_column(["i_item_id", "i_item_sk"]) == "i_item_sk"
    assert readers.split_column(["name"]) is None


def test_base_tables_query():
    assert readers.base_tables_query("o'raw") == (
        "(SELECT table_name FROM information_schema.tables "
        "WHERE table_schema = 'o''raw' AND table_type = 'BASE TABLE') AS listed"
    )


def test_jdbc_access_from_settings_and_environment(spark, monkeypatch):
    assert readers.jdbc_access(spark) == {}
    monkeypatch.setenv("MARTLOOM_JDBC_USER", "reader")
    monkeypatch.setenv("MARTLOOM_JDBC_PASSWORD", "from the environment")
    spark.conf.set("spark.martloom.jdbc.password", "from spark")
    access = readers.jdbc_access(spark)
    spark.conf.unset("spark.martloom.jdbc.password")
    assert access == {"user": "reader", "password": "from spark"}
    assert readers.jdbc_options("jdbc:x", "t", access=access)["user"] == "reader"


@pytest.mark.parametrize("found, split", [((3, 9, 35), True), ((None, None, 0), False)])
def test_jdbc_read_is_split_by_the_range_of_a_key(spark, monkeypatch, found, split):
    """The reader's decisions, with a stand-in for the database."""
    asked = []

    def fake(session, url, table, **how):
        asked.append((table, how))
        if table.startswith("(SELECT min"):
            return session.createDataFrame([found], "low int, high int, n long")
        return session.createDataFrame([], "inv_date_sk int, inv_item_sk int")

    monkeypatch.setattr(readers, "read_jdbc", fake)
    readers.read_jdbc_split(spark, "jdbc:x", "raw.inventory", 9, rows_per_partition=10)
    assert asked[1][0] == "(SELECT min(inv_date_sk) AS low, max(inv_date_sk) AS high, count(*) AS n FROM raw.inventory) AS key_range"
    expected = {"partition_column": "inv_date_sk", "lower_bound": 3, "upper_bound": 10, "num_partitions": 4}
    assert asked[2] == ("raw.inventory", expected if split else {})
    assert readers.jdbc_options("jdbc:x", *asked[2][:1], **asked[2][1])["dbtable"] == "raw.inventory"


# --- writing ----------------------------------------------------------------------


def test_extract_snapshot(spark, tmp_path):
    zone = str(tmp_path / "raw")
    inventory = spark.createDataFrame(
        [(100, 1, 1, 5.0), (104, 1, 1, 6.0), (None, 1, 1, 7.0)],
        "inv_date_sk int, inv_item_sk int, inv_warehouse_sk int, inv_quantity_on_hand double",
    )
    bands = spark.createDataFrame([(1, 2, 3)], RAW_SCHEMAS["income_band"])
    broken = spark.range(3).select(F.raise_error(F.lit("no such disk")).cast("int").alias("a"))
    tables = {"date_dim": _calendar(spark), "broken": broken, "inventory": inventory, "income_band": lambda: bands}
    tables["absent"] = lambda: spark.table("no_such_table")

    extract_snapshot(spark, {"date_dim": _calendar(spark)}, date(2000, 1, 2), zone)
    report = {r.table_name: r for r in extract_snapshot(spark, tables, DAY, zone).collect()}
    assert {n: (r.row_count, r.status) for n, r in report.items()} == {
        "date_dim": (5, "exported"),
        "broken": (None, "failed"),
        "absent": (None, "failed"),
        "inventory": (2, "exported"),
        "income_band": (1, "exported"),
    }
    assert "no such disk" in report["broken"].error
    folders = {p.name for p in (tmp_path / "raw").iterdir() if p.is_dir()}
    assert not any("2000-01-02" in name for name in folders)
    paths = snapshots.resolve_snapshot([f"{zone}/{f}" for f in folders], ["inventory", "income_band"], DAY)
    loaded = readers.load_snapshot(spark, paths, ["inventory", "income_band"])
    assert loaded["inventory"].count() == 2 and loaded["income_band"].first() == (1, 2, 3)

    extract_snapshot(spark, {"date_dim": _calendar(spark)}, date(2000, 1, 4), zone, keep_older=True)
    assert any("2000-01-03" in p.name for p in (tmp_path / "raw").iterdir())


def test_nothing_is_deleted_without_a_calendar_day(spark, tmp_path):
    zone = str(tmp_path / "raw")
    extract_snapshot(spark, {"date_dim": _calendar(spark)}, DAY, zone)
    with pytest.raises(ValueError):
        extract_snapshot(spark, {"date_dim": _calendar(spark)}, date(1980, 1, 1), zone)
    assert any("2000-01-03" in p.name for p in (tmp_path / "raw").iterdir())


def test_export_all_overwrites(spark, tmp_path):
    zone = str(tmp_path)
    for rows in (3, 2):
        report = export_all(spark, {"t": spark.range(rows)}, zone, DAY, 1).first()
        assert report.row_count == rows
    assert spark.read.option("header", True).csv(snapshots.snapshot_path(zone, "t", DAY)).count() == 2


def test_publish_views_and_tables(spark, tmp_path):
    base = str(tmp_path)
    exact = spark.createDataFrame([(1, "a")], "k long, v string").withColumn("m", F.lit("1.50").cast("decimal(9,2)"))
    sinks.write_mart(exact, base, "shown")
    assert readers.read_mart(spark, base, "shown").dtypes[2] == ("m", "double")
    assert sinks.publish(spark, base, ["shown"]) == ["shown_table"]
    assert spark.sql("SELECT sum(m) FROM shown_table").first()[0] == 1.5
    spark.catalog.dropTempView("shown_table")
    sinks.write_mart(exact.union(exact), base, "shown")
    before = {p: p.stat().st_mtime for p in tmp_path.rglob("*.parquet")}
    for _ in range(2):
        sinks.publish(spark, base, ["shown"], as_tables=True)
    assert spark.table("shown_table").count() == 2
    spark.sql("DROP TABLE shown_table")
    assert {p: p.stat().st_mtime for p in tmp_path.rglob("*.parquet")} == before
    sinks.write_mart(exact.union(exact.withColumn("k", F.lit(2).cast("long"))), base, "parted", ["k"])
    assert len(list((tmp_path / "parted" / "k=2").glob("*.parquet"))) == 1
    sinks.publish(spark, base, ["parted"], as_tables=True)
    assert spark.table("parted_table").where("k = 2").count() == 1
    spark.sql("DROP TABLE parted_table")
