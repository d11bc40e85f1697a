"""Readers keep values; storage is shared, own to the application, or refused."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import BIDS_SCHEMA, bid, bids_df
from promolens import session
from promolens.operators.extract import exclude_test_buyers
from promolens.sources import fixtures
from promolens.sources.tables import read_bids, read_customers, read_tracks

SF = "/root/testdata/sf0.001"


def test_numbers_keep_their_type_and_text_is_read_exactly(spark):
    b = bids_df(spark, [bid(1)]).withColumn("bid_base_current_price", F.lit(10.126)).withColumn("bid_quantity_ok", F.lit(1.5))
    r = read_bids(spark, b).first()
    assert (r["bid_base_current_price"], r["bid_quantity_ok"]) == (10.126, 1.5)
    text = b.select(*[F.col(f.name).cast("string").alias(f.name.upper()) for f in BIDS_SCHEMA.fields])
    r = read_bids(spark, text).first()
    assert (r["bid_base_current_price"], r["bid_quantity_ok"], r["ord_order_id"]) == (Decimal("10.126"), Decimal("1.5"), 1)
    with pytest.raises(Exception, match="not an exact"):
        read_bids(spark, text.withColumn("BID_QUANTITY_OK", F.lit("two"))).collect()
    with pytest.raises(ValueError, match="missing column"):
        read_bids(spark, b.drop("ite_item_id"))


def test_test_buyers_by_any_numeric_id(spark):
    events = spark.createDataFrame([(("u", "7"),), (("u", "8"),), (("u", None),)], "usr struct<uid:string,user_id:string>")
    for ids in (spark.createDataFrame([(7.0,)], "cus_cust_id double"), spark.createDataFrame([("7",)], "cus_cust_id string")):
        assert [r[0]["user_id"] for r in exclude_test_buyers(events, ids).collect()] == ["8", None]


def test_readers_take_frames_paths_and_tables(spark, tmp_path):
    i = fixtures.inputs(spark, SF)
    i["customers"].write.parquet(str(tmp_path / "c"))
    i["customers"].createOrReplaceTempView("customers_view")
    n = i["customers"].count()
    assert read_customers(spark, str(tmp_path / "c")).count() == read_customers(spark, "customers_view").count() == n
    assert read_tracks(spark, i["tracks"]).columns == i["tracks"].columns


class _Fake:
    def __init__(self, master, conf=None, context=None):
        self.sparkContext, self.conf = self, self
        self.master, self._conf, self._dir = master, conf, context

    def get(self, key, default=None):
        return self._conf or default

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


def test_no_machine_local_folder_on_a_cluster(tmp_path, monkeypatch):
    monkeypatch.setenv("PROMOLENS_SCRATCH", str(tmp_path))
    assert session.checkpoint_dir(_Fake("local[4]")).startswith(str(tmp_path))
    assert session.checkpoint_dir(_Fake("spark://host:7077", conf="hdfs://x/y")) == "hdfs://x/y"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(_Fake(master))


def test_inputs_have_a_folder_of_the_application(spark):
    paths = [fixtures._store(spark, SF) for _ in range(2)]
    assert spark.sparkContext.applicationId in paths[0]["bids"] and paths[0]["bids"] != paths[1]["bids"]
    stored = fixtures.stored_inputs(spark, SF)
    fresh = fixtures.inputs(spark, SF)
    assert {k: v.count() for k, v in stored.items()} == {k: v.count() for k, v in fresh.items()}


def test_mapping_holds_the_rows_that_filters_must_reject(spark):
    i = fixtures.inputs(spark, "/root/testdata/sf0.01")
    paths = {r["path"] for r in i["tracks"].select("path").distinct().collect()}
    assert {"/signup", "/error", "/vip", "/pdp", "/orders/ordercreated"} == paths
    assert i["bids"].where("bid_base_current_price is null").count() > 0
    events = i["tracks"].where("path = '/orders/ordercreated'")
    assert events.count() > events.distinct().count()
    assert i["bids"].count() == spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").count()


@pytest.mark.parametrize("column,text", [
    ("bid_base_current_price", "10.1234567"), ("bid_quantity_ok", "1.23456"), ("ord_order_id", "12.7"), ("ite_item_id", "3.5"),
    ("tim_time_winning_date", "1e-1"), ("ord_order_id", "1234567890123456789"), ("ite_gmv_flag", "yes"), ("bid_base_current_price", ""),
    ("bid_base_current_price", "1.0000000000000000000001"), ("bid_base_current_price", "123456789012345678901")])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_that_would_be_rounded_stops_the_job(spark, column, text, ansi):
    rows_ = bids_df(spark, [bid()]).withColumn(column, F.lit(text))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"{column}: not an exact"):
            read_bids(spark, rows_).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_exact_text_is_read(spark):
    from decimal import Decimal
    texts = {"bid_base_current_price": " 10.123456 ", "bid_quantity_ok": "1.250000", "ord_order_id": "12.0", "ite_item_id": "7",
             "tim_time_winning_date": "1.2e5", "ite_gmv_flag": None}
    df = bids_df(spark, [bid()])
    for c, v in texts.items():
        df = df.withColumn(c, F.lit(v).cast("string"))
    r = read_bids(spark, df).first()
    assert (r["bid_base_current_price"], r["bid_quantity_ok"], r["ord_order_id"], r["ite_item_id"], r["tim_time_winning_date"], r["ite_gmv_flag"]) == (
        Decimal("10.123456"), Decimal("1.25"), Decimal(12), 7, 120000, None)


def test_external_mart(spark, tmp_path):
    from promolens.plans.mart import site_sales
    from promolens.sources.mart import append_mart, create_mart_table, read_mart, register_partitions, write_mart_run
    from promolens.sources.schemas import MART_SCHEMA
    from pyspark.sql import types as T
    b = bids_df(spark, [bid(1, won="2024-01-02"), bid(2, won="2024-01-01")])
    path = str(tmp_path / "it's a mart")
    two = site_sales(b, "2024-01-03").unionByName(site_sales(b, "2024-01-02"))
    try:
        create_mart_table(spark, "ext_mart", path)
        create_mart_table(spark, "ext_mart", path)      # there already
        assert spark.table("ext_mart").schema == MART_SCHEMA
        append_mart(two, path, "ext_mart")
        assert spark.table("ext_mart").count() == 2 and spark.sql("SHOW PARTITIONS ext_mart").count() == 2
        assert [r.data_type for r in spark.sql("DESCRIBE EXTENDED ext_mart").collect() if r.col_name == "Type"] == ["EXTERNAL"]
        append_mart(two, "ext_mart")
        assert read_mart(spark, "ext_mart").count() == 4
        spark.sql("DROP TABLE ext_mart")
        assert read_mart(spark, path).count() == 4     # the files stay
        create_mart_table(spark, "ext_mart", path)
        assert spark.table("ext_mart").count() == 0
        register_partitions(spark, "ext_mart")
        assert spark.table("ext_mart").count() == 4
        # runs apart
        runs = str(tmp_path / "runs")
        create_mart_table(spark, "ext_runs", runs, by_run=True)
        for _ in range(2):
            write_mart_run(two, "ext_runs", "2024-01-03")
        write_mart_run(site_sales(b, "2024-01-02"), "ext_runs", dt.date(2024, 1, 2))
        assert sorted((str(r.run_date), r.fecha) for r in spark.table("ext_runs").collect()) == [
            ("2024-01-02", "2024-01-01"), ("2024-01-03", "2024-01-01"), ("2024-01-03", "2024-01-02")]
        write_mart_run(site_sales(b, "2024-01-03"), "ext_runs", "2024-01-03")      # no longer has 2024-01-01
        assert sorted((str(r.run_date), r.fecha) for r in spark.table("ext_runs").collect()) == [
            ("2024-01-02", "2024-01-01"), ("2024-01-03", "2024-01-02")]
        write_mart_run(two, runs, "2024-01-04", "ext_runs")                        # by path, then registered
        assert spark.table("ext_runs").count() == 4 and read_mart(spark, "ext_runs").schema == MART_SCHEMA
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        with pytest.raises(RuntimeError):
            write_mart_run(two, "ext_runs", "2024-01-03")
        spark.range(1).write.saveAsTable("no_mart")
        with pytest.raises(ValueError):
            append_mart(two, "no_mart")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        for t in ("ext_mart", "ext_runs", "no_mart"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
