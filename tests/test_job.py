"""Whole batch job: outputs written, read back, footprint reported."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from stockledger.config import ADAPTER_PERIOD, scratch_path
from stockledger.plans.catalog import queries
from stockledger.plans.job import published, run_checks, run_job
from stockledger.schema import OUTPUT_SCHEMAS, OUTPUTS
from stockledger.sources.adapter import driver_tables
from stockledger.sources.readers import read_outputs
from stockledger.sources.tables import RetailTables


def test_job_writes_every_output(spark):
    out = scratch_path(spark, "test-job")
    res = run_job(driver_tables(spark, SF001), out, ADAPTER_PERIOD)
    assert set(res.outputs) == set(OUTPUTS)
    outs = read_outputs(spark, out)
    for name, df in outs.items():
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in OUTPUT_SCHEMAS[name].fields]
        assert got == want, name
    assert outs["interval_stock"].count() == 954
    assert outs["daily_stock"].count() == 38817
    assert sorted(r.Anio for r in published(spark, out, "daily_stock").select("Anio").distinct().collect()) == [1999, 2000]
    q = queries()
    for name in ("store_benefits", "family_rotation", "family_benefits_v2"):
        a, b = published(spark, out, name), q[name](spark, SF001)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    res.register(spark)
    top = spark.sql(
        "SELECT StoreId FROM store_benefits WHERE Anio = 2000 ORDER BY Beneficio DESC, StoreId LIMIT 3"
    ).collect()
    assert len(top) == 3
    fp = {r.output: r for r in res.footprint(spark).collect()}
    assert set(fp) == set(OUTPUTS) | {None}
    assert fp[None].bytes == sum(fp[n].bytes for n in OUTPUTS) > 0


def test_footprint_query(spark):
    df = queries()["output_footprint"](spark, SF001)
    assert df.count() == len(OUTPUTS) + 1
    assert os.path.basename(__file__)  # ran without a fixed local path


def test_command_line_runs_the_job(spark, capsys):
    from stockledger.__main__ import main

    out = scratch_path(spark, "cli-out")
    main(["--driver-tables", SF001, "--out", out])
    assert "interval_stock" in capsys.readouterr().out
    assert spark.read.parquet(os.path.join(out, "interval_stock.parquet")).count() == 954


def test_checks_of_a_published_folder(spark):
    t = driver_tables(spark, SF001)
    out = scratch_path(spark, "checked-job")
    run_job(t, out, ADAPTER_PERIOD)
    rows = {r.check: (r.n_checked, r.n_violations) for r in run_checks(t, out, ADAPTER_PERIOD).collect()}
    assert rows["interval_balance"] == (954, 0)
    assert rows["daily_expansion"] == (954, 0)
    for name in ("positive_stock", "storeid_benefit", "family_benefit", "storeid_rotation", "family_rotation"):
        assert rows[name][1] == 0 and rows[name][0] > 0, name
    # a damaged published table is caught
    bad = scratch_path(spark, "damaged")
    spark.read.parquet(os.path.join(out, "interval_stock.parquet")).selectExpr(
        "ProductRootCode", "StoreId", "StartDate", "EndDate", "Stock + 1 AS Stock"
    ).write.parquet(os.path.join(bad, "interval_stock.parquet"))
    for name in ("daily_stock", "store_benefits", "family_benefits", "store_rotation", "family_rotation",
                 "store_benefits_v2", "family_benefits_v2"):
        spark.read.parquet(os.path.join(out, f"{name}.parquet")).write.parquet(os.path.join(bad, f"{name}.parquet"))
    rows = {r.check: r.n_violations for r in run_checks(t, bad, ADAPTER_PERIOD).collect()}
    assert rows["interval_balance"] == 954 and rows["daily_expansion"] > 0
    light = {r.check for r in run_checks(t, out, ADAPTER_PERIOD, check_daily=False).collect()}
    assert "daily_expansion" not in light and "family_rotation" in light


def test_job_without_daily_table_and_known_products_only(spark):
    t = driver_tables(spark, SF001)
    out = scratch_path(spark, "no-daily")
    res = run_job(t, out, ADAPTER_PERIOD, daily=False, known_products_only=True)
    assert "daily_stock" not in res.outputs
    assert not os.path.exists(os.path.join(out, "daily_stock.parquet"))
    stores = {r.StoreId for r in published(spark, out, "store_benefits").collect()}
    assert 99 in stores  # its products are known
    checks = {r.check: r.n_violations for r in run_checks(t, out, ADAPTER_PERIOD).collect()}
    assert "daily_expansion" not in checks and "storeid_rotation" not in checks
    assert checks["interval_balance"] == 0 and checks["storeid_benefit"] == 0


def test_stale_days_and_broken_inputs_are_refused(spark):
    t = driver_tables(spark, SF001)
    out = scratch_path(spark, "stale")
    run_job(t, out, ADAPTER_PERIOD)
    with pytest.raises(ValueError, match="earlier run"):
        run_job(t, out, ADAPTER_PERIOD, daily=False)
    twice = RetailTables(t.products.union(t.products.limit(1)), t.sales, t.movements)
    with pytest.raises(ValueError, match="unique_product_id"):
        run_job(twice, scratch_path(spark, "refused"), ADAPTER_PERIOD)
    undated = RetailTables(t.products, t.sales, t.movements.withColumn("Date", F.when(F.col("Quantity") > 49, F.lit(None)).otherwise(F.col("Date"))))
    with pytest.raises(ValueError, match="movements_date_not_null"):
        run_job(undated, scratch_path(spark, "refused"), ADAPTER_PERIOD)
    assert run_job(undated, scratch_path(spark, "allowed"), ADAPTER_PERIOD, daily=False, allow_violations=True).outputs


def test_unreadable_daily_table_is_an_error(spark, tmp_path):
    t = driver_tables(spark, SF001)
    run_job(t, str(tmp_path), ADAPTER_PERIOD, daily=False)
    (tmp_path / "daily_stock.parquet").mkdir()
    (tmp_path / "daily_stock.parquet" / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        run_checks(t, str(tmp_path), ADAPTER_PERIOD).collect()
