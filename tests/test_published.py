"""Output sets: published together, verified against what was computed, pruned; the job's observed contract."""

import hashlib
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from stockledger.config import ADAPTER_PERIOD, scratch_path
from stockledger.functions.fingerprint import fingerprint
from stockledger.plans import job
from stockledger.plans.job import published, run_checks, run_job
from stockledger.schema import OUTPUTS
from stockledger.sources.adapter import driver_tables
from stockledger.sources.published import current_folder, manifest_numbers, prune_runs, publish_set, read_manifest, verify_outputs
from stockledger.sources.readers import read_outputs
from stockledger.sources.tables import RetailTables


def prints(frames):
    return {name: tuple(fingerprint(df).first()) for name, df in frames.items()}


@pytest.fixture(scope="module")
def world(spark):
    t = driver_tables(spark, SF001)
    out = scratch_path(spark, "sets")
    return t, out, run_job(t, out, ADAPTER_PERIOD, versioned=True)


def test_a_set_is_read_through_its_manifest(spark, world):
    t, out, res = world
    assert res.number == 1 and manifest_numbers(spark, out) == [1] and current_folder(spark, out) == res.run_dir
    frames = read_outputs(spark, out)
    assert set(frames) == set(OUTPUTS) and frames["interval_stock"].count() == 954
    assert all(r["as_written"] and r["rows"] > 0 for r in verify_outputs(spark, out).collect())
    flat = scratch_path(spark, "flat")
    run_job(t, flat, ADAPTER_PERIOD)
    assert prints(read_outputs(spark, flat)) == prints(frames)
    assert all(r["n_violations"] == 0 for r in run_checks(t, out, ADAPTER_PERIOD).collect() if r["check"] not in ("unknown_product_movements", "product_root_not_null"))
    assert {r["output"] for r in res.footprint(spark).collect()} == {*OUTPUTS, None}


def test_a_run_that_dies_between_two_writes_changes_nothing(spark, world, monkeypatch):
    t, out, _ = world
    before, number = prints(read_outputs(spark, out)), manifest_numbers(spark, out)[-1]
    done = []

    def dies(df, out_dir, name, *args, **more):
        if len(done) == 3:
            raise OSError("the driver is gone")
        done.append(name)
        return whole(df, out_dir, name, *args, **more)

    whole = job.publish
    less = RetailTables(t.products, t.sales, t.movements.where("Quantity > 0"))
    with monkeypatch.context() as m:
        m.setattr(job, "publish", dies)
        with pytest.raises(OSError, match="gone"):
            run_job(less, out, ADAPTER_PERIOD, versioned=True)
    assert "interval_stock" in done and len(done) == 3
    assert manifest_numbers(spark, out)[-1] == number and prints(read_outputs(spark, out)) == before
    again = run_job(less, out, ADAPTER_PERIOD, versioned=True, daily=False)
    after = read_outputs(spark, out, [n for n in OUTPUTS if n != "daily_stock"])
    assert again.number == number + 1 and prints(after) != {n: before[n] for n in after}
    assert not os.path.exists(f"{current_folder(spark, out)}/daily_stock.parquet")  # an older set's days are not read with it


def test_two_runs_cannot_take_one_number(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    assert publish_set(spark, out, "a", {}) == 1 and publish_set(spark, out, "b", {}) == 2
    monkeypatch.setattr("stockledger.sources.published.manifest_numbers", lambda *_: [1])
    with pytest.raises(RuntimeError, match="meanwhile"):
        publish_set(spark, out, "c", {})
    assert sorted(os.listdir(tmp_path / "manifests"))[-2:] == ["00000001.json", "00000002.json"]


def test_old_sets_are_pruned(spark, world):
    t, _, _ = world
    out = scratch_path(spark, "pruned")
    runs = [run_job(t, out, ADAPTER_PERIOD, versioned=True, daily=False) for _ in range(3)]
    names = [os.path.basename(r.run_dir) for r in runs]
    assert prune_runs(spark, out, keep=2) == names[:1]
    assert manifest_numbers(spark, out) == [2, 3] and sorted(os.listdir(f"{out.removeprefix('file:')}/runs")) == sorted(names[1:])
    assert read_manifest(spark, out)["run"] == names[2] and published(spark, out, "store_benefits").count() > 0
    with pytest.raises(ValueError, match="must stay"):
        prune_runs(spark, out, keep=0)
    with pytest.raises(ValueError, match="versioned sets"):
        run_job(t, out, ADAPTER_PERIOD)


def test_damaged_files_do_not_verify(spark, world):
    t, _, _ = world
    out = scratch_path(spark, "tampered")
    res = run_job(t, out, ADAPTER_PERIOD, versioned=True, daily=False)
    path = res.outputs["store_rotation"]
    rows = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    rows.withColumn("Rotacion", F.col("Rotacion") + F.when(F.col("StoreId") == 3, 0.001).otherwise(0)).write.mode("overwrite").parquet(path)
    assert {r["output"]: r["as_written"] for r in verify_outputs(spark, out).collect() if not r["as_written"]} == {"store_rotation": False}


def test_observed_contract_refuses_before_anything_is_published(spark, world):
    t, _, _ = world
    undated = lambda df: df.withColumn("Date", F.when(F.col("Quantity") > 49, F.lit(None)).otherwise(F.col("Date")))
    cases = {
        "unique_product_id": RetailTables(t.products.union(t.products.limit(1)), t.sales, t.movements),
        "movements_date_not_null": RetailTables(t.products, t.sales, undated(t.movements)),
        "sales_date_not_null": RetailTables(t.products, undated(t.sales), t.movements),
    }
    for rule, tables in cases.items():
        out = scratch_path(spark, "refused")
        with pytest.raises(ValueError, match=rule):
            run_job(tables, out, ADAPTER_PERIOD, versioned=True)
        assert manifest_numbers(spark, out) == [] and not os.path.exists(f"{out}/runs")
    assert run_job(cases["movements_date_not_null"], scratch_path(spark, "allowed"), ADAPTER_PERIOD, versioned=True, daily=False, allow_violations=True).number == 1


def test_versioned_job_reads_no_table_for_the_contract_alone(spark, world, monkeypatch):
    t, _, _ = world
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in plans
    monkeypatch.setattr(job.validate, "gate", lambda *_: pytest.fail("the gate scans the tables once more"))
    written = []
    whole = job.write_output
    monkeypatch.setattr(job, "write_output", lambda df, d, name, p=None: (written.append((name, df._jdf.queryExecution().executedPlan().toString())), whole(df, d, name, p))[1])
    files = scratch_path(spark, "files")
    for name in ("products", "sales", "movements"):
        getattr(t, name).write.parquet(f"{files}/{name}")
    tables = RetailTables.from_parquet(spark, *(f"{files}/{n}" for n in ("products", "sales", "movements")))
    run_job(tables, scratch_path(spark, "counted"), ADAPTER_PERIOD, versioned=True, daily=False)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = {n: sum(len(re.findall(rf"FileScan parquet.*?{files}/{n}\b", plan)) for _, plan in written) for n in ("sales", "movements")}
    assert scans == {"sales": 2, "movements": 3}


def test_fingerprint_counts_rows_values_nulls_and_types(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "", "a:b", "-", "é🙂"]), rng.choice([None, 0, -7]), rng.choice([None, 0.0, -1.25, 1e15, 0.1 + 0.2, math.nan])) for _ in range(60)]
    df = spark.createDataFrame(rows, "s string, n long, x double")
    whole = fingerprint(df).first()
    assert whole == fingerprint(df.repartition(5).orderBy(F.rand(3))).first() and whole["rows"] == 60
    others = [df.union(df.limit(1)), df.withColumn("n", F.coalesce("n", F.lit(0).cast("long"))), df.withColumn("x", F.col("x") + 0.00001), df.limit(59)]
    assert len({fingerprint(o).first()["fingerprint"] for o in [df, *others]}) == 5
    assert tuple(fingerprint(df.limit(0)).first()) == (0, "0")
    with pytest.raises(TypeError):
        fingerprint(df.select(F.array("n").alias("a")))


def test_fingerprints_add_up_longs(spark):
    """Same sums as decimals, one of which a row would be most of the cost; nulls, empty and large values count."""
    rows = [(None, "", 1), (-(2**62), "a:b", None), (5, None, 7), (5, None, 7)]
    df = spark.createDataFrame(rows, "a long, b string, c int")
    text = lambda r: "".join("-" if v is None else f"{len(str(v))}:{v}" for v in r)
    total = sum(int(hashlib.md5(text(r).encode()).hexdigest()[:15], 16) for r in rows)
    assert fingerprint(df).first().asDict() == {"rows": 4, "fingerprint": str(total)}
    empty = fingerprint(df.where("c = 99")).first()
    assert (empty["rows"], empty["fingerprint"]) == (0, "0")
    assert "MakeDecimal" not in (plan := fingerprint(df)._jdf.queryExecution().optimizedPlan().toString()) and "sum(cast(conv" not in plan
