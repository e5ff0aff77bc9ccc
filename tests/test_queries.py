"""Every query of the engine's own operators against its oracle SQL, on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle
from tetraframe.operators import labels as lb
from tetraframe.plans import fixtures as fx
from tetraframe.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(spark, duck, name):
    found = registry.QUERIES[name](spark, SF).toArrow()
    assert not difference(found, duck.sql(registry.ORACLES[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).toArrow().num_rows > 0


def test_flagship(spark):
    assert registry.flagship(spark, SF).count() > 0


def test_stage_table_over_flat_backgrounds(spark, tmp_path):
    """A line of items a voxel: as many as saturate all of the first time points, fewer in the others."""
    i = F.col("id")
    q = F.when(i % fx.NT < 3, 700.0).otherwise((26 + i % 11).cast("double"))
    rows = spark.range(fx.NT * fx.NZ * fx.NY * fx.NX).select((i % fx.NT + 1).cast("int").alias("l_linenumber"), F.floor(i / fx.NT).alias("_c"), q.alias("l_quantity"))
    rows = rows.withColumns({"l_orderkey": F.floor(F.col("_c") / (fx.NY * fx.NX)), "l_partkey": F.floor(F.col("_c") / fx.NX) % fx.NY, "l_suppkey": F.col("_c") % fx.NX}).drop("_c")
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    want = con.sql(registry.ORACLES["snk9_stage_csv"]).to_arrow_table()
    assert sorted(want["snr_in_nuclei"].to_pylist())[-3:] == [float("inf")] * 3 and want.num_rows == fx.NT
    assert not difference(registry.QUERIES["snk9_stage_csv"](spark, str(tmp_path)).toArrow(), want)
    # By default a flat background gives 0.
    assert {r["t"] for r in lb.intensity_in_labels(fx.voxels(spark, str(tmp_path))).where("snr = 0").collect()} == {1, 2, 3}


def test_flat_background_in_parts(spark):
    """Parts whose mean times size over size is not the mean again: their deviation misses 0 by rounding."""
    n = next(n for n in range(101, 1000) if 65535.0 / n * n != 65535.0)
    v = spark.range(0, 2 * n + 2, 1, 2).select(F.lit(1).alias("t"), F.lit(0).alias("z"), F.lit(0).alias("y"), F.col("id").cast("int").alias("x"), F.lit(65535).alias("value"), (F.col("id") % (n + 1) == n).cast("int").alias("label"))
    assert v.where("label = 0").agg(F.stddev_pop("value")).first()[0] > 0
    assert lb.intensity_in_labels(v, plain=True).first()["snr"] == float("inf") and lb.intensity_in_labels(v).first()["snr"] == 0
