"""Declared sources: shape, drift, and missing columns named before a load."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from vaultkit.session import ensure_checkpoint_dir
from vaultkit.sources import declared as S
from vaultkit.sources import adapters as AD


def test_thirteen_sources_and_six_histories():
    names = S.sources()
    assert len(names) == 19 and sum(n.endswith("_history") for n in names) == 6


@pytest.fixture
def base(spark, tables):
    path = os.path.join(ensure_checkpoint_dir(spark), f"sources-{uuid.uuid4().hex[:8]}")
    c = AD.catalogue_claves(tables)
    c.select(F.lit(1).alias("extra"), *[F.col(x).alias(x.upper()) for x in reversed(c.columns) if x != "presentacion"]).write.parquet(f"{path}/catalogue_claves.parquet")
    AD.market_tables(tables)["market_marcas"].drop("siglalab", "nome").write.parquet(f"{path}/market_marcas.parquet")
    return path


def test_drifted_file_is_read_by_its_declaration(spark, tables, base):
    got = S.read_source(spark, base, "catalogue_claves")
    assert got.schema == S.sources()["catalogue_claves"]
    want = AD.catalogue_claves(tables).withColumn("presentacion", F.lit(None).cast("string"))      # optional, and the file lacks it
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got.select("clave")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<clave:string>" in plan


def test_missing_columns_are_named_before_the_load(spark, tables, base):
    S.check_sources(spark, base, ["catalogue_claves"])
    with pytest.raises(S.MissingColumns, match="market_marcas lacks nome, siglalab"):
        S.check_sources(spark, base, ["catalogue_claves", "market_marcas"])
    frames = {"market_marcas": AD.market_tables(tables)["market_marcas"].drop("codigo"), "dim_country": spark.sql("SELECT 1 AS x")}
    with pytest.raises(S.MissingColumns, match="dim_country lacks iso2_code; market_marcas lacks codigo"):
        S.DeclaredSources(frames=frames)


def test_frames_take_the_declared_types(spark):
    df = spark.sql("SELECT 7 AS ISO2_CODE, 'more' AS other")
    assert S.shaped(df, "dim_country").collect() == [("7",)]
    assert dict(S.DeclaredSources(frames={"dim_country": df}))["dim_country"].columns == ["iso2_code"]
    with pytest.raises(KeyError):
        S.DeclaredSources(frames={})["dim_country"]
