"""Market (prescription data) staging: brand and product rows, and product-to-brand edges.

Tables: ``market_marcas`` (brands), ``market_producto`` (products), ``market_corporacao``
(corporations), ``market_laboratorio`` (laboratories), ``market_molecula_producto`` (product to
molecule), ``market_molecula`` (molecules). Every table versions its rows with ``curr_flg``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.dates import latest_of
from vaultkit.functions.predicates import present
from vaultkit.functions.text import collapse_whitespace, drop_last_chars, market_name, upper_trim, without_last_token
from vaultkit.operators.dedupe import sorted_distinct_list, union_all
from vaultkit.plans import constants as K
from vaultkit.plans.common import finish
from vaultkit.spec import PRODUCT, RELATIONSHIP, LoadContext


def current(df: DataFrame) -> DataFrame:
    return df.where(F.col("curr_flg") == 1)


def competitor(corporation_name: Column, own_corporation: str) -> Column:
    """'N' when the corporation is the owner (LIKE %own%), else 'Y' (also when unknown)."""
    return F.when(upper_trim(corporation_name).like(f"%{own_corporation.upper()}%"), F.lit("N")).otherwise(F.lit("Y"))


def substances(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per (country, product): distinct molecule names, blank-collapsed, sorted, '|'-joined."""
    mp = current(tables["market_molecula_producto"]).where(present("cdgprod")).select("country", "cdgprod", "cdgmol").distinct()
    mol = current(tables["market_molecula"]).where(present("nome"))
    j = mp.join(mol, (mp["cdgmol"] == mol["codigomole"]) & (mp["country"] == mol["country"]))
    rows = j.select(upper_trim(mp["country"]).alias("geographic_id"), F.trim(mp["cdgprod"]).alias("dataset_product_id"),
                    F.trim(collapse_whitespace(mol["nome"])).alias("molecule"))
    return sorted_distinct_list(rows, ["geographic_id", "dataset_product_id"], "molecule", "|", "substance")


def _brand_rows(tables: Mapping[str, DataFrame], own_corporation: str) -> DataFrame:
    m = current(tables["market_marcas"]).alias("m")
    c = current(tables["market_corporacao"]).alias("c")
    lab = current(tables["market_laboratorio"]).alias("lab")
    j = (m.join(c, (F.col("m.siglalab") == F.col("c.sigla")) & (F.col("m.country") == F.col("c.country")), "left")
          .join(lab, (F.col("m.siglalab") == F.col("lab.codigo")) & (F.col("m.country") == F.col("lab.country")), "left"))
    name = market_name(drop_last_chars(F.col("m.nome"), K.MARKET_NAME_CUT))
    return j.select(
        upper_trim(F.col("m.country")).alias("geographic_id"),
        F.concat(F.lit(K.BRAND_ID_PREFIX), F.trim(F.col("m.codigo"))).alias("dataset_product_id"),
        F.lit(K.BRAND).alias("product_type_code"),
        name.alias("product_name"), name.alias("brand_name"),
        F.lit(None).cast("string").alias("atc_code"),
        competitor(F.col("c.nome"), own_corporation).alias("competitor_indicator"),
        F.lit(None).cast("string").alias("generic_indicator"),
        F.lit(None).cast("string").alias("prescription_required_indicator"),
        F.lit(None).cast("string").alias("substance"),
        F.concat(F.trim(F.col("lab.cdg")), F.trim(F.col("m.siglalab"))).alias("manufacturer_id"),
        latest_of([F.col("m.last_updt_dt"), F.col("c.last_updt_dt"), F.col("lab.last_updt_dt")]).alias("source_lastmodifieddate"),
    )


def _product_rows(tables: Mapping[str, DataFrame], own_corporation: str) -> DataFrame:
    p = current(tables["market_producto"]).alias("p")
    s = substances(tables).alias("s")
    m = current(tables["market_marcas"]).alias("m")
    lab = current(tables["market_laboratorio"]).alias("lab")
    corp = current(tables["market_corporacao"]).alias("corp")
    j = (p.join(s, (F.col("s.dataset_product_id") == F.trim(F.col("p.codigo")))
                & (F.col("s.geographic_id") == upper_trim(F.col("p.country"))), "left")
          .join(m, (F.col("p.marca") == F.col("m.codigo")) & (F.col("p.country") == F.col("m.country")), "left")
          .join(lab, (F.col("p.codigolab") == F.col("lab.codigo")) & (F.col("p.country") == F.col("lab.country")), "left")
          .join(corp, (F.col("lab.cdgcorporacao") == F.col("corp.codigo")) & (F.col("lab.country") == F.col("corp.country")), "left"))
    return j.select(
        upper_trim(F.col("p.country")).alias("geographic_id"),
        F.trim(F.col("p.codigo")).alias("dataset_product_id"),
        F.lit(K.MP).alias("product_type_code"),
        market_name(without_last_token(F.col("p.nome"))).alias("product_name"),
        market_name(drop_last_chars(F.col("m.nome"), K.MARKET_NAME_CUT)).alias("brand_name"),
        F.nullif(F.trim(F.col("p.codigoclasse")), F.lit("")).alias("atc_code"),
        competitor(F.col("corp.nome"), own_corporation).alias("competitor_indicator"),
        F.when(F.col("p.flg_classific") == "G", F.lit("Y")).alias("generic_indicator"),
        F.when(F.col("p.flg_etico") == "E", F.lit("Y")).when(F.col("p.flg_etico") == "P", F.lit("N")).alias("prescription_required_indicator"),
        F.col("s.substance").alias("substance"),
        F.concat(F.trim(F.col("lab.cdg")), F.trim(F.col("p.codigolab"))).alias("manufacturer_id"),
        latest_of([F.col("p.last_updt_dt"), F.col("m.last_updt_dt"), F.col("lab.last_updt_dt"),
                   F.col("corp.last_updt_dt")]).alias("source_lastmodifieddate"),
    )


def market_products(tables: Mapping[str, DataFrame], ctx: LoadContext, own_corporation: str) -> DataFrame:
    """Product staging: brand rows and product rows, one row per (hashkey, hashdiff)."""
    rows = union_all([_brand_rows(tables, own_corporation), _product_rows(tables, own_corporation)])
    rows = rows.withColumns({
        "dataset_id": F.lit(K.MARKET_DATASET),
        "source_dataset_id": F.lit(K.MARKET_SOURCE),
        "description": F.nullif(F.trim("product_name"), F.lit("")),
        "product_status_code": F.lit(K.STATUS_ACTIVE),
    })
    return finish(rows, PRODUCT, ctx, K.MARKET_SOURCE, collapse_versions=True)


def market_relationships(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    """Product -> brand edges of current rows, matched on brand code and country."""
    b = current(tables["market_marcas"]).select(
        upper_trim("country").alias("geographic_id"), F.trim("codigo").alias("brand_code"),
        F.col("last_updt_dt").cast("timestamp_ntz").alias("b_mod"))
    p = current(tables["market_producto"]).select(
        upper_trim("country").alias("p_geo"), F.trim("codigo").alias("product_code"), F.trim("marca").alias("p_brand"),
        F.col("last_updt_dt").cast("timestamp_ntz").alias("p_mod"))
    j = p.join(b, (p["p_brand"] == b["brand_code"]) & (p["p_geo"] == b["geographic_id"]))
    rows = j.select(
        F.col("geographic_id").alias("parent_geographic_id"), F.col("p_geo").alias("child_geographic_id"),
        F.lit(K.MARKET_SOURCE).alias("parent_dataset_id"), F.lit(K.MARKET_SOURCE).alias("child_dataset_id"),
        F.concat(F.lit(K.BRAND_ID_PREFIX), F.col("brand_code")).alias("parent_dataset_product_id"),
        F.col("product_code").alias("child_dataset_product_id"),
        F.lit(K.MP_TO_BRAND).alias("relationship_type_code"),
        latest_of(["p_mod", "b_mod"]).alias("source_lastmodifieddate"),
    )
    return finish(rows, RELATIONSHIP, ctx, K.MARKET_SOURCE)
