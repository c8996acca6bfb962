"""Source-shaped tables derived from the driver's tables, so the staging pipelines run at scale.

Each adapter reshapes whole driver tables into one source layout (FIXTURES §1) with values chosen
by deterministic rules over the keys, so every branch of the pipelines is exercised:
  * CRM regions: ``part`` split four ways by key, countries from ``nation``, modification times from
    ``lineitem``; parents are a small set of hot ids; every 19th part also appears as an older copy.
  * Catalogue codes: ``part`` with blank codes, '-' names and NULL / '-' presentations.
  * Market tables: suppliers as brands, parts as products, nations / regions as laboratories and
    corporations, lineitem pairs as product molecules.
  * Legacy history tables: text snapshots of ``part``, ``customer`` and supplier-part edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.plans import constants as K
from vaultkit.sources.testbed import memo


# Fixed values of the adapters (shape rules only; the pipelines do not depend on them).
PARENT_POOL = 97
OLD_COPY_EVERY = 19
OLD_COPY_DAYS = 30


def _case(key: Column, mod: int, values: list) -> Column:
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(key % mod == i, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


@memo
def part_modified(t) -> DataFrame:
    return t["lineitem"].groupBy("l_partkey").agg(F.max("l_shipdate").alias("lastmodifieddate"))


@memo
def crm_rows(t) -> DataFrame:
    """All CRM product rows (every region), plus an older copy of every 19th part."""
    p = t["part"]
    n = t["nation"].select("n_nationkey", "n_name")
    k = F.col("p_partkey")
    j = p.join(n, (k % 25) == F.col("n_nationkey")).join(part_modified(t), k == F.col("l_partkey"), "left")
    brand_no = F.substring_index(F.col("p_brand"), "#", -1).cast("int")
    rows = j.select(
        (k % 4).alias("region"),
        F.when(k % 31 == 0, F.lit("")).when(k % 7 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("country_code_bi__c"),
        F.concat(F.lit("P"), k.cast("string")).alias("id"),
        F.when(k % 53 == 0, F.lit("Neurology"))
         .when(k % 37 == 0, F.concat(F.lit("BI "), F.col("p_name")))
         .when(k % 41 == 0, F.concat(F.col("p_name"), F.lit(" delete")))
         .when(F.col("p_size") % 9 == 0, F.concat(F.lit(".."), F.col("p_name"), F.lit("   x")))
         .otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") % 2 == 0, F.concat_ws(" ", "p_type", "p_brand")).alias("description_vod__c"),
        _case(k, 6, [F.concat(F.lit("B_"), k.cast("string")), F.concat(F.lit("BX"), k.cast("string")),
                     F.concat(F.lit("GB_"), k.cast("string")), F.concat(F.lit("10"), k.cast("string")),
                     F.concat(F.lit("X-SAMPLE-"), k.cast("string"))]).alias("external_id_vod__c"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("Detail")).when(F.col("p_type") == "LARGE", F.lit("BRC"))
         .when(F.col("p_type") == "MEDIUM", F.lit("Form")).when(F.col("p_type") == "PROMO", F.lit("Sample"))
         .when(F.col("p_type") == "STANDARD", F.lit("")).alias("product_type_vod__c"),
        F.lit("Y").alias("active_bi__c"),
        F.lit(None).cast("string").alias("therapeutic_area_vod__c"),
        _case(brand_no, 6, ["Local Brand", "GLOBAL BRAND", "Indication", "MEDICAL SEGMENT", ""]).alias("mdm_product_type_bi__c"),
        (F.col("p_retailprice") >= 990).alias("isdeleted"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("P"), (k % PARENT_POOL).cast("string"))).alias("parent_product_vod__c"),
        F.col("lastmodifieddate").cast("timestamp_ntz").alias("lastmodifieddate"),
        k.alias("__k"),
    )
    old = rows.where(F.col("__k") % OLD_COPY_EVERY == 0).withColumns({
        "name": F.concat(F.col("name"), F.lit(" old")),
        "lastmodifieddate": F.col("lastmodifieddate") - F.expr(f"INTERVAL {OLD_COPY_DAYS} DAYS"),
    })
    return rows.unionByName(old).drop("__k")


def crm_tables(t) -> dict[str, DataFrame]:
    """``crm_product_<region>`` tables and ``dim_country`` in the CRM source layout."""
    rows = crm_rows(t)
    out = {f"crm_product_{r}": rows.where(F.col("region") == i).drop("region") for i, r in enumerate(K.CRM_REGIONS)}
    out["dim_country"] = t["nation"].where(F.col("n_regionkey") != 4).select(F.concat(F.lit(" "), F.col("n_name")).alias("iso2_code"))
    return out


@memo
def catalogue_claves(t) -> DataFrame:
    p = t["part"]
    k = F.col("p_partkey")
    rows = p.select(
        F.when(k % 29 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" c"), k.cast("string"))).alias("clave"),
        F.when(k % 23 == 0, F.lit("-")).otherwise(F.col("p_name")).alias("nombre"),
        F.col("p_type").alias("forma_farma"),
        F.concat(F.col("p_size").cast("string"), F.lit(" mg")).alias("concentracion"),
        _case(k, 3, [F.lit(None).cast("string"), F.lit("-"), F.col("p_brand")]).alias("presentacion"),
        k.alias("__k"),
    )
    return rows.unionByName(rows.where(F.col("__k") % 17 == 0)).drop("__k")


def catalogue_tables(t) -> dict[str, DataFrame]:
    return {"catalogue_claves": catalogue_claves(t)}


# --- market ------------------------------------------------------------------------------------

# Corporation name fragment that marks the owner in the market adapter (competitor flag 'N').
MARKET_OWNER = "AMER"
MOLECULES = 40


@memo
def supplier_modified(t) -> DataFrame:
    return t["lineitem"].groupBy("l_suppkey").agg(F.max("l_shipdate").alias("last_updt_dt"))


def market_tables(t) -> dict[str, DataFrame]:
    """Suppliers as brands, parts as products, nations as laboratories, regions as corporations,
    lineitem (part, supplier) pairs as product molecules."""
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    s = t["supplier"]
    sk = F.col("s_suppkey")
    marcas = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
               .join(supplier_modified(t), sk == F.col("l_suppkey"), "left")
               .select(F.col("n_name").alias("country"), sk.cast("string").alias("codigo"),
                       F.when(sk % 7 == 0, F.concat(F.col("s_name"), F.lit("'s  x"))).otherwise(F.col("s_name")).alias("nome"),
                       F.col("s_nationkey").cast("string").alias("siglalab"),
                       F.when(sk % 10 == 9, F.lit(0)).otherwise(F.lit(1)).alias("curr_flg"),
                       F.col("last_updt_dt").cast("timestamp_ntz").alias("last_updt_dt")))
    p = t["part"]
    k = F.col("p_partkey")
    producto = (p.join(n, (k % 25) == F.col("n_nationkey")).join(part_modified(t), k == F.col("l_partkey"), "left")
                 .select(F.col("n_name").alias("country"), k.cast("string").alias("codigo"),
                         F.when(k % 13 == 0, F.col("p_type")).when(k % 17 == 0, F.lit(""))
                          .otherwise(F.concat_ws(" ", "p_name", "p_brand")).alias("nome"),
                         (k % 100).cast("string").alias("marca"),
                         F.when(F.col("p_size") % 2 == 0, F.lit("G")).otherwise(F.lit("B")).alias("flg_classific"),
                         _case(F.col("p_size"), 3, ["E", "P"]).alias("flg_etico"),
                         (k % 25).cast("string").alias("codigolab"),
                         F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("p_brand")).alias("codigoclasse"),
                         F.when(k % 13 == 5, F.lit(0)).otherwise(F.lit(1)).alias("curr_flg"),
                         F.col("lastmodifieddate").cast("timestamp_ntz").alias("last_updt_dt")))
    laboratorio = n.select(F.col("n_name").alias("country"), F.col("n_nationkey").cast("string").alias("codigo"),
                           F.concat(F.lit("LAB"), F.col("n_regionkey").cast("string")).alias("cdg"),
                           F.col("n_regionkey").cast("string").alias("cdgcorporacao"),
                           F.when(F.col("n_nationkey") % 6 == 5, F.lit(0)).otherwise(F.lit(1)).alias("curr_flg"),
                           F.lit(None).cast("timestamp_ntz").alias("last_updt_dt"))
    r = t["region"]
    corporacao = (n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select(F.col("n_name").alias("country"), F.col("n_regionkey").cast("string").alias("codigo"),
                           F.concat(F.lit(" "), F.col("r_name"), F.lit(" corp")).alias("nome"),
                           F.col("n_nationkey").cast("string").alias("sigla"), F.lit(1).alias("curr_flg"),
                           F.lit(None).cast("timestamp_ntz").alias("last_updt_dt")))
    li = t["lineitem"].join(n, (F.col("l_partkey") % 25) == F.col("n_nationkey"))
    mol_no = (F.col("l_suppkey") % MOLECULES).cast("string")
    molecula_producto = li.select(F.col("n_name").alias("country"), F.col("l_partkey").cast("string").alias("cdgprod"),
                                  mol_no.alias("cdgmol"), F.lit(1).alias("curr_flg"),
                                  F.col("l_shipdate").cast("timestamp_ntz").alias("last_updt_dt"))
    molecula = li.select(F.col("n_name").alias("country"), mol_no.alias("codigomole"),
                         F.concat(F.lit("Mol  "), F.lit(" x"), mol_no).alias("nome"),
                         F.when(F.col("l_suppkey") % MOLECULES == MOLECULES - 1, F.lit(0)).otherwise(F.lit(1)).alias("curr_flg"),
                         F.lit(None).cast("timestamp_ntz").alias("last_updt_dt")).distinct()
    return {"market_marcas": marcas, "market_producto": producto, "market_laboratorio": laboratorio,
            "market_corporacao": corporacao, "market_molecula_producto": molecula_producto, "market_molecula": molecula}


# --- legacy history ----------------------------------------------------------------------------

LEGACY_TEXT_COLUMNS = ("geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code",
                       "product_name", "product_status_code", "effective_date", "end_date", "brand_name",
                       "competitor_indicator", "generic_indicator", "strength", "package_quantity", "substance")


def legacy_product_table(t, typed_dates: bool = False) -> DataFrame:
    """A text snapshot of ``part`` in the legacy product-history layout."""
    p = t["part"]
    k = F.col("p_partkey")
    eff_text = (F.when(k % 5 == 0, F.lit("2024-13-01")).when(k % 5 == 1, F.lit(""))
                .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).cast("string")))
    eff = F.try_to_date(eff_text) if typed_dates else eff_text
    rows = p.select(
        F.when(k % 3 == 0, F.lit(" mx ")).otherwise(F.lit("MX")).alias("geographic_id"),
        F.lit("LEGACY").alias("dataset_id"), F.lit("PART").alias("source_dataset_id"),
        F.when(k % 19 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" p"), k.cast("string"), F.lit(" "))).alias("dataset_product_id"),
        F.lit("PMP").alias("product_type_code"),
        F.when(k % 23 == 0, F.lit("-")).otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("product_name"),
        F.lit(" a ").alias("product_status_code"),
        eff.alias("effective_date"),
        (F.lit(None).cast("date") if typed_dates else F.lit(None).cast("string")).alias("end_date"),
        F.col("p_brand").alias("brand_name"),
        F.when(k % 2 == 0, F.lit(" y ")).otherwise(F.lit("n")).alias("competitor_indicator"),
        F.lit(" g ").alias("generic_indicator"),
        F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("strength"),
        F.col("p_size").cast("string").alias("package_quantity"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("substance"),
    )
    from vaultkit.plans.legacy import LEGACY_NULL_COLUMNS
    from vaultkit.spec import PRODUCT, PRODUCT_DATE_COLUMNS
    cols = []
    for c in PRODUCT.columns:
        if c in LEGACY_NULL_COLUMNS:
            continue
        if c in rows.columns:
            cols.append(F.col(c))
        else:
            t_ = "date" if (typed_dates and c in PRODUCT_DATE_COLUMNS) else "string"
            cols.append(F.lit(None).cast(t_).alias(c))
    return rows.select(*cols)


def legacy_identifier_table(t) -> DataFrame:
    c = t["customer"].join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    first = t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    j = c.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    return j.select(
        F.concat(F.lit(" "), F.col("n_name")).alias("geographic_id"), F.lit("LEGACY").alias("dataset_id"),
        F.when(k % 19 == 0, F.lit("")).otherwise(k.cast("string")).alias("dataset_product_id"),
        F.lit("LEGACY").alias("identifier_type_code"),
        F.when(k % 13 == 0, F.lit("-")).otherwise(F.concat(F.lit("ID"), k.cast("string"))).alias("identifier_id"),
        F.lit(" A ").alias("status_code"),
        F.when(k % 5 == 0, F.lit("not a date")).otherwise(F.col("first_order").cast("date").cast("string")).alias("effective_date"),
        F.lit(None).cast("string").alias("end_date"),
    )


def legacy_relationship_table(t, typed_dates: bool = False) -> DataFrame:
    from vaultkit.sources.testbed import edges
    e = edges(t)
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    n = t["nation"].select("n_nationkey", "n_name")
    j = e.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    eff = F.col("last_ship").cast("date")
    return j.select(
        F.lower("n_name").alias("parent_geographic_id"), F.lower("n_name").alias("child_geographic_id"),
        F.lit(" SUPPLIER ").alias("parent_dataset_id"), F.lit("PART").alias("child_dataset_id"),
        F.when(F.col("l_suppkey") % 23 == 0, F.lit("")).otherwise(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("parent_dataset_product_id"),
        F.col("l_partkey").alias("child_dataset_product_id"),
        F.lit(" SUPPLIES ").alias("relationship_type_code"), F.lit(None).cast("string").alias("status_code"),
        (eff if typed_dates else eff.cast("string")).alias("effective_date"),
        (F.lit(None).cast("date") if typed_dates else F.lit("2024-13-01")).alias("end_date"),
    )
