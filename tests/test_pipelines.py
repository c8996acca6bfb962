"""Staging pipelines on small source-shaped frames (the quirks listed in FIXTURES §1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultkit.plans import catalogue, crm, legacy, market
from vaultkit.plans import constants as K
from vaultkit.spec import LoadContext

CTX = LoadContext(batch_id="T1", run_ts=dt.datetime(2025, 2, 1, 12, 0, 0), record_source="TEST")
CRM_SCHEMA = ("country_code_bi__c string, id string, name string, description_vod__c string, external_id_vod__c string, "
              "product_type_vod__c string, active_bi__c string, therapeutic_area_vod__c string, "
              "mdm_product_type_bi__c string, isdeleted boolean, parent_product_vod__c string, lastmodifieddate timestamp_ntz")
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 6, 1)


def crm_row(country, id_, name, ext=None, ptype="DETAIL", mdm=None, deleted=False, parent=None, mod=T0, desc=None):
    return (country, id_, name, desc, ext, ptype, "Y", None, mdm, deleted, parent, mod)


@pytest.fixture(scope="module")
def crm_tables(spark):
    rows = [
        crm_row("DE", "G1", "Global One", mdm="GLOBAL BRAND"),
        crm_row("de", "L1", "..Local   One", mdm="LOCAL BRAND", parent="G1"),            # lower-case country, dots, blanks
        crm_row("FR", "L2", "Local Two", mdm="LOCAL BRAND", parent="G1"),                 # parent in another country
        crm_row("DE", "B1", "Brand By Ext", ext="B_1", mdm=""),                            # '' mdm + B_ ext -> BRAND
        crm_row("DE", "B2", "Null Mdm Brand", ext="B_2", mdm=None),                        # NULL mdm -> not BRAND
        crm_row("DE", "B3", "Wildcard Ext", ext="BX3", mdm=""),                            # BX3 is no literal underscore
        crm_row("DE", "P1", "Form Item", ptype="FORM", mdm="INDICATION", parent="L1"),     # two labels: PMP + IND
        crm_row("CH", "P2", "Brc Sample", ptype="BRC", ext="X SAMPLE", parent="L1"),
        crm_row("CH", "P3", "Brc Plain", ptype="BRC", ext="X", parent="L1"),
        crm_row("DE", "P4", "Brc Elsewhere", ptype="BRC", parent="MISSING"),               # parent missing
        crm_row("GB", "I1", "Gb Indication", ext="GB_7", mdm=""),
        crm_row("DE", "I2", "Code Indication", ext="10X", ptype=None, mdm=None),
        crm_row("DE", "T1", "Neurology", mdm=None),                                        # therapy area by name
        crm_row("DE", "D1", "BI Internal", ptype="FORM"),                                  # deny-list
        crm_row("DE", "D2", "To Delete", ptype="FORM"),
        crm_row("DE", "D3", "x duplicate to y", ptype="FORM"),
        crm_row("", "E1", "Blank Country", ptype="FORM"),
        crm_row("ZZ", "E2", "Unknown Country", ptype="FORM"),
        crm_row("DE", "X1", "Deleted Form", ptype="FORM", deleted=True),
        crm_row("DE", "L1", "Local One Old", mdm="LOCAL BRAND", parent="G1", mod=dt.datetime(2023, 1, 1)),  # same id twice
    ]
    df = spark.createDataFrame(rows, CRM_SCHEMA)
    empty = spark.createDataFrame([], CRM_SCHEMA)
    t = {f"crm_product_{r}": empty for r in K.CRM_REGIONS}
    t["crm_product_apcnbrcem"] = df
    t["dim_country"] = spark.createDataFrame([(" de ",), ("FR",), ("CH",), ("GB",)], "iso2_code string")
    return t


def test_crm_labels(crm_tables):
    out = crm.crm_products(crm_tables, CTX)
    got = {(r["dataset_product_id"], r["product_type_code"]) for r in out.collect()}
    assert ("B1", "BRAND") in got
    assert not any(i == "B2" and l == "BRAND" for i, l in got)   # NULL NOT IN (...) is NULL
    assert not any(i == "B3" for i, _ in got)
    assert {("P1", "PMP"), ("P1", "IND")} <= got
    assert ("P2", "PMP") in got and not any(i == "P3" for i, _ in got)
    assert ("P4", "PMP") in got
    assert ("I1", "IND") in got and ("I2", "IND") in got
    assert ("T1", "TA") in got and not any(i == "T1" and l == "BRAND" for i, l in got)
    for dropped in ("D1", "D2", "D3", "E1", "E2", "X1"):
        assert not any(i == dropped for i, _ in got), dropped


def test_crm_names_and_brand(crm_tables):
    out = crm.crm_products(crm_tables, CTX).where("dataset_product_id = 'L1' AND product_name = 'LOCAL ONE'")
    r = out.first()
    assert r["geographic_id"] == "DE" and r["brand_name"] == "LOCAL ONE" and r["competitor_indicator"] == "N"
    pmp = crm.crm_products(crm_tables, CTX).where("dataset_product_id = 'P1' AND product_type_code = 'PMP'").collect()
    # raw parent lookup fans out: L1 exists twice, so P1 gets both parent names as brand names
    assert {x["brand_name"] for x in pmp} == {"LOCAL ONE", "LOCAL ONE OLD"}


def test_crm_identifiers_latest(crm_tables):
    out = crm.crm_identifiers(crm_tables, CTX)
    ids = {r["identifier_id"] for r in out.collect()}
    assert "DE_L1" in ids and "DE_P1" in ids and "GB_I1" in ids
    assert out.count() == out.select("hashkey").distinct().count()
    l1 = out.where("dataset_product_id = 'L1'").collect()
    assert len(l1) == 1 and l1[0]["source_lastmodifieddate"] == T0


def test_crm_relationships(crm_tables):
    out = crm.crm_relationships(crm_tables, CTX)
    edges = {(r["parent_dataset_product_id"], r["child_dataset_product_id"], r["relationship_type_code"],
              r["parent_geographic_id"], r["child_geographic_id"]) for r in out.collect()}
    assert ("G1", "L1", "GlobalRollup", "DE", "DE") in edges
    assert ("G1", "L2", "GlobalRollup", "DE", "FR") in edges          # joined on id only
    assert ("L1", "P1", "PMPtoBRAND", "DE", "DE") in edges
    assert ("L1", "P1", "BRANDINDtoBRAND", "DE", "DE") in edges


MKT = {
    "market_marcas": ("country string, codigo string, nome string, siglalab string, curr_flg int, last_updt_dt timestamp_ntz",
                      [("AR", "10", "Brandy ABC", "L1", 1, T0), ("AR", "11", "O'Neil  X12", "L2", 1, T1),
                       ("AR", "12", "ab", "L9", 1, T0), ("AR", "13", "", "L1", 1, T0), ("AR", "10", "Old Brand XYZ", "L1", 0, T0)]),
    "market_producto": ("country string, codigo string, nome string, marca string, flg_classific string, flg_etico string, "
                        "codigolab string, codigoclasse string, curr_flg int, last_updt_dt timestamp_ntz",
                        [("AR", "P1", "Aspirin  Forte 500MG", "10", "G", "E", "L1", "N02", 1, T1),
                         ("AR", "P2", "Single", "11", None, "P", "L2", " ", 1, T0),
                         ("AR", "P3", "Gone", "10", None, None, "L1", None, 0, T0)]),
    "market_corporacao": ("country string, codigo string, nome string, sigla string, curr_flg int, last_updt_dt timestamp_ntz",
                          [("AR", "C1", "Acme Pharma Ltd", "L1", 1, T0), ("AR", "C2", "Other Corp", "L2", 1, T0)]),
    "market_laboratorio": ("country string, codigo string, cdg string, cdgcorporacao string, curr_flg int, last_updt_dt timestamp_ntz",
                           [("AR", "L1", "LAB1", "C1", 1, T0), ("AR", "L2", "LAB2", "C2", 0, T0)]),
    "market_molecula_producto": ("country string, cdgprod string, cdgmol string, curr_flg int, last_updt_dt timestamp_ntz",
                                 [("AR", "P1", "M1", 1, T0), ("AR", "P1", "M2", 1, T0), ("AR", "P1", "M3", 1, T0), ("AR", "P1", "M1", 1, T0)]),
    "market_molecula": ("country string, codigomole string, nome string, curr_flg int, last_updt_dt timestamp_ntz",
                        [("AR", "M1", "zinc", 1, T0), ("AR", "M2", "acid  salicylic", 1, T0), ("AR", "M3", "zinc", 1, T0)]),
}


@pytest.fixture(scope="module")
def mkt_tables(spark):
    return {k: spark.createDataFrame(rows, schema) for k, (schema, rows) in MKT.items()}


def test_market_products(mkt_tables):
    out = {r["dataset_product_id"]: r for r in market.market_products(mkt_tables, CTX, own_corporation="Acme Pharma").collect()}
    assert out["BRAND_10"]["product_name"] == "BRANDY" and out["BRAND_10"]["competitor_indicator"] == "N"
    assert out["BRAND_11"]["product_name"] == "ONEIL" and out["BRAND_11"]["competitor_indicator"] == "Y"
    assert out["BRAND_12"]["product_name"] == "" and out["BRAND_12"]["manufacturer_id"] is None   # lab missing
    assert out["BRAND_13"]["product_name"] == ""
    p1 = out["P1"]
    assert p1["product_name"] == "ASPIRIN FORTE" and p1["brand_name"] == "BRANDY"
    assert p1["substance"] == "acid salicylic|zinc" and p1["generic_indicator"] == "Y"
    assert p1["prescription_required_indicator"] == "Y" and p1["atc_code"] == "N02" and p1["manufacturer_id"] == "LAB1L1"
    p2 = out["P2"]
    assert p2["product_name"] == "SINGLE" and p2["atc_code"] is None and p2["prescription_required_indicator"] == "N"
    assert p2["manufacturer_id"] is None and p2["competitor_indicator"] == "Y"   # lab row not current
    assert "P3" not in out


def test_market_relationships(mkt_tables):
    out = market.market_relationships(mkt_tables, CTX).collect()
    assert {(r["parent_dataset_product_id"], r["child_dataset_product_id"]) for r in out} == {("BRAND_10", "P1"), ("BRAND_11", "P2")}
    assert {r["source_lastmodifieddate"] for r in out if r["child_dataset_product_id"] == "P2"} == {T1}


def test_catalogue(spark):
    claves = spark.createDataFrame([
        (" a1 ", "Paracetamol", "Tableta", "500 mg", "Caja con 10"),
        ("a2", "Ibuprofeno", "Tableta", "200 mg", "-"),
        ("a3", "Naproxeno", "Tableta", "250 mg", None),
        ("a4", "-", "Tableta", "1 mg", "x"),
        ("a1", "Paracetamol", "Tableta", "500 mg", "Caja con 10"),
    ], "clave string, nombre string, forma_farma string, concentracion string, presentacion string")
    t = {"catalogue_claves": claves}
    rows = {r["dataset_product_id"]: r for r in catalogue.catalogue_products(t, CTX).collect()}
    assert rows["A1"]["product_name"] == "PARACETAMOL TABLETA 500 MG CAJA CON 10"
    assert rows["A2"]["product_name"] == "IBUPROFENO TABLETA 200 MG" and rows["A3"]["product_name"] == "NAPROXENO TABLETA 250 MG"
    assert "A4" not in rows and rows["A1"]["substance"] == "PARACETAMOL"
    assert catalogue.catalogue_products(t, CTX).count() == 4          # repeated code kept (no dedupe)
    strict = {r["dataset_product_id"]: r for r in catalogue.catalogue_products(t, CTX, strict_nulls=True).collect()}
    assert strict["A3"]["product_name"] is None and strict["A2"]["product_name"] is None
    assert strict["A1"]["product_name"] == "PARACETAMOL TABLETA 500 MG CAJA CON 10"
    ids = {r["identifier_id"] for r in catalogue.catalogue_identifiers(t, CTX).collect()}
    assert ids == {"MX_A1", "MX_A2", "MX_A3"}
    rel = catalogue.catalogue_relationships(t, CTX).collect()
    assert all(r["parent_dataset_product_id"] is None for r in rel) and len(rel) == 5


def test_legacy(spark):
    cols = [c for c in legacy.PRODUCT.columns if c not in legacy.LEGACY_NULL_COLUMNS]
    base = {c: None for c in cols}
    rows = []
    for pid, name, eff in [(" p1 ", " Name ", "2024-02-03"), ("p2", "-", "2024-01-01"), ("p3", "Three", "2024-13-01"), ("p4", "Four", "")]:
        r = dict(base, dataset_product_id=pid, product_name=name, effective_date=eff, geographic_id=" ar ", competitor_indicator=" y ")
        rows.append(tuple(r[c] for c in cols))
    table = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    out = {r["dataset_product_id"]: r for r in legacy.legacy_products(table, CTX, "legacy").collect()}
    assert set(out) == {"p1", "p3", "p4"}
    assert out["p1"]["effective_date"] == dt.date(2024, 2, 3) and out["p3"]["effective_date"] is None and out["p4"]["effective_date"] is None
    assert out["p1"]["product_name"] == "Name" and out["p1"]["geographic_id"] == "ar" and out["p1"]["competitor_indicator"] == " y "
    mk = {r["dataset_product_id"]: r for r in legacy.legacy_products(table, CTX, "market").collect()}
    assert set(mk) == {"P1", "P2", "P3", "P4"} and mk["P1"]["geographic_id"] == "AR" and mk["P1"]["competitor_indicator"] == "Y"
    assert out["p1"]["hashdiff"] != legacy.legacy_products(table, CTX, "catalogue").where("dataset_product_id = 'p1'").first()["hashdiff"]
