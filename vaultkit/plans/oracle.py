"""DuckDB SQL oracles for the registered queries.

Each oracle is written as plain SQL over the driver's tables (views region, nation, customer,
supplier, part, orders, lineitem, events). Shared derivations are CTEs; ``sql(name)`` returns the
statement with the CTEs it needs, in dependency order.
"""

from __future__ import annotations

from vaultkit.plans.oracle_values import BED as tb
from vaultkit.plans.oracle_values import IDENTIFIER, PRODUCT, RELATIONSHIP, SAT_META, Entity

RUN = f"TIMESTAMP '{tb.RUN_TS}'"
DAY1 = f"TIMESTAMP '{tb.DAY1_TS}'"
HIST0_END = f"TIMESTAMP '{tb.HIST0_END_TS}'"
FLOOR = "TIMESTAMP '1900-01-01 00:00:00'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def md5_of(cols) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}) <> '')"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def conform_cols(spec: Entity, have: set[str]) -> str:
    out = []
    for c in spec.columns:
        t = "DATE" if c in spec.date_cols else "VARCHAR"
        out.append(f"CAST({c if c in have else 'NULL'} AS {t}) AS {c}")
    return ", ".join(out)


def staged(src: str, have: set[str], spec: Entity, batch: str, load_ts: str, rs: str = tb.RECORD_SOURCE) -> str:
    inner = f"SELECT {conform_cols(spec, have)}, source_lastmodifieddate FROM {src}"
    return (f"SELECT *, {md5_of(spec.key_cols)} AS hashkey, {md5_of(spec.diff_cols)} AS hashdiff, "
            f"{load_ts} AS load_datetime, {q(batch)} AS etl_batch_id, {q(rs)} AS record_source FROM ({inner})")


def sat_select(src: str, spec: Entity, batch: str, at: str) -> str:
    cols = ", ".join(spec.columns)
    return (f"SELECT hashkey, hashdiff, {at} AS start_datetime, {at} AS load_datetime, "
            f"CAST(NULL AS TIMESTAMP) AS end_datetime, {at} AS updated_datetime, {q(batch)} AS etl_batch_id, "
            f"{q(tb.RECORD_SOURCE)} AS record_source, {cols} FROM {src}")


PRODUCT_HAVE = {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code", "product_name", "strength"}
SAT_COLS = list(SAT_META) + list(PRODUCT.columns)
HIST_COLS = [c for c in SAT_COLS if c != "end_datetime"] + ["end_datetime"]

REJECT_JSON_FIELDS = sorted([
    "geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_name",
    "product_type_code", "hashkey", "hashdiff", "source_lastmodifieddate", "etl_batch_id", "record_source",
])


def _json(prefix: str = "s.") -> str:
    parts = []
    for f in REJECT_JSON_FIELDS:
        v = f"CAST({prefix}{f} AS VARCHAR)" if f == "source_lastmodifieddate" else f"{prefix}{f}"
        parts.append(f"'{f}': {v}")
    return "to_json({" + ", ".join(parts) + "})"


def _error_case(known: str) -> str:
    return (f"CASE WHEN {blank('s.product_name')} THEN 'EMPTY_PRODUCT_NAME' "
            f"WHEN {blank('s.dataset_product_id')} THEN 'EMPTY_DATASET_PRODUCT_ID' "
            f"WHEN {blank('s.geographic_id')} THEN 'EMPTY_COUNTRY_CODE' "
            f"WHEN {known} IS NULL THEN 'GEOGRAPHIC_ID_NOT_PRESENT' END")


def reject_sql(stg: str, model: str) -> str:
    err = _error_case("vc.iso2_code")
    base = (
        f"SELECT DISTINCT upper(trim(s.dataset_product_id)) AS dataset_product_id, "
        f"upper(trim(s.geographic_id)) AS source_country_code, upper(trim(s.dataset_id)) AS dataset_id, "
        f"upper(trim(s.source_dataset_id)) AS source_dataset_id, 'CRITICAL' AS error_level, "
        f"{err} AS error_code, {err} AS error_message, {RUN} AS load_datetime, "
        f"CAST(s.source_lastmodifieddate AS TIMESTAMP) AS source_lastmodifieddate, s.hashkey, s.hashdiff, "
        f"s.etl_batch_id, s.record_source, {q(model)} AS reject_source_model, {_json()} AS rejected_record "
        f"FROM {stg} s LEFT JOIN fx_country vc ON upper(trim(s.geographic_id)) = vc.iso2_code "
        f"WHERE {blank('s.product_name')} OR {blank('s.dataset_product_id')} OR {blank('s.geographic_id')} OR vc.iso2_code IS NULL"
    )
    key = md5_of(["source_country_code", "dataset_id", "source_dataset_id", "dataset_product_id", "error_code",
                  "hashkey", "hashdiff", "md5(rejected_record)"])
    return (f"SELECT {key} AS reject_key, dataset_product_id, source_country_code, dataset_id, source_dataset_id, "
            f"error_level, error_code, error_message, load_datetime, source_lastmodifieddate, hashkey, hashdiff, "
            f"etl_batch_id, record_source, reject_source_model, rejected_record FROM ({base})")


def dq_sql(stg: str, rejects: str, spec: Entity, floor: str = FLOOR, wm_col: str = "source_lastmodifieddate") -> str:
    req = " AND ".join(present(f"s.{c}") for c in spec.required_cols)
    anti = " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM {rejects} r WHERE r.dataset_product_id = upper(trim(s.{c})))" for c in spec.reject_id_cols
    )
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT s.*, row_number() OVER (PARTITION BY s.hashkey "
            f"ORDER BY s.load_datetime DESC NULLS LAST, s.hashdiff DESC NULLS LAST) AS rn FROM {stg} s "
            f"WHERE {req} AND s.{wm_col} >= ({floor}) AND {anti}) WHERE rn = 1")


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql, deps or [])


cte("fx_country", "SELECT DISTINCT upper(trim(n_name)) AS iso2_code FROM nation WHERE n_regionkey <> 4")
cte("fx_modified", "SELECT o_custkey, max(o_orderdate) AS modified FROM orders GROUP BY o_custkey")
cte("fx_base",
    "SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey, m.modified "
    "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN fx_modified m ON c.c_custkey = m.o_custkey",
    ["fx_modified"])
cte("fx_stg0",
    "SELECT CASE WHEN c_custkey % 17 = 0 THEN '' ELSE upper(trim(n_name)) END AS geographic_id, "
    "'CRM' AS dataset_id, 'CUSTOMER' AS source_dataset_id, CAST(c_custkey AS VARCHAR) AS dataset_product_id, "
    "c_mktsegment AS product_type_code, "
    "CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN upper(c_name) || ' V2' ELSE upper(c_name) END AS product_name, "
    "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS strength, modified AS source_lastmodifieddate "
    "FROM fx_base WHERE c_custkey % 11 <> 0", ["fx_base"])
cte("fx_stg", staged("fx_stg0", PRODUCT_HAVE, PRODUCT, tb.DAY2_BATCH, RUN), ["fx_stg0"])
cte("fx_reject", reject_sql("fx_stg", tb.STAGING_MODEL), ["fx_stg", "fx_country"])
cte("fx_dq", dq_sql("fx_stg", "fx_reject", PRODUCT), ["fx_stg", "fx_reject"])
cte("fx_day1_0",
    "SELECT upper(trim(n_name)) AS geographic_id, 'CRM' AS dataset_id, 'CUSTOMER' AS source_dataset_id, "
    "CAST(c_custkey AS VARCHAR) AS dataset_product_id, c_mktsegment AS product_type_code, upper(c_name) AS product_name, "
    "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS strength, modified AS source_lastmodifieddate "
    "FROM fx_base WHERE c_custkey % 10 <> 0 AND c_custkey % 17 <> 0 "
    "AND upper(trim(n_name)) IN (SELECT iso2_code FROM fx_country)", ["fx_base", "fx_country"])
cte("fx_day1", staged("fx_day1_0", PRODUCT_HAVE, PRODUCT, tb.DAY1_BATCH, DAY1), ["fx_day1_0"])
cte("fx_sat0", sat_select("fx_day1", PRODUCT, tb.DAY1_BATCH, DAY1), ["fx_day1"])
cte("fx_hub0",
    f"SELECT hashkey, {DAY1} AS start_datetime, {DAY1} AS load_datetime, 'CRM' AS record_source, "
    f"{q(tb.DAY1_BATCH)} AS etl_batch_id, 'PRODUCT' AS origin_stg FROM ("
    "SELECT hashkey FROM fx_sat0 UNION SELECT hashkey FROM fx_dq WHERE CAST(dataset_product_id AS BIGINT) % 20 = 0)",
    ["fx_sat0", "fx_dq"])
cte("fx_hist0",
    f"SELECT {', '.join(c for c in HIST_COLS if c != 'end_datetime')}, {HIST0_END} AS end_datetime "
    "FROM fx_sat0 WHERE CAST(dataset_product_id AS BIGINT) % 14 = 0", ["fx_sat0"])
cte("fx_action",
    "SELECT coalesce(s.hashkey, t.hashkey) AS hashkey, "
    "CASE WHEN t.hashkey IS NULL THEN 'NEW' WHEN s.hashkey IS NULL THEN 'ABSENT' "
    "WHEN s.hashdiff = t.hashdiff THEN 'UNCHANGED' ELSE 'CHANGED' END AS action, "
    "s.hashdiff AS stg_hashdiff, t.hashdiff AS sat_hashdiff, "
    "coalesce(s.dataset_product_id, t.dataset_product_id) AS dataset_product_id "
    "FROM fx_dq s FULL OUTER JOIN (SELECT * FROM fx_sat0 WHERE end_datetime IS NULL) t ON s.hashkey = t.hashkey",
    ["fx_dq", "fx_sat0"])


def with_ctes(final: str, deps: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    head = ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order)
    if final.lstrip().upper().startswith("WITH "):
        return "WITH " + head + ",\n" + final.lstrip()[5:]
    return "WITH " + head + "\n" + final


ORACLES: dict[str, tuple[str, list[str]]] = {}


def oracle(name: str, final: str, deps: list[str] | None = None) -> None:
    ORACLES[name] = (final, deps or [])


def sql(name: str) -> str:
    final, deps = ORACLES[name]
    return with_ctes(final, deps)


# --- step 0 ------------------------------------------------------------------------------------
oracle("hash_entity", "SELECT dataset_product_id, geographic_id, product_name, hashkey, hashdiff FROM fx_stg", ["fx_stg"])
oracle("delta_classified", "SELECT hashkey, action, dataset_product_id FROM fx_action", ["fx_action"])


# --- more shared derivations -------------------------------------------------------------------
RS = RUN.replace("TIMESTAMP ", "")
cte("fx_nat", "SELECT n_nationkey, upper(trim(n_name)) AS geo FROM nation")
cte("fx_cust_src",
    "SELECT geo AS geographic_id, 'CRM' AS dataset_id, 'CUSTOMER' AS source_dataset_id, CAST(c_custkey AS VARCHAR) AS dataset_product_id, "
    "'BRAND' AS product_type_code, upper(c_name) AS product_name, c_mktsegment AS channel, CAST(NULL AS TIMESTAMP) AS source_lastmodifieddate "
    "FROM customer JOIN fx_nat ON c_nationkey = n_nationkey", ["fx_nat"])
cte("fx_supp_src",
    "SELECT geo AS geographic_id, 'MARKET' AS dataset_id, 'SUPPLIER' AS source_dataset_id, 'BRAND_' || CAST(s_suppkey AS VARCHAR) AS dataset_product_id, "
    "'BRAND' AS product_type_code, upper(s_name) AS product_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS strength, "
    "CAST(NULL AS TIMESTAMP) AS source_lastmodifieddate FROM supplier JOIN fx_nat ON s_nationkey = n_nationkey", ["fx_nat"])
cte("fx_part_src",
    "SELECT 'MX' AS geographic_id, 'CATALOGUE' AS dataset_id, 'PART' AS source_dataset_id, upper(trim(CAST(p_partkey AS VARCHAR))) AS dataset_product_id, "
    "'PMP' AS product_type_code, upper(trim(concat_ws(' ', p_name, p_brand, p_type))) AS product_name, p_brand AS brand_name, "
    "'A' AS product_status_code, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS package_quantity, "
    "CAST(NULL AS TIMESTAMP) AS source_lastmodifieddate FROM part")
cte("fx_stg_cust", staged("fx_cust_src", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code", "product_name", "channel"}, PRODUCT, tb.DAY2_BATCH, RUN, "CRM"), ["fx_cust_src"])
cte("fx_stg_supp", staged("fx_supp_src", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code", "product_name", "strength"}, PRODUCT, tb.DAY2_BATCH, RUN, "MARKET"), ["fx_supp_src"])
cte("fx_stg_part", staged("fx_part_src", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code", "product_name", "brand_name", "product_status_code", "package_quantity"}, PRODUCT, tb.DAY2_BATCH, RUN, "CATALOGUE"), ["fx_part_src"])
cte("fx_sources", "SELECT * FROM fx_stg_cust UNION ALL SELECT * FROM fx_stg_supp UNION ALL SELECT * FROM fx_stg_part",
    ["fx_stg_cust", "fx_stg_supp", "fx_stg_part"])
cte("fx_ident_src",
    "SELECT upper(trim(n.n_name)) AS geographic_id, 'CRM' AS dataset_id, CAST(c.c_custkey AS VARCHAR) AS dataset_product_id, "
    "'CRM' AS identifier_type_code, upper(trim(n.n_name)) || '_' || CAST(c.c_custkey AS VARCHAR) AS identifier_id, "
    "CAST(NULL AS VARCHAR) AS status_code, CAST(f.first_order AS DATE) AS effective_date, CAST(NULL AS DATE) AS end_date, "
    "f.modified AS source_lastmodifieddate FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS modified FROM orders GROUP BY o_custkey) f "
    "ON c.c_custkey = f.o_custkey")
cte("fx_ident", staged("fx_ident_src", set(IDENTIFIER.columns), IDENTIFIER, tb.DAY2_BATCH, RUN), ["fx_ident_src"])
cte("fx_edge", "SELECT l_suppkey, l_partkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_suppkey, l_partkey")
cte("fx_rel_src",
    "SELECT upper(trim(n.n_name)) AS parent_geographic_id, upper(trim(n.n_name)) AS child_geographic_id, "
    "'SUPPLIER' AS parent_dataset_id, 'PART' AS child_dataset_id, CAST(e.l_suppkey AS VARCHAR) AS parent_dataset_product_id, "
    "CAST(e.l_partkey AS VARCHAR) AS child_dataset_product_id, 'SUPPLIES' AS relationship_type_code, "
    "CAST(NULL AS VARCHAR) AS status_code, CAST(NULL AS DATE) AS effective_date, CAST(NULL AS DATE) AS end_date, "
    "e.last_ship AS source_lastmodifieddate FROM fx_edge e JOIN supplier s ON e.l_suppkey = s.s_suppkey "
    "JOIN nation n ON s.s_nationkey = n.n_nationkey", ["fx_edge"])
cte("fx_rel", staged("fx_rel_src", set(RELATIONSHIP.columns), RELATIONSHIP, tb.DAY2_BATCH, RUN), ["fx_rel_src"])
cte("fx_wm0",
    f"SELECT 'CRM' AS source_system, {q(tb.STAGING_MODEL)} AS source_object, 'SOURCE_LASTMODIFIEDDATE' AS watermark_column, "
    f"max(o_orderdate) AS watermark_value, {DAY1} AS updated_at, {q(tb.DAY1_BATCH)} AS etl_batch_id "
    "FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'")
cte("fx_ewm0",
    f"SELECT 'EVENTS' AS source_system, 'EVENTS' AS source_object, 'TS' AS watermark_column, max(ts) AS watermark_value, "
    f"{DAY1} AS updated_at, {q(tb.DAY1_BATCH)} AS etl_batch_id FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'")
WM_FLOOR = (f"SELECT coalesce(max(watermark_value) - INTERVAL 5 MINUTE, {FLOOR}) FROM fx_wm0 WHERE source_system = 'CRM' "
            f"AND source_object = {q(tb.STAGING_MODEL)} AND upper(watermark_column) = 'SOURCE_LASTMODIFIEDDATE'")
cte("fx_dq_wm", dq_sql("fx_stg", "fx_reject", PRODUCT, WM_FLOOR), ["fx_stg", "fx_reject", "fx_wm0"])
cte("fx_metrics",
    "SELECT CAST(ins AS BIGINT) AS delta_inserted_rows, CAST(upd AS BIGINT) AS delta_updated_rows, CAST(ins + upd AS BIGINT) AS rows_processed FROM ("
    "SELECT (SELECT count(DISTINCT hashkey) FROM fx_action a WHERE action IN ('NEW','CHANGED') "
    "AND NOT EXISTS (SELECT 1 FROM fx_hub0 h WHERE h.hashkey = a.hashkey)) AS ins, "
    "(SELECT count(*) FROM fx_action WHERE action = 'CHANGED') AS upd)", ["fx_action", "fx_hub0"])
SAT_SELECT_NEXT = ", ".join(
    ["coalesce(s.hashkey, t.hashkey) AS hashkey",
     "CASE WHEN a.action IN ('NEW','CHANGED') THEN s.hashdiff ELSE t.hashdiff END AS hashdiff"]
    + [f"CASE WHEN a.action IN ('NEW','CHANGED') THEN {RUN} ELSE t.{c} END AS {c}" for c in ("start_datetime", "load_datetime")]
    + ["CASE WHEN a.action IN ('NEW','CHANGED') THEN CAST(NULL AS TIMESTAMP) ELSE t.end_datetime END AS end_datetime",
       f"CASE WHEN a.action IN ('NEW','CHANGED','UNCHANGED') THEN {RUN} ELSE t.updated_datetime END AS updated_datetime",
       f"CASE WHEN a.action IN ('NEW','CHANGED') THEN {q(tb.DAY2_BATCH)} ELSE t.etl_batch_id END AS etl_batch_id",
       "CASE WHEN a.action IN ('NEW','CHANGED') THEN left(coalesce(s.record_source, 'CRM'), 255) ELSE t.record_source END AS record_source"]
    + [f"CASE WHEN a.action IN ('NEW','CHANGED') THEN s.{c} ELSE t.{c} END AS {c}" for c in PRODUCT.columns]
)
cte("fx_sat1",
    f"SELECT {SAT_SELECT_NEXT} FROM fx_action a LEFT JOIN fx_dq s ON a.hashkey = s.hashkey "
    "LEFT JOIN (SELECT * FROM fx_sat0 WHERE end_datetime IS NULL) t ON a.hashkey = t.hashkey "
    "UNION ALL SELECT * FROM fx_sat0 WHERE end_datetime IS NOT NULL", ["fx_action", "fx_dq", "fx_sat0"])
cte("fx_log0",
    f"SELECT {q(tb.DAY1_BATCH)} AS etl_batch_id, 'STAGE' AS layer_name, upper(event_type) AS model_name, 'EVENTS' AS source_system, "
    "'SUCCESS' AS process_status, min(ts) AS start_timestamp, max(ts) AS end_timestamp, CAST(count(*) AS BIGINT) AS rows_processed, "
    "'' AS error_message, CAST(0 AS BIGINT) AS delta_inserted_rows, CAST(0 AS BIGINT) AS delta_updated_rows FROM events GROUP BY event_type")

RAW_TEXT = ("SELECT p_partkey, p_brand, repeat('.', CAST(p_size % 3 AS INTEGER)) || ' ' || p_name || repeat(' ', CAST(p_size % 4 AS INTEGER)) "
            "|| chr(9) || ' ' || p_brand || CASE WHEN p_size % 5 = 0 THEN '''s' ELSE '' END AS raw FROM part")


def n_rule(x: str) -> str:
    return f"upper(trim(regexp_replace(regexp_replace(trim({x}), '^\\.+', ''), ' +', ' ', 'g')))"


def w_rule(x: str) -> str:
    return f"upper(replace(trim(regexp_replace({x}, '[[:space:]]+', ' ', 'g')), '''', ''))"


LAST = "regexp_extract(trim(raw), '[^[:space:]]+$')"
oracle("clean_names",
       f"SELECT p_partkey, {n_rule('raw')} AS crm_name, {w_rule('raw')} AS market_name, "
       f"{w_rule('substr(raw, 1, greatest(length(raw) - 3, 0))')} AS brand_name, "
       f"CASE WHEN raw IS NULL OR trim(raw) = '' THEN NULL WHEN strpos(trim(raw), ' ') = 0 THEN NULL ELSE {LAST} END AS last_token, "
       f"{w_rule(f'CASE WHEN raw IS NULL OR trim(raw) = {chr(39)}{chr(39)} THEN NULL WHEN strpos(trim(raw), {chr(39)} {chr(39)}) = 0 THEN trim(raw) ELSE trim(left(trim(raw), length(trim(raw)) - length({LAST}) - 1)) END')} AS name_stripped "
       f"FROM ({RAW_TEXT})")
oracle("typed_null_conform", "SELECT * FROM fx_stg_supp", ["fx_stg_supp"])
EXT = "upper(substr(p_type, 1, 1)) || CASE WHEN p_size % 2 = 0 THEN '_' ELSE 'X' END || CAST(p_partkey AS VARCHAR)"
oracle("like_escape_filter",
       f"SELECT p_partkey, p_name, {EXT} AS ext_id, ({EXT}) LIKE 'S!_%' ESCAPE '!' AS esc_match, ({EXT}) LIKE 'S_%' AS wild_match, "
       "upper(p_type) IN ('SMALL', 'LARGE') AS in_list, "
       "(CASE WHEN p_size > 25 THEN NULL ELSE p_brand END) NOT IN ('Brand#1', 'Brand#2') AS not_in_list FROM part "
       "WHERE upper(trim(p_name)) NOT LIKE '%RING%' AND upper(trim(p_name)) NOT LIKE 'BLUE %' AND upper(trim(p_name)) NOT LIKE '%BOLT'")
oracle("placeholder_filter",
       "SELECT c_custkey, segment FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '-' WHEN c_custkey % 9 = 1 THEN '  ' "
       "WHEN c_custkey % 9 = 2 THEN NULL ELSE c_mktsegment END AS segment FROM customer) "
       "WHERE segment IS NOT NULL AND trim(segment) NOT IN ('', '-')")
oracle("try_dates",
       "SELECT o_orderkey, txt, try_cast(trim(txt) AS DATE) AS d FROM (SELECT o_orderkey, "
       "CASE WHEN o_orderkey % 5 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-13-01' WHEN o_orderkey % 5 = 1 THEN '' "
       "WHEN o_orderkey % 5 = 2 THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' ' "
       "ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS txt FROM orders)")
oracle("hashdiff_entity", "SELECT * FROM fx_ident", ["fx_ident"])

oracle("latest_per_key",
       "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
       "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1")
oracle("dedupe_versions",
       "SELECT hashkey, hashdiff, o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM (SELECT *, row_number() OVER ("
       "PARTITION BY hashkey, hashdiff ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM ("
       f"SELECT *, {md5_of(['o_custkey'])} AS hashkey, {md5_of(['o_custkey', 'o_orderstatus'])} AS hashdiff FROM orders)) WHERE rn = 1")
oracle("parent_lookup",
       "SELECT c.c_custkey, c.c_custkey % 100 AS parent_ref, p.c_name AS parent_c_name FROM customer c "
       "LEFT JOIN customer p ON c.c_custkey % 100 = p.c_custkey")
oracle("latest_parent_lookup",
       "SELECT c.c_custkey, p.o_orderkey AS parent_o_orderkey, p.o_orderstatus AS parent_o_orderstatus FROM customer c LEFT JOIN ("
       "SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey "
       "ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM orders) WHERE rn = 1) p ON c.c_custkey = p.o_custkey")
oracle("multi_key_lookup",
       "SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
       "AND upper(trim(n.n_name)) = upper(trim('nation_' || CAST(c.c_nationkey AS VARCHAR))) AND n.n_regionkey <> 4")
oracle("substance_list",
       "SELECT l_partkey, array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR))), '|') AS substance "
       "FROM lineitem GROUP BY l_partkey")
oracle("union_distinct", "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT s_suppkey FROM supplier")
oracle("union_sources", "SELECT * FROM fx_sources", ["fx_sources"])
oracle("multi_label",
       "SELECT DISTINCT p_partkey, p_name, 'SMALL' AS label FROM part WHERE upper(p_type) = 'SMALL' UNION ALL "
       "SELECT DISTINCT p_partkey, p_name, 'BIG' FROM part WHERE p_size > 40 UNION ALL "
       "SELECT DISTINCT p_partkey, p_name, 'CHEAP' FROM part WHERE p_retailprice < 1000 UNION ALL "
       "SELECT DISTINCT p_partkey, p_name, 'BRAND1X' FROM part WHERE p_brand LIKE 'Brand#1%'")

oracle("country_semi",
       "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "WHERE upper(trim(n_name)) IN (SELECT iso2_code FROM fx_country)", ["fx_country"])
oracle("reject_rows", "SELECT * FROM fx_reject", ["fx_reject"])
oracle("reject_key_new_only",
       "SELECT * FROM fx_reject r WHERE NOT EXISTS (SELECT 1 FROM fx_reject s WHERE s.error_code = 'EMPTY_COUNTRY_CODE' "
       "AND s.reject_key = r.reject_key)", ["fx_reject"])
oracle("exclude_rejects",
       "SELECT dataset_product_id, hashkey, hashdiff FROM fx_stg s WHERE NOT EXISTS (SELECT 1 FROM fx_reject r "
       "WHERE r.dataset_product_id = upper(trim(s.dataset_product_id)))", ["fx_stg", "fx_reject"])
oracle("exclude_rejects_both_ends",
       "SELECT parent_dataset_product_id, child_dataset_product_id, hashkey FROM fx_rel s "
       "WHERE NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(s.parent_dataset_product_id))) "
       "AND NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(s.child_dataset_product_id)))",
       ["fx_rel", "fx_reject"])

oracle("dq_passed", "SELECT dataset_product_id, hashkey, hashdiff, source_lastmodifieddate FROM fx_dq_wm", ["fx_dq_wm"])
oracle("watermark_filter",
       "SELECT event_id, ts FROM events WHERE ts >= (SELECT coalesce(max(watermark_value) - INTERVAL 5 MINUTE, "
       f"{FLOOR}) FROM fx_ewm0 WHERE source_system = 'EVENTS' AND source_object = 'EVENTS' AND upper(watermark_column) = 'TS')",
       ["fx_ewm0"])
oracle("delta_rows",
       "SELECT s.dataset_product_id, s.hashkey, s.hashdiff FROM fx_dq s WHERE NOT EXISTS (SELECT 1 FROM fx_sat0 t "
       "WHERE t.hashkey = s.hashkey AND t.hashdiff = s.hashdiff AND t.end_datetime IS NULL)", ["fx_dq", "fx_sat0"])
oracle("delta_metrics", "SELECT * FROM fx_metrics", ["fx_metrics"])
oracle("hub_upsert",
       f"SELECT * FROM fx_hub0 UNION ALL SELECT DISTINCT a.hashkey, {RUN} AS start_datetime, {RUN} AS load_datetime, "
       f"'CRM' AS record_source, {q(tb.DAY2_BATCH)} AS etl_batch_id, 'PRODUCT' AS origin_stg FROM fx_action a "
       "WHERE a.action IN ('NEW','CHANGED') AND NOT EXISTS (SELECT 1 FROM fx_hub0 h WHERE h.hashkey = a.hashkey)",
       ["fx_hub0", "fx_action"])
oracle("sat_touch",
       f"SELECT t.hashkey, t.hashdiff, CASE WHEN EXISTS (SELECT 1 FROM fx_dq s WHERE s.hashkey = t.hashkey AND s.hashdiff = t.hashdiff) "
       f"THEN {RUN} ELSE t.updated_datetime END AS updated_datetime, t.etl_batch_id FROM fx_sat0 t WHERE t.end_datetime IS NULL",
       ["fx_dq", "fx_sat0"])
oracle("archive_changed",
       "SELECT hashkey, hashdiff, start_datetime, end_datetime, etl_batch_id, product_name FROM fx_hist0 UNION ALL "
       f"SELECT t.hashkey, t.hashdiff, t.start_datetime, {RUN} AS end_datetime, t.etl_batch_id, t.product_name "
       "FROM fx_sat0 t JOIN fx_dq s ON s.hashkey = t.hashkey WHERE t.end_datetime IS NULL AND s.hashdiff <> t.hashdiff "
       "AND NOT EXISTS (SELECT 1 FROM fx_hist0 h WHERE h.hashdiff = t.hashdiff)", ["fx_hist0", "fx_sat0", "fx_dq"])
oracle("sat_merge", "SELECT * FROM fx_sat1", ["fx_sat1"])
oracle("watermark_upsert",
       "WITH wm AS (SELECT * FROM fx_wm0 UNION ALL SELECT * FROM fx_ewm0), "
       "src AS (SELECT max(source_lastmodifieddate) AS v FROM fx_dq_wm) "
       f"SELECT source_system, source_object, watermark_column, "
       "CASE WHEN source_system = 'CRM' AND source_object = " + q(tb.STAGING_MODEL) + " AND watermark_column = 'SOURCE_LASTMODIFIEDDATE' "
       "AND (SELECT v FROM src) IS NOT NULL AND (watermark_value IS NULL OR (SELECT v FROM src) > watermark_value) THEN (SELECT v FROM src) ELSE watermark_value END AS watermark_value, "
       "CASE WHEN source_system = 'CRM' AND source_object = " + q(tb.STAGING_MODEL) + " AND watermark_column = 'SOURCE_LASTMODIFIEDDATE' "
       f"AND (SELECT v FROM src) IS NOT NULL AND (watermark_value IS NULL OR (SELECT v FROM src) > watermark_value) THEN {RUN} ELSE updated_at END AS updated_at, "
       "CASE WHEN source_system = 'CRM' AND source_object = " + q(tb.STAGING_MODEL) + " AND watermark_column = 'SOURCE_LASTMODIFIEDDATE' "
       f"AND (SELECT v FROM src) IS NOT NULL AND (watermark_value IS NULL OR (SELECT v FROM src) > watermark_value) THEN {q(tb.DAY2_BATCH)} ELSE etl_batch_id END AS etl_batch_id "
       "FROM wm", ["fx_wm0", "fx_ewm0", "fx_dq_wm"])

HUB_CAND = (
    f"SELECT DISTINCT hashkey, {RUN} AS start_datetime, {RUN} AS load_datetime, record_source, etl_batch_id, 'PRODUCT' AS origin_stg "
    "FROM fx_sources s WHERE NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(s.dataset_product_id))) "
    f"UNION ALL SELECT DISTINCT hashkey, {RUN}, {RUN}, record_source, etl_batch_id, 'IDENTIFIER' FROM fx_ident "
    f"UNION ALL SELECT DISTINCT hashkey, {RUN}, {RUN}, record_source, etl_batch_id, 'RELATIONSHIP' FROM fx_rel"
)
oracle("hub_full",
       "SELECT hashkey, start_datetime, load_datetime, record_source, etl_batch_id, origin_stg FROM ("
       "SELECT *, row_number() OVER (PARTITION BY hashkey ORDER BY CASE origin_stg WHEN 'PRODUCT' THEN 0 WHEN 'IDENTIFIER' THEN 1 ELSE 2 END, "
       f"record_source NULLS LAST, etl_batch_id NULLS LAST) AS rn FROM ({HUB_CAND})) c WHERE rn = 1 "
       "AND NOT EXISTS (SELECT 1 FROM fx_hub0 h WHERE h.hashkey = c.hashkey)",
       ["fx_sources", "fx_reject", "fx_ident", "fx_rel", "fx_hub0"])
SAT_ROWS = (
    f"SELECT hashkey, hashdiff, {RUN} AS start_datetime, {RUN} AS load_datetime, CAST(NULL AS TIMESTAMP) AS end_datetime, "
    f"{RUN} AS updated_datetime, etl_batch_id, record_source, {', '.join(PRODUCT.columns)} FROM ("
    "SELECT *, row_number() OVER (PARTITION BY hashkey ORDER BY load_datetime DESC NULLS LAST, hashdiff DESC NULLS LAST) AS rn "
    "FROM fx_stg s WHERE NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(s.dataset_product_id)))) WHERE rn = 1"
)
oracle("sat_incremental",
       f"WITH rows AS ({SAT_ROWS}), ch AS (SELECT r.* FROM rows r LEFT JOIN fx_sat0 c ON c.hashkey = r.hashkey "
       "WHERE c.hashkey IS NULL OR c.hashdiff <> r.hashdiff) "
       "SELECT * FROM fx_sat0 t WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.hashkey = t.hashkey) UNION ALL SELECT * FROM ch",
       ["fx_stg", "fx_reject", "fx_sat0"])
oracle("hist_incremental",
       f"SELECT {', '.join(c for c in HIST_COLS if c != 'end_datetime')}, {RUN} AS end_datetime FROM fx_sat0 t "
       "WHERE EXISTS (SELECT 1 FROM fx_stg i WHERE i.hashkey = t.hashkey AND i.hashdiff <> t.hashdiff "
       "AND NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(i.dataset_product_id)))) "
       "AND NOT EXISTS (SELECT 1 FROM fx_hist0 h WHERE h.hashdiff = t.hashdiff)", ["fx_sat0", "fx_stg", "fx_hist0", "fx_reject"])
STG_COLS = list(PRODUCT.columns) + ["source_lastmodifieddate", "hashkey", "hashdiff", "load_datetime", "etl_batch_id", "record_source"]
oracle("snapshot_batch",
       f"WITH snap0 AS (SELECT {DAY1} AS captured_at, * FROM fx_day1), "
       f"new AS (SELECT captured_at, {', '.join(STG_COLS)} FROM (SELECT {RUN} AS captured_at, s.*, row_number() OVER ("
       "PARTITION BY etl_batch_id, hashkey, hashdiff ORDER BY source_lastmodifieddate DESC NULLS LAST, load_datetime DESC NULLS LAST) AS rn "
       "FROM fx_stg s WHERE NOT EXISTS (SELECT 1 FROM fx_reject r WHERE r.dataset_product_id = upper(trim(s.dataset_product_id)))) WHERE rn = 1) "
       f"SELECT captured_at, {', '.join(STG_COLS)} FROM snap0 o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.etl_batch_id = o.etl_batch_id "
       "AND n.hashkey = o.hashkey AND n.hashdiff = o.hashdiff) UNION ALL SELECT * FROM new",
       ["fx_day1", "fx_stg", "fx_reject"])
oracle("mart_current_batch",
       f"SELECT {', '.join(PRODUCT.columns)} FROM fx_sat1 WHERE end_datetime IS NULL AND etl_batch_id = {q(tb.DAY2_BATCH)}", ["fx_sat1"])

LAYER_CASE = ("CASE event_id % 8 WHEN 0 THEN 'stg' WHEN 1 THEN 'DQ' WHEN 2 THEN ' delta ' WHEN 3 THEN 'dm' WHEN 4 THEN 'Hub' "
              "WHEN 5 THEN 'sat' WHEN 6 THEN 'hist' ELSE 'raw' END")
MODEL_RAW = ("CASE WHEN event_id % 97 = 0 THEN NULL ELSE (CASE WHEN event_id % 3 = 0 THEN lower(' sat_' || event_type) "
             "ELSE 'STG_' || upper(event_type) END) || CASE user_id % 5 WHEN 0 THEN '_VEEVA_CRM' WHEN 1 THEN '_VEEVA' "
             "WHEN 2 THEN '_PRODUCT_FILE' WHEN 3 THEN '_VEEVA_PRODUCT_FILE' ELSE '' END END")
oracle("audit_std_names",
       "SELECT event_id, CASE lower(trim(coalesce(l, 'UNKNOWN'))) WHEN 'stg' THEN 'STAGE' WHEN 'dq' THEN 'DQ' WHEN 'delta' THEN 'DELTA' "
       "WHEN 'dm' THEN 'DM' WHEN 'hub' THEN 'HUB' WHEN 'sat' THEN 'SAT' WHEN 'hist' THEN 'HIST' ELSE upper(lower(trim(coalesce(l, 'UNKNOWN')))) END AS layer_name, "
       "CASE WHEN m2 LIKE '%\\_PRODUCT\\_FILE' ESCAPE '\\' THEN left(m2, length(m2) - 13) || '_PRODUCT' ELSE m2 END AS model_name FROM ("
       "SELECT *, CASE WHEN m1 LIKE '%\\_VEEVA' ESCAPE '\\' THEN left(m1, length(m1) - 6) ELSE m1 END AS m2 FROM ("
       "SELECT *, CASE WHEN m0 LIKE '%\\_VEEVA\\_CRM' ESCAPE '\\' THEN left(m0, length(m0) - 10) ELSE m0 END AS m1 FROM ("
       f"SELECT event_id, {LAYER_CASE} AS l, upper(trim(coalesce({MODEL_RAW}, 'UNKNOWN'))) AS m0 FROM events))) ")
oracle("process_log_upsert",
       "SELECT etl_batch_id, layer_name, model_name, source_system, "
       "CASE WHEN etl_batch_id = " + q(tb.DAY1_BATCH) + " AND model_name = 'CLICK' THEN 'RUNNING' ELSE process_status END AS process_status, "
       "start_timestamp, CASE WHEN etl_batch_id = " + q(tb.DAY1_BATCH) + " AND model_name = 'CLICK' THEN NULL ELSE end_timestamp END AS end_timestamp, "
       "CASE WHEN etl_batch_id = " + q(tb.DAY1_BATCH) + " AND model_name = 'CLICK' THEN 0 ELSE rows_processed END AS rows_processed, "
       "error_message, delta_inserted_rows, delta_updated_rows FROM fx_log0 "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'DELTA', 'SAT_PRODUCT', 'CRM', 'SUCCESS', {RUN}, {RUN}, rows_processed, '', "
       "delta_inserted_rows, delta_updated_rows FROM fx_metrics", ["fx_log0", "fx_metrics"])
oracle("batch_control",
       "SELECT 'B_' || upper(event_type) AS etl_batch_id, 'EVENTS' AS pipeline_name, CAST(0 AS BIGINT) AS total_rejected_records, "
       "min(ts) AS start_timestamp, max(ts) AS end_timestamp, 'SUCCESS' AS process_status, '' AS error_message FROM events GROUP BY event_type "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'VAULT', (SELECT count(*) FROM fx_reject), {RUN}, {RUN}, 'SUCCESS', ''",
       ["fx_reject"])
oracle("load_efficiency",
       "SELECT model_name, start_timestamp, end_timestamp, datediff('second', start_timestamp, end_timestamp) AS runtime_seconds, "
       "rows_processed, delta_inserted_rows, delta_updated_rows, CASE WHEN datediff('second', start_timestamp, end_timestamp) > 0 "
       "THEN rows_processed / datediff('second', start_timestamp, end_timestamp) END AS rows_per_second FROM fx_log0 "
       "ORDER BY start_timestamp DESC", ["fx_log0"])
oracle("relationship_edges", "SELECT * FROM fx_rel", ["fx_rel"])
SYNC_COLS = list(SAT_META) + list(PRODUCT.columns)
oracle("schema_sync",
       f"SELECT {', '.join(SYNC_COLS)} FROM fx_sat0 UNION ALL SELECT hashkey, hashdiff, {RUN}, {RUN}, CAST(NULL AS TIMESTAMP), {RUN}, "
       f"etl_batch_id, record_source, {', '.join(PRODUCT.columns)} FROM fx_dq", ["fx_sat0", "fx_dq"])


# --- staging pipelines over the adapters ---------------------------------------------------------
from vaultkit.plans.oracle_values import LABELS as K  # noqa: E402
from vaultkit.plans.oracle_values import PRODUCT_DIFF_CRM  # noqa: E402

AREAS = ", ".join(q(a) for a in K.THERAPY_AREAS)


def n_sql(x: str) -> str:
    return f"upper(trim(regexp_replace(regexp_replace(trim({x}), '^\\.+', ''), ' +', ' ', 'g')))"


cte("crm_src",
    "SELECT p_partkey % 4 AS region, "
    "CASE WHEN p_partkey % 31 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN lower(n_name) ELSE n_name END AS country_code_bi__c, "
    "'P' || CAST(p_partkey AS VARCHAR) AS id, "
    "CASE WHEN p_partkey % 53 = 0 THEN 'Neurology' WHEN p_partkey % 37 = 0 THEN 'BI ' || p_name "
    "WHEN p_partkey % 41 = 0 THEN p_name || ' delete' WHEN p_size % 9 = 0 THEN '..' || p_name || '   x' ELSE p_name END AS name, "
    "CASE WHEN p_size % 2 = 0 THEN concat_ws(' ', p_type, p_brand) END AS description_vod__c, "
    "CASE p_partkey % 6 WHEN 0 THEN 'B_' || CAST(p_partkey AS VARCHAR) WHEN 1 THEN 'BX' || CAST(p_partkey AS VARCHAR) "
    "WHEN 2 THEN 'GB_' || CAST(p_partkey AS VARCHAR) WHEN 3 THEN '10' || CAST(p_partkey AS VARCHAR) "
    "WHEN 4 THEN 'X-SAMPLE-' || CAST(p_partkey AS VARCHAR) END AS external_id_vod__c, "
    "CASE p_type WHEN 'ECONOMY' THEN 'Detail' WHEN 'LARGE' THEN 'BRC' WHEN 'MEDIUM' THEN 'Form' WHEN 'PROMO' THEN 'Sample' "
    "WHEN 'STANDARD' THEN '' END AS product_type_vod__c, 'Y' AS active_bi__c, CAST(NULL AS VARCHAR) AS therapeutic_area_vod__c, "
    "CASE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 6 WHEN 0 THEN 'Local Brand' WHEN 1 THEN 'GLOBAL BRAND' "
    "WHEN 2 THEN 'Indication' WHEN 3 THEN 'MEDICAL SEGMENT' WHEN 4 THEN '' END AS mdm_product_type_bi__c, "
    "p_retailprice >= 990 AS isdeleted, "
    "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'P' || CAST(p_partkey % 97 AS VARCHAR) END AS parent_product_vod__c, "
    "m.lastmodifieddate, p_partkey AS k "
    "FROM part JOIN nation ON p_partkey % 25 = n_nationkey "
    "LEFT JOIN (SELECT l_partkey, max(l_shipdate) AS lastmodifieddate FROM lineitem GROUP BY l_partkey) m ON p_partkey = m.l_partkey")
cte("crm_all",
    "SELECT * EXCLUDE (k) FROM crm_src UNION ALL "
    "SELECT * EXCLUDE (k) REPLACE (name || ' old' AS name, lastmodifieddate - INTERVAL 30 DAY AS lastmodifieddate) "
    "FROM crm_src WHERE k % 19 = 0", ["crm_src"])
cte("crm_dim", "SELECT ' ' || n_name AS iso2_code FROM nation WHERE n_regionkey <> 4")
CRM_RAW = []
CRM_LATEST = []
for _i in range(4):
    cte(f"crm_raw{_i}",
        f"SELECT c.* EXCLUDE (region), p.name AS parent_name FROM (SELECT * FROM crm_all WHERE region = {_i}) c "
        f"LEFT JOIN (SELECT id, name FROM crm_all WHERE region = {_i}) p ON c.parent_product_vod__c = p.id", ["crm_all"])
    cte(f"crm_lat{_i}",
        f"SELECT c.* EXCLUDE (region), p.name AS parent_name, p.lastmodifieddate AS parent_lastmodifieddate "
        f"FROM (SELECT * FROM crm_all WHERE region = {_i}) c LEFT JOIN (SELECT id, name, lastmodifieddate FROM ("
        f"SELECT id, name, lastmodifieddate, row_number() OVER (PARTITION BY id ORDER BY lastmodifieddate DESC NULLS LAST, "
        f"name DESC NULLS LAST) AS rn FROM crm_all WHERE region = {_i}) WHERE rn = 1) p ON c.parent_product_vod__c = p.id",
        ["crm_all"])
    CRM_RAW.append(f"crm_raw{_i}")
    CRM_LATEST.append(f"crm_lat{_i}")


def brand_sql(exclusions: bool) -> str:
    s = ("upper(product_type_vod__c) = 'DETAIL' AND (upper(mdm_product_type_bi__c) IN ('LOCAL BRAND', 'GLOBAL BRAND') "
         "OR external_id_vod__c LIKE 'B!_%' ESCAPE '!')")
    if exclusions:
        s += f" AND upper(mdm_product_type_bi__c) NOT IN ('MEDICAL SEGMENT', 'INDICATION') AND upper(name) NOT IN ({AREAS})"
    return s


IND_SQL = ("(upper(mdm_product_type_bi__c) = 'INDICATION' OR (upper(product_type_vod__c) = 'DETAIL' AND "
           "(mdm_product_type_bi__c = '' OR mdm_product_type_bi__c IS NULL) AND country_code_bi__c = 'GB' AND "
           "external_id_vod__c LIKE 'GB!_%' ESCAPE '!') OR ((upper(product_type_vod__c) = '' OR product_type_vod__c IS NULL) "
           "AND (mdm_product_type_bi__c = '' OR mdm_product_type_bi__c IS NULL) AND external_id_vod__c LIKE '10_%'))")
PMP_SQL = ("(upper(product_type_vod__c) IN ('FORM', 'ORDER', 'SAMPLE', 'SAMPLE PRODUCT GROUP') OR "
           "(upper(product_type_vod__c) = 'BRC' AND country_code_bi__c <> 'CH') OR "
           "(upper(product_type_vod__c) = 'BRC' AND country_code_bi__c = 'CH' AND external_id_vod__c LIKE '%SAMPLE%'))")
TA_SQL = f"(upper(mdm_product_type_bi__c) = 'MEDICAL SEGMENT' OR upper(name) IN ({AREAS}))"


def labelled(src: str, exclusions: bool) -> str:
    parts = [(K.BRAND, brand_sql(exclusions)), (K.IND, IND_SQL), (K.PMP, PMP_SQL), (K.TA, TA_SQL)]
    return " UNION ALL ".join(
        f"SELECT DISTINCT *, '{lab}' AS product_type_code FROM {src} WHERE isdeleted = false AND ({rule})" for lab, rule in parts)


KEEP_SQL = ("country_code_bi__c IS NOT NULL AND trim(country_code_bi__c) <> '' AND id IS NOT NULL AND trim(id) <> '' "
            "AND name IS NOT NULL AND trim(name) <> '' AND "
            + " AND ".join(f"upper(trim(name)) NOT LIKE {q(p)}" for p in K.NAME_DENY_PATTERNS)
            + " AND upper(trim(country_code_bi__c)) IN (SELECT upper(trim(iso2_code)) FROM crm_dim)")

cte("crm_pu", " UNION ".join(f"SELECT * FROM {r}" for r in CRM_RAW), CRM_RAW)
cte("crm_pkept", f"SELECT * FROM ({labelled('crm_pu', True)}) WHERE {KEEP_SQL}", ["crm_pu", "crm_dim"])
cte("crm_ptx",
    f"SELECT upper(trim(country_code_bi__c)) AS geographic_id, 'CRM' AS dataset_id, {q(K.CRM_SOURCE)} AS source_dataset_id, "
    f"id AS dataset_product_id, product_type_code, {n_sql('name')} AS product_name, {n_sql('name')} AS standardized_product_name, "
    f"{n_sql('coalesce(description_vod__c, name)')} AS description, CASE WHEN product_type_code = 'PMP' THEN {n_sql('parent_name')} "
    f"WHEN product_type_code = 'BRAND' THEN {n_sql('name')} END AS brand_name, 'N' AS competitor_indicator, "
    "CAST(lastmodifieddate AS TIMESTAMP) AS source_lastmodifieddate FROM crm_pkept", ["crm_pkept"])
cte("crm_pstaged", staged("crm_ptx", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code",
                                      "product_name", "standardized_product_name", "description", "brand_name",
                                      "competitor_indicator"}, PRODUCT.with_diff(PRODUCT_DIFF_CRM), tb.DAY2_BATCH, RUN, K.CRM_SOURCE),
    ["crm_ptx"])
oracle("crm_products",
       "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY hashkey, hashdiff ORDER BY "
       "source_lastmodifieddate DESC NULLS LAST) AS rn FROM crm_pstaged) WHERE rn = 1", ["crm_pstaged"])

cte("crm_lu", " UNION ALL ".join(f"SELECT * FROM {r}" for r in CRM_LATEST), CRM_LATEST)
cte("crm_ikept", f"SELECT * FROM ({labelled('crm_lu', True)}) WHERE {KEEP_SQL}", ["crm_lu", "crm_dim"])
cte("crm_itx",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY geographic_id, dataset_product_id, identifier_id "
    "ORDER BY source_lastmodifieddate DESC NULLS LAST) AS rn FROM (SELECT DISTINCT upper(trim(country_code_bi__c)) AS geographic_id, "
    f"{q(K.CRM_SOURCE)} AS dataset_id, trim(id) AS dataset_product_id, {q(K.CRM_SOURCE)} AS identifier_type_code, "
    "upper(trim(country_code_bi__c)) || '_' || trim(id) AS identifier_id, CAST(NULL AS VARCHAR) AS status_code, "
    "CAST(NULL AS DATE) AS effective_date, CAST(NULL AS DATE) AS end_date, CAST(lastmodifieddate AS TIMESTAMP) AS source_lastmodifieddate "
    "FROM crm_ikept)) WHERE rn = 1", ["crm_ikept"])
oracle("crm_identifiers", "SELECT * FROM (" + staged("crm_itx", set(IDENTIFIER.columns), IDENTIFIER, tb.DAY2_BATCH, RUN, K.CRM_SOURCE) + ")",
       ["crm_itx"])

cte("crm_rkept", f"SELECT * FROM ({labelled('crm_lu', False)}) WHERE {KEEP_SQL}", ["crm_lu", "crm_dim"])
cte("crm_nodes",
    "SELECT upper(trim(country_code_bi__c)) AS geographic_id, id AS dataset_product_id, parent_product_vod__c AS parent_product_id, "
    f"greatest(coalesce(CAST(lastmodifieddate AS TIMESTAMP), {FLOOR}), coalesce(CAST(parent_lastmodifieddate AS TIMESTAMP), {FLOOR})) AS m, "
    "upper(mdm_product_type_bi__c) = 'GLOBAL BRAND' AS is_global, upper(mdm_product_type_bi__c) = 'LOCAL BRAND' AS is_local, "
    "upper(mdm_product_type_bi__c) IN ('LOCAL BRAND', 'GLOBAL BRAND') AS is_brand, product_type_code = 'PMP' AS is_pmp, "
    f"isdeleted = false AND {TA_SQL} AS is_ta, isdeleted = false AND {IND_SQL} AS is_ind FROM crm_rkept", ["crm_rkept"])
for _n in ("global", "ta"):
    cte(f"crm_n_{_n}", f"SELECT geographic_id, dataset_product_id, max(m) AS mod FROM crm_nodes WHERE is_{_n} GROUP BY 1, 2", ["crm_nodes"])
for _n in ("local", "brand", "pmp", "ind"):
    cte(f"crm_n_{_n}", f"SELECT geographic_id, dataset_product_id, parent_product_id, max(m) AS mod FROM crm_nodes WHERE is_{_n} GROUP BY 1, 2, 3",
        ["crm_nodes"])


def edge_sql(child: str, parent: str, kind: str) -> str:
    return (f"SELECT DISTINCT p.geographic_id AS parent_geographic_id, c.geographic_id AS child_geographic_id, "
            f"{q(K.CRM_SOURCE)} AS parent_dataset_id, {q(K.CRM_SOURCE)} AS child_dataset_id, p.dataset_product_id AS parent_dataset_product_id, "
            f"c.dataset_product_id AS child_dataset_product_id, {q(kind)} AS relationship_type_code, CAST(NULL AS VARCHAR) AS status_code, "
            "CAST(NULL AS DATE) AS effective_date, CAST(NULL AS DATE) AS end_date, greatest(p.mod, c.mod) AS source_lastmodifieddate "
            f"FROM crm_n_{child} c JOIN crm_n_{parent} p ON c.parent_product_id = p.dataset_product_id")


cte("crm_edges", " UNION ALL ".join([edge_sql("local", "global", K.GLOBAL_ROLLUP), edge_sql("pmp", "brand", K.PMP_TO_BRAND),
                                     edge_sql("brand", "ta", K.BRAND_TO_TA), edge_sql("ind", "brand", K.BRANDIND_TO_BRAND)]),
    [f"crm_n_{x}" for x in ("global", "ta", "local", "brand", "pmp", "ind")])
oracle("crm_relationships", "SELECT * FROM (" + staged("crm_edges", set(RELATIONSHIP.columns), RELATIONSHIP, tb.DAY2_BATCH, RUN, K.CRM_SOURCE) + ")",
       ["crm_edges"])

cte("cat_src",
    "SELECT CASE WHEN p_partkey % 29 = 0 THEN ' ' ELSE ' c' || CAST(p_partkey AS VARCHAR) END AS clave, "
    "CASE WHEN p_partkey % 23 = 0 THEN '-' ELSE p_name END AS nombre, p_type AS forma_farma, "
    "CAST(p_size AS VARCHAR) || ' mg' AS concentracion, "
    "CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '-' ELSE p_brand END AS presentacion, p_partkey AS k FROM part")
cte("cat_claves", "SELECT * EXCLUDE (k) FROM cat_src UNION ALL SELECT * EXCLUDE (k) FROM cat_src WHERE k % 17 = 0", ["cat_src"])
cte("cat_ok",
    "SELECT * FROM cat_claves WHERE clave IS NOT NULL AND trim(clave) <> '' AND nombre IS NOT NULL AND trim(nombre) NOT IN ('', '-') "
    "AND forma_farma IS NOT NULL AND trim(forma_farma) NOT IN ('', '-') AND concentracion IS NOT NULL AND trim(concentracion) NOT IN ('', '-')",
    ["cat_claves"])
cte("cat_ptx",
    "SELECT 'MX' AS geographic_id, 'GOB360_PM' AS dataset_id, 'GOB360_PM' AS source_dataset_id, upper(trim(clave)) AS dataset_product_id, "
    "'PMP' AS product_type_code, upper(trim(concat_ws(' ', trim(nombre), trim(forma_farma), trim(concentracion), nullif(trim(presentacion), '-')))) AS product_name, "
    "upper(trim(concat_ws(' ', trim(nombre), trim(forma_farma), trim(concentracion), nullif(trim(presentacion), '-')))) AS description, "
    f"'A' AS product_status_code, upper(trim(trim(nombre))) AS substance, {RUN} AS source_lastmodifieddate FROM cat_ok", ["cat_ok"])
oracle("catalogue_products", "SELECT * FROM (" + staged("cat_ptx", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id",
                                                                   "product_type_code", "product_name", "description", "product_status_code",
                                                                   "substance"}, PRODUCT, tb.DAY2_BATCH, RUN, K.CATALOGUE_SOURCE) + ")", ["cat_ptx"])
cte("cat_itx",
    "SELECT 'MX' AS geographic_id, 'GOB360_PM' AS dataset_id, upper(trim(clave)) AS dataset_product_id, 'GOB360_PM' AS identifier_type_code, "
    f"'MX_' || upper(trim(clave)) AS identifier_id, {RUN} AS source_lastmodifieddate FROM cat_ok", ["cat_ok"])
oracle("catalogue_identifiers", "SELECT * FROM (" + staged("cat_itx", {"geographic_id", "dataset_id", "dataset_product_id", "identifier_type_code",
                                                                      "identifier_id"}, IDENTIFIER, tb.DAY2_BATCH, RUN, K.CATALOGUE_SOURCE) + ")",
       ["cat_itx"])
cte("cat_rtx",
    "SELECT 'MX' AS parent_geographic_id, 'MX' AS child_geographic_id, 'GOB360_PM' AS parent_dataset_id, 'GOB360_PM' AS child_dataset_id, "
    "CAST(NULL AS VARCHAR) AS parent_dataset_product_id, upper(trim(clave)) AS child_dataset_product_id, 'PMPtoBRAND' AS relationship_type_code, "
    f"{RUN} AS source_lastmodifieddate FROM cat_claves WHERE clave IS NOT NULL AND trim(clave) <> '' AND nombre IS NOT NULL AND trim(nombre) <> ''",
    ["cat_claves"])
oracle("catalogue_relationships", "SELECT * FROM (" + staged("cat_rtx", {"parent_geographic_id", "child_geographic_id", "parent_dataset_id",
                                                                        "child_dataset_id", "parent_dataset_product_id", "child_dataset_product_id",
                                                                        "relationship_type_code"}, RELATIONSHIP, tb.DAY2_BATCH, RUN, K.CATALOGUE_SOURCE) + ")",
       ["cat_rtx"])


# --- market ------------------------------------------------------------------------------------
def w_sql(x: str) -> str:
    return f"upper(replace(trim(regexp_replace({x}, '[[:space:]]+', ' ', 'g')), '''', ''))"


def cut3(x: str) -> str:
    return f"substr({x}, 1, greatest(length({x}) - 3, 0))"


def strip_last_sql(x: str) -> str:
    t = f"trim({x})"
    last = f"regexp_extract({t}, '[^[:space:]]+$')"
    return (f"CASE WHEN {x} IS NULL OR {t} = '' THEN NULL WHEN strpos({t}, ' ') = 0 THEN {t} "
            f"ELSE trim(left({t}, length({t}) - length({last}) - 1)) END")


def latest_sql(*cols: str) -> str:
    return "greatest(" + ", ".join(f"coalesce(CAST({c} AS TIMESTAMP), {FLOOR})" for c in cols) + ")"


OWNER = "'%AMER%'"
cte("pmod", "SELECT l_partkey, max(l_shipdate) AS lastmodifieddate FROM lineitem GROUP BY l_partkey")
cte("mkt_marcas",
    "SELECT n_name AS country, CAST(s_suppkey AS VARCHAR) AS codigo, CASE WHEN s_suppkey % 7 = 0 THEN s_name || '''s  x' ELSE s_name END AS nome, "
    "CAST(s_nationkey AS VARCHAR) AS siglalab, CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1 END AS curr_flg, m.last_updt_dt "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "LEFT JOIN (SELECT l_suppkey, max(l_shipdate) AS last_updt_dt FROM lineitem GROUP BY l_suppkey) m ON s_suppkey = m.l_suppkey")
cte("mkt_producto",
    "SELECT n_name AS country, CAST(p_partkey AS VARCHAR) AS codigo, CASE WHEN p_partkey % 13 = 0 THEN p_type WHEN p_partkey % 17 = 0 THEN '' "
    "ELSE concat_ws(' ', p_name, p_brand) END AS nome, CAST(p_partkey % 100 AS VARCHAR) AS marca, "
    "CASE WHEN p_size % 2 = 0 THEN 'G' ELSE 'B' END AS flg_classific, CASE p_size % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'P' END AS flg_etico, "
    "CAST(p_partkey % 25 AS VARCHAR) AS codigolab, CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE p_brand END AS codigoclasse, "
    "CASE WHEN p_partkey % 13 = 5 THEN 0 ELSE 1 END AS curr_flg, m.lastmodifieddate AS last_updt_dt "
    "FROM part JOIN nation ON p_partkey % 25 = n_nationkey LEFT JOIN pmod m ON p_partkey = m.l_partkey", ["pmod"])
cte("mkt_lab",
    "SELECT n_name AS country, CAST(n_nationkey AS VARCHAR) AS codigo, 'LAB' || CAST(n_regionkey AS VARCHAR) AS cdg, "
    "CAST(n_regionkey AS VARCHAR) AS cdgcorporacao, CASE WHEN n_nationkey % 6 = 5 THEN 0 ELSE 1 END AS curr_flg, "
    "CAST(NULL AS TIMESTAMP) AS last_updt_dt FROM nation")
cte("mkt_corp",
    "SELECT n_name AS country, CAST(n_regionkey AS VARCHAR) AS codigo, ' ' || r_name || ' corp' AS nome, CAST(n_nationkey AS VARCHAR) AS sigla, "
    "1 AS curr_flg, CAST(NULL AS TIMESTAMP) AS last_updt_dt FROM nation JOIN region ON n_regionkey = r_regionkey")
cte("mkt_li", "SELECT n_name AS country, l_partkey, l_suppkey FROM lineitem JOIN nation ON l_partkey % 25 = n_nationkey")
cte("mkt_mp", "SELECT country, CAST(l_partkey AS VARCHAR) AS cdgprod, CAST(l_suppkey % 40 AS VARCHAR) AS cdgmol, 1 AS curr_flg FROM mkt_li", ["mkt_li"])
cte("mkt_mol",
    "SELECT DISTINCT country, CAST(l_suppkey % 40 AS VARCHAR) AS codigomole, 'Mol  ' || ' x' || CAST(l_suppkey % 40 AS VARCHAR) AS nome, "
    "CASE WHEN l_suppkey % 40 = 39 THEN 0 ELSE 1 END AS curr_flg FROM mkt_li", ["mkt_li"])
cte("mkt_sub",
    "SELECT upper(trim(mp.country)) AS geographic_id, trim(mp.cdgprod) AS dataset_product_id, "
    "array_to_string(list_sort(list(DISTINCT trim(regexp_replace(mol.nome, '[[:space:]]+', ' ', 'g')))), '|') AS substance "
    "FROM mkt_mp mp JOIN mkt_mol mol ON mp.cdgmol = mol.codigomole AND mp.country = mol.country "
    "WHERE mp.curr_flg = 1 AND mol.curr_flg = 1 AND mp.cdgprod IS NOT NULL AND trim(mp.cdgprod) <> '' "
    "AND mol.nome IS NOT NULL AND trim(mol.nome) <> '' GROUP BY 1, 2", ["mkt_mp", "mkt_mol"])
cte("mkt_brand_rows",
    f"SELECT upper(trim(m.country)) AS geographic_id, 'BRAND_' || trim(m.codigo) AS dataset_product_id, 'BRAND' AS product_type_code, "
    f"{w_sql(cut3('m.nome'))} AS product_name, {w_sql(cut3('m.nome'))} AS brand_name, CAST(NULL AS VARCHAR) AS atc_code, "
    f"CASE WHEN upper(trim(c.nome)) LIKE {OWNER} THEN 'N' ELSE 'Y' END AS competitor_indicator, CAST(NULL AS VARCHAR) AS generic_indicator, "
    "CAST(NULL AS VARCHAR) AS prescription_required_indicator, CAST(NULL AS VARCHAR) AS substance, trim(lab.cdg) || trim(m.siglalab) AS manufacturer_id, "
    f"{latest_sql('m.last_updt_dt', 'c.last_updt_dt', 'lab.last_updt_dt')} AS source_lastmodifieddate "
    "FROM (SELECT * FROM mkt_marcas WHERE curr_flg = 1) m LEFT JOIN (SELECT * FROM mkt_corp WHERE curr_flg = 1) c "
    "ON m.siglalab = c.sigla AND m.country = c.country LEFT JOIN (SELECT * FROM mkt_lab WHERE curr_flg = 1) lab "
    "ON m.siglalab = lab.codigo AND m.country = lab.country", ["mkt_marcas", "mkt_corp", "mkt_lab"])
cte("mkt_mp_rows",
    f"SELECT upper(trim(p.country)) AS geographic_id, trim(p.codigo) AS dataset_product_id, 'MP' AS product_type_code, "
    f"{w_sql(strip_last_sql('p.nome'))} AS product_name, {w_sql(cut3('m.nome'))} AS brand_name, nullif(trim(p.codigoclasse), '') AS atc_code, "
    f"CASE WHEN upper(trim(corp.nome)) LIKE {OWNER} THEN 'N' ELSE 'Y' END AS competitor_indicator, "
    "CASE WHEN p.flg_classific = 'G' THEN 'Y' END AS generic_indicator, "
    "CASE WHEN p.flg_etico = 'E' THEN 'Y' WHEN p.flg_etico = 'P' THEN 'N' END AS prescription_required_indicator, s.substance, "
    f"trim(lab.cdg) || trim(p.codigolab) AS manufacturer_id, {latest_sql('p.last_updt_dt', 'm.last_updt_dt', 'lab.last_updt_dt', 'corp.last_updt_dt')} "
    "AS source_lastmodifieddate FROM (SELECT * FROM mkt_producto WHERE curr_flg = 1) p "
    "LEFT JOIN mkt_sub s ON s.dataset_product_id = trim(p.codigo) AND s.geographic_id = upper(trim(p.country)) "
    "LEFT JOIN (SELECT * FROM mkt_marcas WHERE curr_flg = 1) m ON p.marca = m.codigo AND p.country = m.country "
    "LEFT JOIN (SELECT * FROM mkt_lab WHERE curr_flg = 1) lab ON p.codigolab = lab.codigo AND p.country = lab.country "
    "LEFT JOIN (SELECT * FROM mkt_corp WHERE curr_flg = 1) corp ON lab.cdgcorporacao = corp.codigo AND lab.country = corp.country",
    ["mkt_producto", "mkt_sub", "mkt_marcas", "mkt_lab", "mkt_corp"])
cte("mkt_ptx",
    "SELECT *, 'PRESCRIPTIONDATA' AS dataset_id, 'CLOSEUP_MARKET' AS source_dataset_id, nullif(trim(product_name), '') AS description, "
    "'A' AS product_status_code FROM (SELECT * FROM mkt_brand_rows UNION ALL SELECT * FROM mkt_mp_rows)", ["mkt_brand_rows", "mkt_mp_rows"])
cte("mkt_pstaged", staged("mkt_ptx", {"geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code",
                                      "product_name", "brand_name", "atc_code", "competitor_indicator", "generic_indicator",
                                      "prescription_required_indicator", "substance", "manufacturer_id", "description",
                                      "product_status_code"}, PRODUCT, tb.DAY2_BATCH, RUN, K.MARKET_SOURCE), ["mkt_ptx"])
oracle("market_products",
       "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY hashkey, hashdiff ORDER BY "
       "source_lastmodifieddate DESC NULLS LAST) AS rn FROM mkt_pstaged) WHERE rn = 1", ["mkt_pstaged"])
cte("mkt_rtx",
    "SELECT b.geographic_id AS parent_geographic_id, p.p_geo AS child_geographic_id, 'CLOSEUP_MARKET' AS parent_dataset_id, "
    "'CLOSEUP_MARKET' AS child_dataset_id, 'BRAND_' || b.brand_code AS parent_dataset_product_id, p.product_code AS child_dataset_product_id, "
    f"'MPtoBRAND' AS relationship_type_code, {latest_sql('p.p_mod', 'b.b_mod')} AS source_lastmodifieddate "
    "FROM (SELECT upper(trim(country)) AS p_geo, trim(codigo) AS product_code, trim(marca) AS p_brand, last_updt_dt AS p_mod "
    "FROM mkt_producto WHERE curr_flg = 1) p JOIN (SELECT upper(trim(country)) AS geographic_id, trim(codigo) AS brand_code, "
    "last_updt_dt AS b_mod FROM mkt_marcas WHERE curr_flg = 1) b ON p.p_brand = b.brand_code AND p.p_geo = b.geographic_id",
    ["mkt_producto", "mkt_marcas"])
oracle("market_relationships", "SELECT * FROM (" + staged("mkt_rtx", {"parent_geographic_id", "child_geographic_id", "parent_dataset_id",
                                                                     "child_dataset_id", "parent_dataset_product_id", "child_dataset_product_id",
                                                                     "relationship_type_code"}, RELATIONSHIP, tb.DAY2_BATCH, RUN, K.MARKET_SOURCE) + ")",
       ["mkt_rtx"])

# --- legacy history ----------------------------------------------------------------------------
from vaultkit.plans.oracle_values import (  # noqa: E402
    INDICATORS, LEGACY_NULL_COLUMNS, PRODUCT_DATE_COLUMNS, PRODUCT_DIFF_LEGACY, QUANTITIES)

LEG_GIVEN = {
    "geographic_id": "CASE WHEN p_partkey % 3 = 0 THEN ' mx ' ELSE 'MX' END",
    "dataset_id": "'LEGACY'", "source_dataset_id": "'PART'",
    "dataset_product_id": "CASE WHEN p_partkey % 19 = 0 THEN ' ' ELSE ' p' || CAST(p_partkey AS VARCHAR) || ' ' END",
    "product_type_code": "'PMP'",
    "product_name": "CASE WHEN p_partkey % 23 = 0 THEN '-' ELSE ' ' || p_name END",
    "product_status_code": "' a '",
    "effective_date": ("CASE WHEN p_partkey % 5 = 0 THEN '2024-13-01' WHEN p_partkey % 5 = 1 THEN '' "
                       "ELSE CAST(DATE '2020-01-01' + CAST(p_size AS INTEGER) AS VARCHAR) END"),
    "brand_name": "p_brand",
    "competitor_indicator": "CASE WHEN p_partkey % 2 = 0 THEN ' y ' ELSE 'n' END",
    "generic_indicator": "' g '",
    "strength": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)",
    "package_quantity": "CAST(p_size AS VARCHAR)",
    "substance": "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END",
}


def leg_table(typed: bool) -> str:
    cols = []
    for c in PRODUCT.columns:
        if c in LEGACY_NULL_COLUMNS:
            continue
        e = LEG_GIVEN.get(c, "NULL")
        if c in PRODUCT_DATE_COLUMNS:
            e = f"try_cast({e} AS DATE)" if typed else f"CAST({e} AS VARCHAR)"
        else:
            e = f"CAST({e} AS VARCHAR)"
        cols.append(f"{e} AS {c}")
    return "SELECT " + ", ".join(cols) + " FROM part"


cte("leg_part", leg_table(False))
cte("leg_part_typed", leg_table(True))


def leg_transform(src: str, variant: str) -> str:
    cols = []
    for c in PRODUCT.columns:
        if c in LEGACY_NULL_COLUMNS:
            e = "NULL"
        elif c in PRODUCT_DATE_COLUMNS:
            e = f"CAST({c} AS DATE)" if variant == "catalogue" else f"try_cast(trim({c}) AS DATE)"
        elif variant == "market" and c in ("geographic_id", "dataset_product_id", *INDICATORS):
            e = f"upper(trim({c}))"
        elif variant == "legacy" and c == "competitor_indicator":
            e = f"CAST({c} AS VARCHAR)"
        elif variant == "catalogue" and c == "product_status_code":
            e = "'A'"
        elif variant == "catalogue" and c == "substance":
            e = "trim(coalesce(substance, brand_name))"
        elif variant == "catalogue" and c in QUANTITIES:
            e = f"CAST({c} AS VARCHAR)"
        else:
            e = f"trim({c})"
        cols.append(f"{e} AS {c}")
    cond = present("dataset_product_id")
    if variant != "market":
        cond += " AND product_name IS NOT NULL AND trim(product_name) NOT IN ('', '-')"
    return f"SELECT {', '.join(cols)}, {RUN} AS source_lastmodifieddate FROM {src} WHERE {cond}"


for _v, _src, _rs in (("legacy", "leg_part", K.LEGACY_SOURCE), ("market", "leg_part", K.MARKET_SOURCE),
                      ("catalogue", "leg_part_typed", K.CATALOGUE_SOURCE)):
    cte(f"leg_{_v}_tx", leg_transform(_src, _v), [_src])
    _spec = PRODUCT.with_diff(PRODUCT_DIFF_LEGACY) if _v == "legacy" else PRODUCT
    _name = "legacy_products" if _v == "legacy" else f"legacy_products_{_v}"
    oracle(_name, "SELECT * FROM (" + staged(f"leg_{_v}_tx", set(PRODUCT.columns), _spec, tb.DAY2_BATCH, RUN, _rs) + ")", [f"leg_{_v}_tx"])

cte("leg_ident",
    "SELECT ' ' || n_name AS geographic_id, 'LEGACY' AS dataset_id, CASE WHEN c_custkey % 19 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END "
    "AS dataset_product_id, 'LEGACY' AS identifier_type_code, CASE WHEN c_custkey % 13 = 0 THEN '-' ELSE 'ID' || CAST(c_custkey AS VARCHAR) END "
    "AS identifier_id, ' A ' AS status_code, CASE WHEN c_custkey % 5 = 0 THEN 'not a date' ELSE CAST(CAST(f.first_order AS DATE) AS VARCHAR) END "
    "AS effective_date, CAST(NULL AS VARCHAR) AS end_date FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f ON c_custkey = f.o_custkey")
cte("leg_ident_tx",
    "SELECT trim(geographic_id) AS geographic_id, trim(dataset_id) AS dataset_id, trim(dataset_product_id) AS dataset_product_id, "
    "trim(identifier_type_code) AS identifier_type_code, trim(identifier_id) AS identifier_id, trim(status_code) AS status_code, "
    f"try_cast(trim(effective_date) AS DATE) AS effective_date, try_cast(trim(end_date) AS DATE) AS end_date, {RUN} AS source_lastmodifieddate "
    f"FROM leg_ident WHERE {present('dataset_product_id')} AND identifier_id IS NOT NULL AND trim(identifier_id) NOT IN ('', '-')", ["leg_ident"])
oracle("legacy_identifiers", "SELECT * FROM (" + staged("leg_ident_tx", set(IDENTIFIER.columns), IDENTIFIER, tb.DAY2_BATCH, RUN, K.LEGACY_SOURCE) + ")",
       ["leg_ident_tx"])


def leg_rel(typed: bool) -> str:
    eff = "CAST(e.last_ship AS DATE)" if typed else "CAST(CAST(e.last_ship AS DATE) AS VARCHAR)"
    end = "CAST(NULL AS DATE)" if typed else "'2024-13-01'"
    return ("SELECT lower(n_name) AS parent_geographic_id, lower(n_name) AS child_geographic_id, ' SUPPLIER ' AS parent_dataset_id, "
            "'PART' AS child_dataset_id, CASE WHEN e.l_suppkey % 23 = 0 THEN '' ELSE 's' || CAST(e.l_suppkey AS VARCHAR) END AS parent_dataset_product_id, "
            "e.l_partkey AS child_dataset_product_id, ' SUPPLIES ' AS relationship_type_code, CAST(NULL AS VARCHAR) AS status_code, "
            f"{eff} AS effective_date, {end} AS end_date FROM fx_edge e JOIN supplier s ON e.l_suppkey = s.s_suppkey "
            "JOIN nation n ON s.s_nationkey = n.n_nationkey")


def leg_rel_tx(src: str, variant: str) -> str:
    up = (lambda c: f"upper(trim({c}))") if variant == "market" else (lambda c: f"trim({c})")
    dt_ = (lambda c: f"try_cast(trim({c}) AS DATE)") if variant == "market" else (lambda c: f"CAST({c} AS DATE)")
    return (f"SELECT {up('parent_geographic_id')} AS parent_geographic_id, {up('child_geographic_id')} AS child_geographic_id, "
            "trim(parent_dataset_id) AS parent_dataset_id, trim(child_dataset_id) AS child_dataset_id, "
            f"{up('parent_dataset_product_id')} AS parent_dataset_product_id, trim(CAST(child_dataset_product_id AS VARCHAR)) AS child_dataset_product_id, "
            f"trim(relationship_type_code) AS relationship_type_code, trim(status_code) AS status_code, {dt_('effective_date')} AS effective_date, "
            f"{dt_('end_date')} AS end_date, {RUN} AS source_lastmodifieddate FROM {src} WHERE {present('parent_dataset_product_id')} "
            "AND child_dataset_product_id IS NOT NULL AND trim(CAST(child_dataset_product_id AS VARCHAR)) <> ''")


cte("leg_rel", leg_rel(False), ["fx_edge"])
cte("leg_rel_typed", leg_rel(True), ["fx_edge"])
cte("leg_rel_market_tx", leg_rel_tx("leg_rel", "market"), ["leg_rel"])
cte("leg_rel_cat_tx", leg_rel_tx("leg_rel_typed", "catalogue"), ["leg_rel_typed"])
oracle("legacy_relationships", "SELECT * FROM (" + staged("leg_rel_market_tx", set(RELATIONSHIP.columns), RELATIONSHIP, tb.DAY2_BATCH, RUN,
                                                         K.MARKET_SOURCE) + ")", ["leg_rel_market_tx"])
oracle("legacy_relationships_catalogue", "SELECT * FROM (" + staged("leg_rel_cat_tx", set(RELATIONSHIP.columns), RELATIONSHIP, tb.DAY2_BATCH, RUN,
                                                                   K.CATALOGUE_SOURCE) + ")", ["leg_rel_cat_tx"])

oracle("model_log",
       "SELECT * FROM fx_log0 UNION ALL "
       f"SELECT {q(tb.DAY2_BATCH)}, 'STAGE', 'STG_PRODUCT', 'CRM', 'SUCCESS', {RUN}, {RUN}, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT), CAST(0 AS BIGINT) "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'DQ', 'REJECT', 'CRM', 'SUCCESS', {RUN}, {RUN}, (SELECT count(*) FROM fx_reject), '', "
       "CAST(0 AS BIGINT), CAST(0 AS BIGINT) "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'SAT', 'SAT_PRODUCT', 'CRM', 'SUCCESS', {RUN}, {RUN}, delta_inserted_rows + delta_updated_rows, '', "
       "delta_inserted_rows, delta_updated_rows FROM fx_metrics", ["fx_log0", "fx_reject", "fx_metrics"])


# --- identifier and relationship deltas, first load ----------------------------------------------

def _entity_delta(prefix: str, spec: Entity, day2: str, day1: str, deps: list[str]) -> None:
    """CTEs of one entity: day 2 staging, day 1 satellite, DQ set, action, next satellite."""
    cte(f"{prefix}_stg", day2, deps)
    cte(f"{prefix}_day1", staged(f"({day1})", set(spec.columns), spec, tb.DAY1_BATCH, DAY1), deps)
    cte(f"{prefix}_sat0", sat_select(f"{prefix}_day1", spec, tb.DAY1_BATCH, DAY1), [f"{prefix}_day1"])
    cte(f"{prefix}_dq", dq_sql(f"{prefix}_stg", "fx_reject", spec), [f"{prefix}_stg", "fx_reject"])
    take = "t.hashkey IS NULL OR (s.hashkey IS NOT NULL AND s.hashdiff <> t.hashdiff)"
    kept = {"start_datetime": RUN, "load_datetime": RUN, "end_datetime": "CAST(NULL AS TIMESTAMP)", "etl_batch_id": q(tb.DAY2_BATCH)}
    out = [f"CASE WHEN {take} THEN {kept.get(c, 's.' + c)} ELSE t.{c} END AS {c}"
           for c in (*SAT_META, *spec.columns) if c not in ("hashkey", "updated_datetime")]
    oracle({"relationship_optional_parent": "relationship_delta_optional_parent"}.get(prefix, f"{prefix}_delta"),
           "SELECT coalesce(s.hashkey, t.hashkey) AS hashkey, CASE WHEN t.hashkey IS NULL THEN 'NEW' WHEN s.hashkey IS NULL THEN 'ABSENT' "
           "WHEN s.hashdiff = t.hashdiff THEN 'UNCHANGED' ELSE 'CHANGED' END AS action, "
           f"CASE WHEN s.hashkey IS NULL THEN t.updated_datetime ELSE {RUN} END AS updated_datetime, "
           + ", ".join(out) + f" FROM {prefix}_dq s FULL OUTER JOIN {prefix}_sat0 t ON s.hashkey = t.hashkey", [f"{prefix}_dq", f"{prefix}_sat0"])


_IDENT_COLS = ", ".join(c for c in IDENTIFIER.columns if c != "effective_date")
_entity_delta(
    "identifier", IDENTIFIER, "SELECT * FROM fx_ident WHERE CAST(dataset_product_id AS BIGINT) % 11 <> 0",
    f"SELECT {_IDENT_COLS}, CASE WHEN CAST(dataset_product_id AS BIGINT) % 7 = 0 THEN effective_date - 1 ELSE effective_date END AS effective_date, "
    "source_lastmodifieddate FROM fx_ident WHERE CAST(dataset_product_id AS BIGINT) % 10 <> 0", ["fx_ident"])
_REL_COLS = ", ".join(c for c in RELATIONSHIP.columns if c != "status_code")
_REL_DAY1 = (f"SELECT {_REL_COLS}, CASE WHEN CAST(child_dataset_product_id AS BIGINT) % 7 = 0 THEN 'OLD' ELSE status_code END AS status_code, "
             "source_lastmodifieddate FROM fx_rel WHERE CAST(child_dataset_product_id AS BIGINT) % 10 <> 0")
_entity_delta("relationship", RELATIONSHIP, "SELECT * FROM fx_rel WHERE CAST(child_dataset_product_id AS BIGINT) % 11 <> 0", _REL_DAY1, ["fx_rel"])
_REL_OPT = ", ".join(c for c in RELATIONSHIP.columns if c != "parent_dataset_product_id")
_entity_delta(
    "relationship_optional_parent", RELATIONSHIP._replace(required_cols=tuple(c for c in RELATIONSHIP.required_cols if c != "parent_dataset_product_id")),
    staged(f"(SELECT {_REL_OPT}, CASE WHEN CAST(child_dataset_product_id AS BIGINT) % 3 = 0 THEN NULL ELSE parent_dataset_product_id END AS "
           "parent_dataset_product_id, source_lastmodifieddate FROM fx_rel WHERE CAST(child_dataset_product_id AS BIGINT) % 11 <> 0)",
           set(RELATIONSHIP.columns), RELATIONSHIP, tb.DAY2_BATCH, RUN),
    _REL_DAY1, ["fx_rel"])
oracle("first_load",
       "SELECT hashkey, hashdiff, " + ", ".join(f"{RUN} AS {c}" for c in ("start_datetime", "load_datetime"))
       + f", CAST(NULL AS TIMESTAMP) AS end_datetime, {RUN} AS updated_datetime, {q(tb.DAY2_BATCH)} AS etl_batch_id, record_source, "
       + ", ".join(PRODUCT.columns) + " FROM fx_dq", ["fx_dq"])
oracle("legacy_hash_names", "SELECT hashkey, hashdiff, dataset_product_id FROM fx_sat0", ["fx_sat0"])
oracle("reject_image", "SELECT reject_key, s.product_name, s.hashkey AS image_hashkey FROM fx_reject r JOIN fx_stg s ON r.hashkey = s.hashkey",
       ["fx_reject", "fx_stg"])
_FAILED = "'Compilation error in HUB'"
oracle("batch_control_failed",
       f"SELECT {q(tb.DAY2_BATCH)} AS etl_batch_id, 'VAULT' AS pipeline_name, (SELECT count(*) FROM fx_reject) AS total_rejected_records, "
       f"{RUN} AS start_timestamp, {RUN} AS end_timestamp, 'FAILED' AS process_status, {_FAILED} AS error_message", ["fx_reject"])
oracle("process_end_failed",
       "SELECT * FROM fx_log0 UNION ALL "
       f"SELECT {q(tb.DAY2_BATCH)}, 'DQ', 'REJECT', 'CRM', 'SUCCESS', {RUN}, {RUN}, (SELECT count(*) FROM fx_reject), '', CAST(0 AS BIGINT), CAST(0 AS BIGINT) "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'HUB', 'HUB', 'CRM', 'ERROR', {RUN}, {RUN}, CAST(0 AS BIGINT), {_FAILED}, CAST(0 AS BIGINT), CAST(0 AS BIGINT) "
       f"UNION ALL SELECT {q(tb.DAY2_BATCH)}, 'STAGE', 'STG_PRODUCT', 'CRM', 'SUCCESS', {RUN}, {RUN}, (SELECT count(*) FROM fx_stg), '', "
       "CAST(0 AS BIGINT), CAST(0 AS BIGINT)", ["fx_log0", "fx_reject", "fx_stg"])


# --- stored tables: what is read back is what the operators give ------------------------------------
ORACLES["snapshot_sink"] = ORACLES["snapshot_batch"]
ORACLES["reject_image_stored"] = ORACLES["reject_image"]
ORACLES["declared_drift"] = ORACLES["catalogue_products"]
ORACLES["load_stored"] = ORACLES["sat_merge"]
oracle("snapshot_one_batch",
       f"SELECT captured_at, {', '.join(STG_COLS)} FROM ({ORACLES['snapshot_batch'][0]}) WHERE etl_batch_id = {q(tb.DAY2_BATCH)}",
       ORACLES["snapshot_batch"][1])
_REJECT = ("reject_key, dataset_product_id, source_country_code, dataset_id, source_dataset_id, error_code, error_message, load_datetime, "
           "source_lastmodifieddate, hashkey, hashdiff, record_source, reject_source_model, rejected_record")
oracle("reject_schema_sync",
       f"SELECT {_REJECT}, etl_batch_id, CAST(NULL AS INTEGER) AS severity FROM fx_reject "
       f"UNION ALL SELECT {_REJECT}, 'B2', CAST(length(error_code) AS INTEGER) FROM fx_reject "
       f"UNION ALL SELECT {_REJECT}, 'B3', CAST(length(error_code) AS INTEGER) FROM fx_reject", ["fx_reject"])
