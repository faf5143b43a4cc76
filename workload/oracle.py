"""The registered queries in SQL over the given tables."""

from __future__ import annotations

from workload.sql_views import with_views

ORACLE: dict[str, str] = {}

NEWEST = (
    "QUALIFY row_number() OVER (PARTITION BY crm_line_id ORDER BY version DESC NULLS LAST,"
    " tie_part DESC NULLS LAST, tie_supplier DESC NULLS LAST, amount DESC NULLS LAST) = 1"
)
THIRD = "payer_type IN ('RESELLER', 'MARKETPLACE', 'RESELLER_MARKETPLACE')"
PAYER = f"coalesce(CASE WHEN {THIRD} THEN third_party_payer_id END, billing_account_id)"
# The clock of the checks less the look-back of 20 days.
CUTOFF = "TIMESTAMP '2001-07-12 00:00:00'"
SINCE = "TIMESTAMP '1996-01-01 00:00:00'"
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
ORDERABLE = (
    "type NOT IN ('FREE') AND order_number IS NOT NULL AND coalesce(product_code, '') NOT IN ('SMALL')"
)
LIVE_ACCOUNT = (
    "(platform_tier NOT IN ('Free') OR platform_tier IS NULL)"
    " AND (freeze_reason IS NULL OR freeze_reason <> 'TRIAL_EXPIRED')"
)


def oracle(name: str, views: str, body: str) -> None:
    ORACLE[name] = with_views(views, body)


def blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}, {BLANKS}) = '')"


oracle("newest_versions", "sub_versions", f"SELECT * FROM sub_versions WHERE NOT is_deleted {NEWEST}")

oracle(
    "payers",
    "sub_versions",
    f"""SELECT id, version, tie_part, tie_supplier, payer_type, third_party_payer_id,
               {PAYER} AS payer_account_id FROM sub_versions""",
)

oracle("recent_accounts", "accounts", f"SELECT * FROM accounts WHERE synced_at >= {CUTOFF}")

oracle(
    "run_mode_dates",
    "sub_versions",
    """SELECT type, count(*) AS versions, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM sub_versions
       WHERE created_at >= TIMESTAMP '2000-01-01' AND created_at < TIMESTAMP '2001-08-02' GROUP BY type""",
)

oracle(
    "run_mode_accounts",
    "sub_versions",
    f"""SELECT id, version, tie_part, tie_supplier, billing_account_id, created_at, amount FROM sub_versions
        WHERE billing_account_id IN ('7', '11', '13') AND created_at >= {SINCE}""",
)

FIRST_ORDERS = """
    SELECT lower(trim(memo)) AS memo_norm, document_number, transaction_date FROM erp_sales_orders
    WHERE transaction_type = 'Sales Order'
    QUALIFY row_number() OVER (PARTITION BY lower(trim(memo)) ORDER BY transaction_date, document_number) = 1"""
oracle("first_sales_orders", "erp_sales_orders", FIRST_ORDERS)

oracle(
    "account_sync",
    "sub_versions accounts billing_info",
    f"""
    WITH newest AS (
        SELECT *, {PAYER} AS payer_account_id FROM sub_versions
        WHERE NOT is_deleted
          AND (contract_end_date IS NULL OR CAST(contract_end_date AS DATE) >= DATE '2001-08-01') {NEWEST})
    SELECT n.*,
           a.id AS account_id, a.status AS account_status, a.platform_tier AS account_platform_tier,
           a.freeze_reason AS account_freeze_reason, a.payment_profile_id AS account_payment_profile_id,
           a.synced_at AS account_synced_at, a.is_deleted AS account_is_deleted,
           i.id AS info_id, i.account_id AS info_account_id, i.legal_name AS info_legal_name,
           i.tax_id AS info_tax_id, i.billing_address AS info_billing_address,
           i.shipping_address AS info_shipping_address, i.payment_profile_id AS info_payment_profile_id,
           i.updated_at AS info_updated_at, i.synced_at AS info_synced_at, i.is_deleted AS info_is_deleted
    FROM newest n
    JOIN accounts a ON n.billing_account_id = a.id
    LEFT JOIN billing_info i ON a.id = i.account_id
    WHERE n.order_number IS NOT NULL AND n.type NOT IN ('FREE')
      AND (a.status IN ('Customer', 'Frozen', 'Partner') OR n.type = 'CROSS_SELL')
      AND {LIVE_ACCOUNT}
      AND (n.synced_at >= {CUTOFF} OR a.synced_at >= {CUTOFF} OR i.synced_at >= {CUTOFF})""",
)

LINES = f"""
    lines AS (SELECT *, {PAYER} AS payer_account_id FROM sub_versions
              WHERE NOT is_deleted AND NOT is_evergreen AND created_at >= {SINCE} {NEWEST}),
    live_info AS (SELECT * FROM billing_info WHERE NOT is_deleted)"""
SYNCED = f"""
    FROM lines l
    LEFT JOIN live_info p ON l.third_party_payer_id = p.account_id
    LEFT JOIN live_info c ON l.billing_account_id = c.account_id
    WHERE {ORDERABLE}"""
RECENT_LINE = f"(l.synced_at >= {CUTOFF} OR c.synced_at >= {CUTOFF} OR p.synced_at >= {CUTOFF})"

oracle(
    "subscription_sync",
    "sub_versions billing_info",
    f"""
    WITH {LINES}
    SELECT l.*,
           CASE WHEN {THIRD} THEN p.billing_address ELSE c.billing_address END AS billing_address,
           c.shipping_address AS shipping_address, c.legal_name AS legal_name,
           CASE WHEN {THIRD} THEN p.tax_id ELSE c.tax_id END AS tax_id
    {SYNCED} AND {RECENT_LINE}""",
)

oracle(
    "subscription_sync_payer_name",
    "sub_versions billing_info",
    f"""
    WITH {LINES}
    SELECT l.id, l.billing_account_id, l.payer_type,
           CASE WHEN {THIRD} THEN p.legal_name ELSE c.legal_name END AS legal_name,
           CASE WHEN {THIRD} THEN p.tax_id ELSE c.tax_id END AS tax_id
    {SYNCED} AND {RECENT_LINE}""",
)

ORACLE["subscription_sync_kept"] = ORACLE["subscription_sync"]
oracle(
    "product_account_sync",
    "sub_versions product_orgs billing_info",
    """
    WITH members AS (SELECT DISTINCT org_id, billing_info_id FROM product_orgs WHERE NOT is_deleted),
    newest AS (
        SELECT s.*, m.org_id FROM sub_versions s JOIN members m ON s.billing_account_id = m.billing_info_id
        WHERE NOT s.is_deleted AND s.termination_date_utc IS NULL AND s.type = 'STANDARD'
          AND (s.contract_end_date IS NULL OR CAST(s.contract_end_date AS DATE) >= DATE '2001-08-01')
        QUALIFY row_number() OVER (PARTITION BY m.org_id ORDER BY s.version DESC, s.tie_part DESC,
                                   s.tie_supplier DESC, s.amount DESC) = 1)
    SELECT n.id, n.billing_account_id, n.org_id, n.version, n.type, n.contract_end_date, n.synced_at,
           i.payment_profile_id AS info_payment_profile_id, i.legal_name AS info_legal_name,
           i.billing_address AS info_billing_address, i.tax_id AS info_tax_id
    FROM newest n JOIN billing_info i ON n.billing_account_id = i.id
    WHERE NOT i.is_deleted AND i.payment_profile_id IS NOT NULL
      AND (n.synced_at >= TIMESTAMP '2000-06-27' OR i.synced_at >= TIMESTAMP '2000-06-27')
    QUALIFY row_number() OVER (PARTITION BY n.billing_account_id ORDER BY i.payment_profile_id DESC NULLS LAST,
                               n.version DESC, n.tie_part DESC, n.tie_supplier DESC, n.amount DESC, n.org_id) = 1""",
)

oracle(
    "owner_change_sync",
    "owner_history crm_accounts crm_account_map crm_users accounts",
    """
    WITH changes AS (
        SELECT h.* FROM owner_history h JOIN crm_accounts a ON h.crm_account_id = a.id
        WHERE NOT h.is_deleted AND NOT a.is_deleted AND h.field = 'Owner' AND h.data_type = 'EntityId'
          AND h.created_date >= TIMESTAMP '2024-01-05 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY h.crm_account_id
                                   ORDER BY h.created_date DESC, h.history_id DESC) = 1)
    SELECT m.billing_account_id, c.crm_account_id, n.email AS new_owner_email, o.email AS old_owner_email,
           c.created_date AS owner_changed_at, b.status
    FROM changes c
    LEFT JOIN crm_account_map m ON c.crm_account_id = m.crm_account_id
    LEFT JOIN crm_users n ON c.new_value = n.id
    LEFT JOIN crm_users o ON c.old_value = o.id
    LEFT JOIN accounts b ON m.billing_account_id = b.id
    WHERE m.billing_account_id IS NOT NULL AND n.email IS NOT NULL
      AND lower(n.email) <> 'self.service@example.com' AND b.status IN ('Customer', 'Frozen')""",
)

RANGE = "{0} >= TIMESTAMP '2000-01-01' AND {0} < TIMESTAMP '2001-08-02'"

oracle(
    "missing_fields_all",
    "sub_versions accounts billing_info",
    f"""
    WITH newest AS (SELECT * FROM sub_versions WHERE NOT is_deleted {NEWEST})
    SELECT DISTINCT n.billing_account_id, n.third_party_payer_id, n.crm_account_id,
           n.synced_at AS subscription_synced_at, a.synced_at AS account_synced_at, i.synced_at AS billing_synced_at,
           i.billing_address, i.shipping_address, i.legal_name, n.payer_type,
           true AS is_billing_missing, true AS is_shipping_missing, true AS is_legal_missing, true AS is_missing
    FROM newest n JOIN accounts a ON n.billing_account_id = a.id LEFT JOIN billing_info i ON a.id = i.account_id
    WHERE n.type NOT IN ('FREE') AND a.status IN ('Customer', 'Frozen', 'Partner') AND {LIVE_ACCOUNT}
      AND (({RANGE.format('n.synced_at')}) OR ({RANGE.format('a.synced_at')}) OR ({RANGE.format('i.synced_at')}))
      AND {blank('i.billing_address')} AND {blank('i.shipping_address')} AND {blank('i.legal_name')}""",
)

oracle(
    "missing_fields_any",
    "sub_versions billing_info",
    f"""
    WITH newest AS (SELECT * FROM sub_versions WHERE NOT is_deleted AND NOT is_evergreen
                    AND {RANGE.format('synced_at')} {NEWEST}),
    addressed AS (
        SELECT n.billing_account_id, n.third_party_payer_id, n.crm_account_id, n.order_number,
               n.synced_at AS subscription_synced_at, n.payer_type,
               CASE WHEN n.payer_type IN ('RESELLER', 'MARKETPLACE') THEN p.billing_address
                    ELSE c.billing_address END AS billing_address,
               c.shipping_address,
               CASE WHEN n.payer_type IN ('RESELLER', 'MARKETPLACE') THEN p.legal_name
                    ELSE c.legal_name END AS legal_name
        FROM newest n LEFT JOIN billing_info p ON n.third_party_payer_id = p.account_id
        LEFT JOIN billing_info c ON n.billing_account_id = c.account_id
        WHERE n.type NOT IN ('FREE') AND n.order_number IS NOT NULL)
    SELECT DISTINCT *, {blank('billing_address')} AS is_billing_missing,
           {blank('shipping_address')} AS is_shipping_missing, {blank('legal_name')} AS is_legal_missing,
           true AS is_missing
    FROM addressed
    WHERE {blank('billing_address')} OR {blank('shipping_address')} OR {blank('legal_name')}""",
)

oracle(
    "id_map",
    "sub_versions",
    f"""
    WITH newest AS (SELECT * FROM sub_versions WHERE NOT is_deleted {NEWEST})
    SELECT crm_account_id,
           string_agg(DISTINCT billing_account_id, ', ' ORDER BY billing_account_id) AS billing_account_ids,
           count(DISTINCT billing_account_id) AS count_billing_accounts
    FROM newest WHERE coalesce(product_code, '') NOT LIKE 'Free%' GROUP BY crm_account_id""",
)

oracle(
    "id_map_values",
    "sub_versions",
    """SELECT DISTINCT crm_account_id, list, value FROM (
        SELECT crm_account_id, 'billing_account_id' AS list, CAST(billing_account_id AS VARCHAR) AS value FROM sub_versions
        UNION ALL SELECT crm_account_id, 'product_code', CAST(product_code AS VARCHAR) FROM sub_versions
        UNION ALL SELECT crm_account_id, 'version', CAST(version AS VARCHAR) FROM sub_versions) AS values_""",
)
oracle(
    "reseller_rollup",
    "sub_versions billing_info",
    f"""
    WITH newest AS (
        SELECT * FROM sub_versions
        WHERE NOT is_deleted AND NOT is_evergreen AND crm_line_id IS NOT NULL AND order_number IS NOT NULL
          AND coalesce(product_code, '') NOT LIKE 'Free%' AND payer_type = 'RESELLER' {NEWEST})
    SELECT n.crm_account_id, count(DISTINCT n.third_party_payer_id) AS reseller_count,
           string_agg(DISTINCT n.billing_account_id, ', ' ORDER BY n.billing_account_id) AS billing_account_ids,
           string_agg(DISTINCT n.third_party_payer_id, ', ' ORDER BY n.third_party_payer_id) AS partner_ids,
           string_agg(DISTINCT r.legal_name, ', ' ORDER BY r.legal_name) AS reseller_names,
           string_agg(DISTINCT c.legal_name, ', ' ORDER BY c.legal_name) AS customer_names
    FROM newest n LEFT JOIN billing_info r ON n.third_party_payer_id = r.account_id
    LEFT JOIN billing_info c ON n.billing_account_id = c.account_id
    GROUP BY n.crm_account_id""",
)

oracle(
    "order_rollup",
    "sub_versions item_map",
    f"""
    WITH newest AS (
        SELECT * FROM sub_versions
        WHERE NOT is_deleted AND NOT is_evergreen AND created_at >= TIMESTAMP '1998-08-02 00:00:00'
          AND crm_line_id IS NOT NULL AND order_number IS NOT NULL {NEWEST})
    SELECT order_number, count(DISTINCT id) AS subscription_count,
           string_agg(DISTINCT CAST(id AS VARCHAR), ', ' ORDER BY CAST(id AS VARCHAR)) AS subscription_ids,
           string_agg(DISTINCT billing_account_id, ', ' ORDER BY billing_account_id) AS billing_account_ids,
           string_agg(DISTINCT n.product_code, ', ' ORDER BY n.product_code) AS item_codes,
           string_agg(DISTINCT erp_item_id, ', ' ORDER BY erp_item_id) AS erp_item_ids
    FROM newest n LEFT JOIN item_map m ON n.product_code = m.product_code
    WHERE coalesce(n.product_code, '') NOT LIKE 'Free%'
    GROUP BY order_number HAVING count(DISTINCT id) >= 1""",
)

oracle(
    "order_detail",
    "sub_versions item_map",
    f"""
    WITH newest AS (
        SELECT * FROM sub_versions
        WHERE NOT is_deleted AND NOT is_evergreen AND created_at >= {SINCE} AND created_at < TIMESTAMP '2001-08-01'
          AND crm_line_id IS NOT NULL AND order_number IS NOT NULL {NEWEST})
    SELECT order_number, id, billing_account_id, n.product_code, erp_item_id,
           strftime(start_date_utc, '%m/%d/%Y') AS service_start_date,
           strftime(end_date_utc, '%m/%d/%Y') AS service_end_date,
           amount, crm_line_id, contract_start_date, contract_end_date
    FROM newest n LEFT JOIN item_map m ON n.product_code = m.product_code
    WHERE coalesce(n.product_code, '') NOT LIKE 'Free%'""",
)

oracle(
    "drop_reason",
    "accounts",
    f"""
    SELECT id, status, platform_tier, freeze_reason, synced_at,
           CASE WHEN status NOT IN ('Customer', 'Frozen', 'Partner') THEN 'FAIL: status not allowed'
                WHEN platform_tier IN ('Free') THEN 'FAIL: free tier'
                WHEN freeze_reason = 'TRIAL_EXPIRED' THEN 'FAIL: trial expired'
                WHEN synced_at < {CUTOFF} THEN 'WARN: stale acct sync' ELSE 'OK' END AS diagnosis
    FROM accounts""",
)

oracle(
    "recently_dropped",
    "accounts",
    f"""
    SELECT id, status, platform_tier, freeze_reason, synced_at,
           CASE WHEN status NOT IN ('Customer', 'Frozen', 'Partner') THEN 'status'
                WHEN platform_tier IN ('Free') THEN 'platform_tier'
                WHEN freeze_reason = 'TRIAL_EXPIRED' THEN 'freeze_reason' ELSE 'unknown' END AS drop_reason
    FROM accounts
    WHERE synced_at >= {CUTOFF}
      AND NOT (status IN ('Customer', 'Frozen', 'Partner') AND {LIVE_ACCOUNT})""",
)

NEWEST_SYNC = (
    "greatest(l.synced_at, coalesce(c.synced_at, TIMESTAMP '1970-01-01'), coalesce(p.synced_at, TIMESTAMP '1970-01-01'))"
)
oracle(
    "join_coverage",
    "sub_versions billing_info",
    f"""
    WITH {LINES}
    SELECT l.id, l.billing_account_id, l.payer_type, l.third_party_payer_id, l.synced_at AS sub_synced_at,
           p.account_id AS payer_join_hit, p.synced_at AS payer_synced_at,
           c.account_id AS customer_join_hit, c.synced_at AS customer_synced_at,
           {NEWEST_SYNC} AS latest_any_sync, {CUTOFF} AS sync_cutoff, {NEWEST_SYNC} >= {CUTOFF} AS inside_window
    {SYNCED}""",
)

oracle(
    "join_quality",
    "sub_versions billing_info",
    f"""
    WITH {LINES}
    SELECT l.id, l.billing_account_id, l.payer_type, l.third_party_payer_id, l.synced_at AS sub_synced_at,
           p.account_id AS payer_join_hit, p.synced_at AS payer_synced_at,
           c.account_id AS customer_join_hit, c.synced_at AS customer_synced_at,
           {NEWEST_SYNC} AS latest_any_sync, {CUTOFF} AS sync_cutoff, {NEWEST_SYNC} >= {CUTOFF} AS inside_window
    FROM lines l
    LEFT JOIN live_info p ON l.third_party_payer_id = p.account_id
    LEFT JOIN live_info c ON l.billing_account_id = c.account_id""",
)

UNEXPIRED = "(contract_end_date IS NULL OR CAST(contract_end_date AS DATE) >= DATE '2001-08-01')"
ORDERED = "order_number IS NOT NULL AND type NOT IN ('FREE')"
BILLED = (
    ORDERED + " AND account IS NOT NULL AND (status IN ('Customer', 'Frozen', 'Partner') OR type = 'CROSS_SELL')"
    " AND (platform_tier IS NULL OR platform_tier NOT IN ('Free'))"
    " AND (freeze_reason IS NULL OR freeze_reason <> 'TRIAL_EXPIRED')"
)
oracle(
    "stage_counts_accounts",
    "sub_versions accounts billing_info",
    f"""
    WITH newest AS (SELECT * FROM sub_versions WHERE NOT is_deleted AND {UNEXPIRED} {NEWEST}),
    joined AS (
        SELECT n.order_number, n.type, n.synced_at, a.id AS account, a.status, a.platform_tier, a.freeze_reason,
               a.synced_at AS account_synced,
               (SELECT max(i.synced_at) FROM billing_info i WHERE i.account_id = n.billing_account_id) AS info_synced
        FROM newest n LEFT JOIN accounts a ON n.billing_account_id = a.id)
    SELECT '1_raw' AS stage, count(*) AS records FROM sub_versions
    UNION ALL SELECT '2_live', count(*) FROM sub_versions WHERE NOT is_deleted
    UNION ALL SELECT '3_unexpired', count(*) FROM sub_versions WHERE NOT is_deleted AND {UNEXPIRED}
    UNION ALL SELECT '4_newest', count(*) FROM joined
    UNION ALL SELECT '5_ordered', count(*) FROM joined WHERE {ORDERED}
    UNION ALL SELECT '6_on_account', count(*) FROM joined WHERE {ORDERED} AND account IS NOT NULL
    UNION ALL SELECT '7_billed', count(*) FROM joined WHERE {BILLED}
    UNION ALL SELECT '8_recent', count(*) FROM joined WHERE {BILLED}
        AND (synced_at >= {CUTOFF} OR account_synced >= {CUTOFF} OR info_synced >= {CUTOFF})""",
)

oracle(
    "zero_total_orders",
    "sub_versions",
    f"""
    WITH lines AS (SELECT * FROM sub_versions WHERE NOT is_deleted AND NOT is_evergreen
                   AND created_at >= {SINCE} {NEWEST})
    SELECT order_number, billing_account_id, count(*) AS line_count,
           CAST(sum(amount) AS DECIMAL(18,4)) AS total_amount,
           string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS subscription_ids,
           string_agg(type, ',' ORDER BY id) AS types
    FROM lines WHERE {ORDERABLE} GROUP BY order_number, billing_account_id HAVING sum(amount) = 0""",
)

oracle(
    "stage_counts",
    "sub_versions",
    f"""
    WITH lines AS (SELECT * FROM sub_versions WHERE NOT is_deleted AND NOT is_evergreen
                   AND created_at >= {SINCE} {NEWEST})
    SELECT '1_raw' AS stage, count(*) AS records FROM sub_versions
    UNION ALL SELECT '2_live', count(*) FROM sub_versions WHERE NOT is_deleted
    UNION ALL SELECT '3_fixed_term_since', count(*) FROM sub_versions
              WHERE NOT is_deleted AND NOT is_evergreen AND created_at >= {SINCE}
    UNION ALL SELECT '4_newest', count(*) FROM lines
    UNION ALL SELECT '5_orderable', count(*) FROM lines WHERE {ORDERABLE}
    UNION ALL SELECT '6_recent', count(*) FROM lines WHERE {ORDERABLE} AND synced_at >= {CUTOFF}""",
)

oracle(
    "key_profile",
    "revenue_records product_orgs",
    """
    WITH both_sides AS (SELECT r.billing_account_id AS k FROM revenue_records r
                        JOIN product_orgs o ON r.billing_account_id = o.billing_info_id)
    SELECT 'facts' AS side, count(*) AS records, count(DISTINCT billing_account_id) AS distinct_keys,
           min(billing_account_id) AS smallest_key, max(billing_account_id) AS largest_key, 'string' AS key_type
    FROM revenue_records
    UNION ALL SELECT 'members', count(*), count(DISTINCT billing_info_id), min(billing_info_id),
                     max(billing_info_id), 'string' FROM product_orgs
    UNION ALL SELECT 'overlap', count(*), count(DISTINCT k), min(k), max(k), 'string' FROM both_sides""",
)

oracle(
    "key_sample",
    "revenue_records product_orgs",
    """
    SELECT * FROM (SELECT DISTINCT 'facts' AS side, billing_account_id AS key, 'string' AS key_type
                   FROM revenue_records ORDER BY key LIMIT 10) AS f
    UNION ALL SELECT * FROM (SELECT DISTINCT 'members' AS side, org_id AS key, 'string' AS key_type
                             FROM product_orgs ORDER BY key LIMIT 10) AS m""",
)

oracle(
    "revenue_date_range",
    "revenue_records",
    """SELECT count(*) AS records, min(revenue_date_utc) AS first_at, max(revenue_date_utc) AS last_at
       FROM revenue_records WHERE product_type = 'LINE_B' AND NOT is_deleted""",
)

oracle(
    "id_match_debug",
    "accounts erp_customers",
    """SELECT a.id AS billing_account_id, a.payment_profile_id, CAST(c.id AS VARCHAR) AS erp_customer_id,
              c.name AS erp_customer_name
       FROM accounts a JOIN erp_customers c ON a.id = c.billing_account_id
       WHERE NOT a.is_deleted AND NOT c.is_deleted""",
)

RECONCILED = """
    crm AS (SELECT *, lower(trim(order_number)) AS k FROM crm_orders WHERE NOT is_deleted),
    erp AS (SELECT DISTINCT lower(trim(memo)) AS k, document_number, transaction_id, transaction_date,
                   transaction_status, TRY_CAST(amount AS DECIMAL(18,4)) AS amount, billing_account_id
            FROM erp_transactions WHERE transaction_type = 'SalesOrd' AND book_name = 'Primary'),
    reconciled AS (
        SELECT c.order_number, c.id AS crm_order_id, c.account_id AS crm_account_id, c.status AS crm_status,
               c.type AS crm_type, CAST(c.effective_date AS DATE) AS crm_effective_date,
               TRY_CAST(c.total_amount AS DECIMAL(18,4)) AS crm_amount, c.skip_export AS crm_skip_export,
               c.test_mode AS crm_test_mode, c.synced_flag AS crm_synced_flag, c.erp_id AS crm_erp_id,
               c.legacy_erp_id AS crm_legacy_erp_id, e.document_number AS erp_document_number,
               e.transaction_id AS erp_transaction_id, e.transaction_date AS erp_transaction_date,
               e.transaction_status AS erp_status, e.amount AS erp_amount,
               e.billing_account_id AS erp_billing_account_id,
               CASE WHEN c.order_number IS NOT NULL AND e.k IS NOT NULL THEN 'both'
                    WHEN c.order_number IS NOT NULL THEN 'crm_only' WHEN e.k IS NOT NULL THEN 'erp_only' END
                 AS record_status,
               CAST(round(e.amount - TRY_CAST(c.total_amount AS DECIMAL(18,4)), 4) AS DECIMAL(18,4))
                 AS amount_variance,
               CASE WHEN e.k IS NOT NULL THEN NULL WHEN c.skip_export = 'true' THEN 'skip_flag'
                    WHEN c.test_mode = 'true' THEN 'test_order'
                    WHEN c.synced_flag = 'false' AND c.erp_id IS NULL AND c.legacy_erp_id IS NULL
                    THEN 'not_synced'
                    WHEN c.synced_flag = 'true' AND c.erp_id IS NULL THEN 'synced_without_id'
                    ELSE 'unknown' END AS likely_reason
        FROM crm c FULL OUTER JOIN erp e ON c.k = e.k)"""
oracle("reconcile_orders", "crm_orders erp_transactions", f"WITH {RECONCILED} SELECT * FROM reconciled")
oracle(
    "reconcile_summary",
    "crm_orders erp_transactions",
    f"""WITH {RECONCILED}
    SELECT record_status, likely_reason, count(*) AS orders,
           count(*) FILTER (WHERE amount_variance <> 0) AS with_variance,
           CAST(sum(amount_variance) AS DECIMAL(18,4)) AS total_variance
    FROM reconciled GROUP BY record_status, likely_reason""",
)


def months(start: str, end: str) -> str:
    """Calendar months between two dates, a started one counted."""
    return (
        f"CASE WHEN {end} < {start} THEN 0 ELSE (year({end}) - year({start})) * 12 + month({end}) - month({start})"
        f" + CASE WHEN day({end}) > day({start}) THEN 1 ELSE 0 END END"
    )


def band(term: str) -> str:
    return f"CASE WHEN {term} IS NULL THEN NULL WHEN {term} <= 17 THEN 'Y1' WHEN {term} <= 29 THEN 'Y2' ELSE 'Y3' END"


def rate(amount: str, quantity: str) -> str:
    """Quotient of two decimals at four places, half away from zero, with whole-number arithmetic."""
    a, q = f"CAST({amount} * 100 AS HUGEINT)", f"CAST({quantity} * 100 AS HUGEINT)"
    return (
        f"CASE WHEN {quantity} <> 0 THEN CAST(CAST(sign({a}) * sign({q})"
        f" * ((abs({a}) * 20000 + abs({q})) // (2 * abs({q}))) AS DECIMAL(18,0)) / 10000 AS DECIMAL(18,4)) END"
    )


PAYER_NAME = (
    "CASE upper(payer_type) WHEN 'CUSTOMER' THEN 'Customer' WHEN 'RESELLER' THEN 'Reseller'"
    " WHEN 'MARKETPLACE' THEN 'Marketplace' WHEN 'RESELLER_MARKETPLACE' THEN 'Reseller_Marketplace'"
    " ELSE payer_type END"
)


def json_name(column: str) -> str:
    def part(key: str) -> str:
        return f"coalesce(CASE WHEN json_valid({column}) THEN json_extract_string({column}, '$.{key}') END, '')"

    return f"{part('firstName')} || ' ' || {part('lastName')}"


VALIDATED = f"""
    newest_info AS (SELECT * FROM billing_info WHERE NOT is_deleted
                    QUALIFY row_number() OVER (PARTITION BY account_id
                      ORDER BY updated_at DESC NULLS LAST, synced_at DESC NULLS LAST, id DESC NULLS LAST,
                               legal_name DESC NULLS LAST, billing_address DESC NULLS LAST) = 1),
    lines AS (SELECT *, {PAYER} AS payer_account_id FROM sub_versions
              WHERE NOT is_deleted AND NOT is_evergreen AND created_at >= {SINCE}
                AND created_at < TIMESTAMP '2001-08-01' {NEWEST}),
    first_orders AS ({FIRST_ORDERS}),
    joined AS (
        SELECT l.*, f.document_number AS erp_order_number, f.transaction_date AS erp_order_date,
               a.status AS account_status, a.freeze_reason AS account_freeze_reason,
               a.platform_tier AS account_platform_tier,
               CASE WHEN {THIRD} THEN p.billing_address ELSE c.billing_address END AS billing_address_json,
               c.shipping_address AS shipping_address_json,
               CASE WHEN {THIRD} THEN p.legal_name ELSE c.legal_name END AS legal_name,
               CASE WHEN {THIRD} THEN p.tax_id ELSE c.tax_id END AS tax_id,
               {PAYER_NAME} AS normalized_payer_type, names.partner_name,
               {rate('l.amount', 'l.product_quantity')} AS rate,
               {months('l.contract_start_date', 'coalesce(l.contract_end_date, l.end_date_utc)')} AS term_months
        FROM lines l
        LEFT JOIN first_orders f ON lower(trim(l.order_number)) = f.memo_norm
        LEFT JOIN accounts a ON l.billing_account_id = a.id AND NOT a.is_deleted
        LEFT JOIN newest_info p ON l.third_party_payer_id = p.account_id
        LEFT JOIN newest_info c ON l.billing_account_id = c.account_id
        LEFT JOIN partner_names names ON l.third_party_payer_id = names.payer_id AND names.partner_name IS NOT NULL
        WHERE l.type NOT IN ('FREE') AND l.order_number IS NOT NULL),
    derived AS (
        SELECT j.*, CASE WHEN j.product_code IN ('ECONOMY', 'LARGE') THEN {band('term_months')} END AS term_band,
               {json_name('billing_address_json')} AS billing_attention,
               {json_name('shipping_address_json')} AS shipping_attention,
               partner_name IS NOT NULL
                 AND normalized_payer_type IN ('Reseller_Marketplace', 'Marketplace') AS is_partner,
               CASE WHEN j.product_code IN ('STANDARD', 'SMALL') THEN contract_start_date ELSE start_date_utc END
                 AS rr_start_date,
               CASE WHEN j.product_code IN ('STANDARD', 'SMALL') THEN coalesce(contract_end_date, end_date_utc)
                    ELSE end_date_utc END AS rr_end_date,
               (SELECT CAST(sum(amount) AS DECIMAL(28,2)) FROM lines l
                WHERE l.order_number = j.order_number AND l.type NOT IN ('FREE')) AS order_total_amount
        FROM joined j),
    branded AS (
        SELECT d.*, coalesce(b.band_item_id, CASE WHEN d.product_code = 'MEDIUM' THEN 'IMEDIUM' END)
                 AS product_code_branding
        FROM derived d LEFT JOIN band_items b ON d.product_code = b.product_code AND d.term_band = b.term_band),
    ruled AS (
        SELECT *, concat_ws('; ',
            CASE WHEN billing_address_json IS NULL THEN 'no_billing_address' END,
            CASE WHEN shipping_address_json IS NULL THEN 'no_shipping_address' END,
            CASE WHEN trim(coalesce(legal_name, '')) = '' THEN 'no_legal_name' END,
            CASE WHEN trim(coalesce(billing_account_id, '')) = '' THEN 'no_billing_account' END,
            CASE WHEN normalized_payer_type = 'Reseller' AND partner_name IS NULL THEN 'reseller_unmapped' END,
            CASE WHEN order_total_amount = 0 THEN 'order_total_zero' END,
            CASE WHEN product_code IN ('ECONOMY', 'LARGE') AND product_code_branding IS NULL
                 THEN 'no_band_item:' || product_code END,
            CASE WHEN termination_date_utc IS NOT NULL THEN 'terminated' END,
            CASE WHEN CAST(contract_end_date AS DATE) < DATE '2001-08-01' THEN 'contract_over' END,
            CASE WHEN account_status NOT IN ('Customer', 'Frozen', 'Partner') AND type <> 'CROSS_SELL'
                 THEN 'account_status:' || account_status END,
            CASE WHEN account_freeze_reason = 'TRIAL_EXPIRED' THEN 'trial_over' END,
            CASE WHEN account_platform_tier IN ('Free') THEN 'account_tier:' || account_platform_tier END
        ) AS validation_error_message FROM branded),
    validated AS (
        SELECT *, CASE WHEN validation_error_message <> '' THEN 'INVALID' ELSE 'VALID' END AS validation_status,
            CASE WHEN regexp_matches(validation_error_message, 'no_(billing_address|shipping_address|legal_name)')
                 THEN 'addresses_and_names'
                 WHEN regexp_matches(validation_error_message,
                      'account_status:|trial_over|terminated|contract_over')
                 THEN 'eligibility'
                 WHEN regexp_matches(validation_error_message, 'order_total_zero|reseller_unmapped')
                 THEN 'order_rules'
                 WHEN regexp_matches(validation_error_message, 'no_band_item:|account_tier:')
                 THEN 'product_setup'
                 WHEN validation_error_message <> '' THEN 'other' END AS rejection_category
        FROM ruled)"""
VALIDATION_VIEWS = "sub_versions accounts billing_info erp_sales_orders partner_names band_items"
oracle(
    "order_validation_invalid",
    VALIDATION_VIEWS,
    f"WITH {VALIDATED} SELECT * FROM validated WHERE validation_status = 'INVALID'",
)
oracle(
    "order_validation_by_category",
    VALIDATION_VIEWS,
    f"""WITH {VALIDATED} SELECT validation_status, rejection_category, count(*) AS lines
        FROM validated GROUP BY validation_status, rejection_category""",
)


def part(columns: str) -> str:
    """First two digits of the digest that spreads the lines of an invoice."""
    texts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split())
    return f"substr(md5({texts}), 1, 2)"


def numbering(columns: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.split())
    return (
        f"row_number() OVER (PARTITION BY external_id, transaction_type ORDER BY {part(columns)}, {order})"
        " AS line_number"
    )


def merged(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN {a} ELSE coalesce({a} || ',' || {b}, {a}, {b}) END"


def priced(source: str) -> str:
    return f"""
    SELECT * EXCLUDE (credits, total),
           coalesce(credits, total) AS quantity, total AS amount, abs(coalesce(credits, total)) AS erp_quantity,
           abs(total) AS erp_amount, {rate('total', 'coalesce(credits, total)')} AS rate,
           CASE WHEN total >= 1 THEN 'Invoice' WHEN total < 0 THEN 'Credit Memo' ELSE 'None' END AS transaction_type
    FROM {source}"""


USAGE_ORDER = "billing_account_id crm_account_id account_tier revenue_type status item_id"
USAGE = f"""
    monthly AS (
        SELECT r.billing_account_id, r.crm_account_id, r.account_tier, r.type AS revenue_type, r.status,
               CAST(date_trunc('month', revenue_date_utc) AS DATE) AS revenue_month_start,
               CAST(sum(credits_used) AS DECIMAL(18,2)) AS credits, CAST(sum(amount) AS DECIMAL(18,2)) AS total
        FROM revenue_records r
        WHERE upper(r.type) LIKE '%OVERAGE%' OR upper(r.type) LIKE '%SELF%' GROUP BY ALL),
    enriched AS (
        SELECT m.*, last_day(revenue_month_start) AS revenue_month_end, a.payment_profile_id,
               CAST(c.id AS VARCHAR) AS erp_customer_id, c.name AS erp_customer_name,
               {merged('c.email', 'c.alt_email')} AS to_be_emailed, p.third_party_payer,
               p.id IS NOT NULL AND upper(revenue_type) NOT LIKE '%OVERAGE%' AS is_third_party_payer,
               p.id IS NOT NULL AND upper(revenue_type) NOT LIKE '%OVERAGE%' AS tax_override,
               CASE WHEN upper(revenue_type) NOT LIKE '%OVERAGE%' THEN p.id END AS partner_id,
               CASE WHEN upper(revenue_type) = 'SELF_SERVICE' AND p.id IS NULL THEN 'Autopay' ELSE 'Net 30' END
                 AS payment_term,
               i.id AS item_id
        FROM monthly m JOIN accounts a ON m.billing_account_id = a.id
        LEFT JOIN erp_customers c ON m.billing_account_id = c.billing_account_id AND NOT c.is_deleted
        LEFT JOIN partners p ON c.partner_id = p.id AND NOT p.is_deleted
        LEFT JOIN erp_items i ON m.account_tier = i.account_tier
          AND i.usage_type = CASE WHEN upper(revenue_type) LIKE '%OVERAGE%' THEN 2 ELSE 3 END),
    lines AS ({priced('enriched')}),
    named AS (SELECT *, CASE WHEN transaction_type = 'Credit Memo' THEN 'CM' ELSE 'INV' END || erp_customer_id
                        || strftime(revenue_month_end, '%Y%m') AS external_id FROM lines),
    usage AS (SELECT *, {numbering(USAGE_ORDER)} FROM named WHERE external_id IS NOT NULL)"""
USAGE_VIEWS = "revenue_records accounts erp_customers partners erp_items"
oracle("usage_invoices", USAGE_VIEWS, f"WITH {USAGE} SELECT * FROM usage")
oracle(
    "usage_revenue_conserved",
    "revenue_records accounts",
    f"""WITH monthly AS (
            SELECT r.billing_account_id, r.crm_account_id, r.account_tier, r.type, r.status,
                   CAST(date_trunc('month', revenue_date_utc) AS DATE) AS revenue_month_start,
                   CAST(sum(amount) AS DECIMAL(18,2)) AS amount
            FROM revenue_records r WHERE upper(r.type) LIKE '%OVERAGE%' OR upper(r.type) LIKE '%SELF%' GROUP BY ALL)
        SELECT revenue_month_start, count(*) AS lines, CAST(sum(amount) AS DECIMAL(28,2)) AS amount
        FROM monthly WHERE billing_account_id IN (SELECT id FROM accounts) GROUP BY 1""",
)
oracle(
    "usage_invoice_rejects",
    USAGE_VIEWS,
    f"""WITH {USAGE} SELECT *, CAST(NULL AS BIGINT) AS line_number, 'missing_erp_customer' AS reject_code,
        'account without customer: ' || billing_account_id AS reject_message
        FROM named WHERE external_id IS NULL""",
)
oracle(
    "invoice_totals_by_type",
    USAGE_VIEWS,
    f"""WITH {USAGE} SELECT revenue_month_start, transaction_type, count(*) AS line_count,
        CAST(sum(erp_amount) AS DECIMAL(18,2)) AS erp_amount, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
        FROM usage GROUP BY revenue_month_start, transaction_type""",
)
LACKS = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) = '' THEN '{c}' END"
    for c in (
        "external_id erp_customer_id item_id to_be_emailed transaction_type erp_amount erp_quantity".split()
    )
) + ")"
oracle(
    "invoice_line_rejects",
    USAGE_VIEWS,
    f"""WITH {USAGE} SELECT external_id, line_number, transaction_type, 'missing_fields' AS reject_code,
        'line lacks [' || {LACKS} || '] for account ' || billing_account_id AS reject_message
        FROM usage WHERE {LACKS} <> ''""",
)

PRODUCT_LINES = f"""
    monthly AS (
        SELECT billing_account_id, type AS revenue_type, product_type, status,
               CAST(date_trunc('month', revenue_date_utc) AS DATE) AS revenue_month_start,
               CAST(sum(credits_used) AS DECIMAL(18,2)) AS credits, CAST(sum(amount) AS DECIMAL(18,2)) AS total
        FROM revenue_records WHERE NOT is_deleted AND product_type = 'LINE_B' GROUP BY ALL),
    details AS (SELECT id, payment_profile_id FROM billing_info WHERE NOT is_deleted
                QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST,
                                           payment_profile_id DESC NULLS LAST) = 1),
    buyers AS (SELECT * FROM erp_customers
               WHERE NOT is_deleted AND inactive = 'F' AND entity_status = 13 AND is_person = 'F'
               QUALIFY row_number() OVER (PARTITION BY billing_account_id ORDER BY id) = 1),
    enriched AS (
        SELECT m.*, last_day(revenue_month_start) AS revenue_month_end, d.payment_profile_id,
               CAST(b.id AS VARCHAR) AS erp_customer_id, b.name AS erp_customer_name,
               {merged('b.email', 'b.alt_email')} AS to_be_emailed,
               (SELECT min(id) FROM erp_items WHERE item_code = 'ITEM3' AND NOT is_deleted) AS item_id,
               'Autopay' AS payment_term, 'monthly_product_revenue' AS billing_sync
        FROM monthly m LEFT JOIN details d ON m.billing_account_id = d.id
        LEFT JOIN buyers b ON m.billing_account_id = b.billing_account_id),
    lines AS ({priced('enriched')})"""
PRODUCT_NAME = """CASE WHEN transaction_type = 'Credit Memo' THEN 'PCM' ELSE 'PINV' END || erp_customer_id
                  || strftime(revenue_month_end, '%Y%m') AS external_id"""
PRODUCT_ORDER = "billing_account_id revenue_type status"
PRODUCT_VIEWS = "revenue_records billing_info erp_customers erp_items"
PRODUCT = f"""{PRODUCT_LINES}, named AS (SELECT *, {PRODUCT_NAME} FROM lines),
    product AS (SELECT *, {numbering(PRODUCT_ORDER)} FROM named WHERE external_id IS NOT NULL)"""
oracle("product_invoices", PRODUCT_VIEWS, f"WITH {PRODUCT} SELECT * FROM product")
oracle(
    "invoice_months_replaced",
    PRODUCT_VIEWS,
    f"""WITH {PRODUCT}, last AS (SELECT max(revenue_month_start) AS m FROM product)
    SELECT CAST(revenue_month_start AS DATE) AS revenue_month_start, count(*) AS line_count,
           CAST(sum(amount + CASE WHEN revenue_month_start = m THEN 1 ELSE 0 END) AS DECIMAL(28,2)) AS amount
    FROM product, last GROUP BY ALL""",
)
oracle(
    "product_invoices_one_row",
    PRODUCT_VIEWS,
    f"""WITH {PRODUCT_LINES}, single AS (
        SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY billing_account_id, revenue_month_start
                                                       ORDER BY revenue_type NULLS FIRST, status NULLS FIRST) = 1),
    named AS (SELECT *, {PRODUCT_NAME} FROM single)
    SELECT *, {numbering(PRODUCT_ORDER)} FROM named WHERE external_id IS NOT NULL""",
)

oracle(
    "payment_id_backfill",
    "payment_profiles accounts billing_info product_orgs erp_customers",
    """
    WITH ways AS (
        SELECT id AS account, payment_profile_id AS profile, 'MAIN' AS source FROM accounts WHERE NOT is_deleted
        UNION ALL
        SELECT * FROM (
            SELECT i.id, i.payment_profile_id, 'PRODUCT' FROM billing_info i
            WHERE NOT i.is_deleted
              AND EXISTS (SELECT 1 FROM product_orgs o WHERE o.billing_info_id = i.id AND NOT o.is_deleted)
            QUALIFY row_number() OVER (PARTITION BY i.id ORDER BY i.payment_profile_id DESC NULLS LAST) = 1) AS p),
    found AS (
        SELECT w.*, CAST(c.id AS VARCHAR) AS erp_customer_id
        FROM ways w LEFT JOIN erp_customers c ON w.account = c.billing_account_id AND NOT c.is_deleted
        WHERE w.profile IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY w.profile ORDER BY CAST(c.id AS VARCHAR) ASC NULLS LAST,
                                   w.source, w.account) = 1)
    SELECT p.id, f.erp_customer_id, 'https://erp.example.com/customer?id=' || f.erp_customer_id AS erp_customer_link,
           f.source AS product_source, f.account AS billing_account_id
    FROM payment_profiles p JOIN found f ON p.id = f.profile
    WHERE NOT p.is_deleted AND f.erp_customer_id IS NOT NULL
      AND CASE WHEN json_valid(p.metadata) THEN json_extract_string(p.metadata, '$.erp_customer_id') END IS NULL""",
)


def address(column: str, key: str) -> str:
    return f"CASE WHEN json_valid({column}) THEN json_extract_string({column}, '$.{key}') END"


def flat(column: str, prefix: str, attention: str, states: bool) -> str:
    """The columns an address is flattened to."""
    country = address(column, "country")
    state = address(column, "state")
    fixed = f"CASE {state} WHEN 'Old State' THEN 'New State' ELSE {state} END" if states else state
    return f"""
        {address(column, 'firstName')} AS "{prefix}_firstName", {address(column, 'lastName')} AS "{prefix}_lastName",
        {address(column, 'email')} AS {prefix}_email,
        CASE {country} WHEN 'UK' THEN 'GB' WHEN 'USA' THEN 'US' ELSE {country} END AS {prefix}_country,
        {fixed} AS {prefix}_state, {address(column, 'postalCode')} AS "{prefix}_postalCode",
        nullif(trim({json_name(column)}), '') AS {attention}"""


def lacking(columns: str) -> str:
    checks = []
    for c in columns.split():
        empty = f"{c} IS NULL OR {c} = ''" if "address" in c else blank(c)
        checks.append(f"CASE WHEN {empty} THEN '{c}' END")
    return f"concat_ws(', ', {', '.join(checks)})"


ORDER_FIELDS = "billing_address shipping_address legal_name billing_account_id"
ORDER_INPUT = f"""
    details AS (SELECT account_id, billing_address, shipping_address, legal_name FROM billing_info
                WHERE NOT is_deleted QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1),
    newest AS (SELECT * FROM sub_versions WHERE NOT is_deleted {NEWEST}),
    order_input AS (SELECT n.*, d.* EXCLUDE (account_id) FROM newest n
                    LEFT JOIN details d ON n.billing_account_id = d.account_id)"""


def year_offset(contract: str, service: str) -> str:
    diff = f"((year({service}) - year({contract})) * 12 + month({service}) - month({contract}))"
    return f"CASE WHEN {diff} >= 0 THEN {diff} // 12 END"


FAMILY = """CASE WHEN upper(replace(billing_frequency, '_', ' ')) LIKE '%SEMI%'
                   OR upper(billing_frequency) LIKE '%HALF%' THEN 'Semi-Annual'
                 WHEN upper(billing_frequency) LIKE '%QUARTER%' THEN 'Quarterly'
                 WHEN upper(billing_frequency) LIKE '%ANNUAL%' OR upper(billing_frequency) LIKE '%UPFRONT%'
                   OR upper(replace(billing_frequency, '_', ' ')) LIKE '%UP FRONT%' THEN 'Annual'
                 WHEN upper(billing_frequency) LIKE '%MONTH%' THEN 'Monthly' END"""


def schedule(contract: str, service: str) -> str:
    year = year_offset(contract, service)
    return f"""
        CASE WHEN {FAMILY} IS NOT NULL AND {year} BETWEEN 0 AND 2
             THEN {FAMILY} || ' - Yr ' || CAST({year} + 1 AS VARCHAR) ELSE 'REVIEW NEEDED' END
          AS billing_schedule_suggested,
        {year} AS billing_schedule_year_offset,
        CASE WHEN {contract} IS NULL OR {service} IS NULL THEN 'Invalid/Missing Dates'
             WHEN {year} = 0 THEN 'Scenario 1: 1 Year' WHEN {year} BETWEEN 1 AND 2 THEN 'Scenario 2: Multi-Year'
             ELSE 'Scenario 3: Non-Standard' END AS billing_schedule_scenario,
        NOT ({FAMILY} IS NOT NULL AND coalesce({year} BETWEEN 0 AND 2, false)) AS billing_schedule_needs_review"""


def prepared(total_test: str, total_code: str) -> str:
    return f"""{ORDER_INPUT},
    flat AS (
        SELECT o.* EXCLUDE (billing_address, shipping_address, payer_type), {PAYER_NAME} AS payer_type,
               {lacking(ORDER_FIELDS)} AS lacks, names.partner_name,
               {flat('billing_address', 'billing', 'billing_attention', False)},
               {flat('shipping_address', 'shipping', 'shipping_attention', False)}
        FROM order_input o
        LEFT JOIN partner_names names ON trim(o.third_party_payer_id) = names.payer_id
          AND names.partner_name IS NOT NULL),
    gated AS (
        SELECT * EXCLUDE (lacks, partner_name),
               {rate('amount', 'product_quantity')} AS rate,
               CASE WHEN payer_type IN ('Marketplace', 'Reseller', 'Reseller_Marketplace') THEN partner_name END
                 AS third_party_payer_name,
               partner_name AS partner,
               partner_name IS NOT NULL
                 AND payer_type IN ('Reseller_Marketplace', 'Marketplace') AS is_partner,
               CASE WHEN lacks <> '' THEN 'missing_fields'
                    WHEN payer_type = 'Reseller' AND partner_name IS NULL THEN 'invalid_reseller_mapping' END
                 AS early_code,
               CASE WHEN lacks <> ''
                    THEN 'lacks ' || lacks || ' (account '
                         || coalesce(billing_account_id, '') || ')'
                    WHEN payer_type = 'Reseller' AND partner_name IS NULL
                    THEN 'no partner is known for payer '''
                         || coalesce(third_party_payer_id, '(empty)') || '''.' END AS early_message,
               CASE WHEN product_code IN ('ECONOMY', 'LARGE')
                    THEN {months('CAST(contract_start_date AS DATE)',
                                 'CAST(coalesce(contract_end_date, end_date_utc) AS DATE)')} END AS term_months
        FROM flat),
    branded AS (
        SELECT g.*, {band('g.term_months')} AS term_band, b.band_item_id FROM gated g
        LEFT JOIN band_items b ON g.product_code = b.product_code AND b.term_band = {band('g.term_months')}),
    dated AS (
        SELECT *, CAST(start_date_utc AS DATE) AS service_start_date, CAST(end_date_utc AS DATE) AS service_end_date,
               CASE WHEN product_code IN ('STANDARD', 'SMALL') AND early_code IS NULL
                    THEN min(CASE WHEN early_code IS NULL THEN CAST(start_date_utc AS DATE) END)
                         OVER (PARTITION BY order_number, product_code)
                    ELSE CAST(start_date_utc AS DATE) END AS rr_start_date,
               CASE WHEN product_code IN ('STANDARD', 'SMALL') AND early_code IS NULL
                    THEN max(CASE WHEN early_code IS NULL THEN CAST(end_date_utc AS DATE) END)
                         OVER (PARTITION BY order_number, product_code)
                    ELSE CAST(end_date_utc AS DATE) END AS rr_end_date,
               {schedule('contract_start_date', 'start_date_utc')},
               sum(CASE WHEN early_code IS NULL THEN amount END) OVER (PARTITION BY order_number)
                 AS order_total
        FROM branded),
    judged AS (
        SELECT * EXCLUDE (early_code, early_message, order_total), CAST(order_total AS DECIMAL(28,4)) AS order_total,
               coalesce(early_code, CASE WHEN order_total {total_test} THEN '{total_code}' END) AS reject_code,
               coalesce(early_message, CASE WHEN order_total {total_test}
                 THEN 'Order ' || coalesce(order_number, 'null') || ' sums to '
                      || CAST(CAST(order_total AS DECIMAL(28,4)) AS VARCHAR) END) AS reject_message
        FROM dated)"""


PREPARED = prepared("<= 0", "zero_or_negative_total")
ORDER_VIEWS = "sub_versions billing_info partner_names band_items"
BRANDING = """CASE WHEN product_code = 'MEDIUM' THEN 'IMEDIUM' ELSE band_item_id END AS product_code_branding,
        CASE WHEN product_code = 'MEDIUM' THEN 'legacy_item' WHEN product_code NOT IN ('ECONOMY', 'LARGE')
             THEN 'default_no_banding' WHEN term_months IS NULL THEN 'band_term_error'
             WHEN band_item_id IS NULL THEN 'band_missing' ELSE 'banded' END AS alloc_strategy"""
oracle(
    "orders_valid",
    ORDER_VIEWS,
    f"""WITH {PREPARED}
    SELECT * EXCLUDE (reject_code, reject_message, band_item_id), {BRANDING},
           CASE WHEN product_code = 'MEDIUM' OR band_item_id IS NOT NULL THEN product_code END AS source_product_code
    FROM judged WHERE reject_code IS NULL""",
)
oracle(
    "orders_rejects",
    ORDER_VIEWS,
    f"""WITH {PREPARED} SELECT id, order_number, billing_account_id, third_party_payer_id, reject_code, reject_message
        FROM judged WHERE reject_code IS NOT NULL""",
)
METRICS = """
    SELECT 'total_input' AS metric, count(*) AS records FROM judged
    UNION ALL SELECT 'total_ingested', count(*) FROM judged WHERE reject_code IS NULL
    UNION ALL SELECT 'total_errored', count(*) FROM judged WHERE reject_code IS NOT NULL
    UNION ALL SELECT 'difference_ingested_vs_errored',
                     count(*) FILTER (WHERE reject_code IS NULL) - count(*) FILTER (WHERE reject_code IS NOT NULL)
              FROM judged
    UNION ALL SELECT 'rejected_' || reject_code, count(*) FROM judged WHERE reject_code IS NOT NULL
              GROUP BY reject_code"""
oracle("orders_metrics", ORDER_VIEWS, f"WITH {PREPARED} {METRICS}")
oracle("orders_written_metrics", ORDER_VIEWS, f"WITH {PREPARED} {METRICS}")
oracle(
    "orders_reject_samples",
    ORDER_VIEWS,
    f"""WITH {PREPARED}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY reject_code ORDER BY order_number NULLS FIRST, id NULLS FIRST, version NULLS FIRST,
            tie_part NULLS FIRST, tie_supplier NULLS FIRST, crm_line_id NULLS FIRST) AS sample_number
        FROM judged WHERE reject_code IS NOT NULL)
    SELECT reject_code, CAST(sample_number AS INTEGER) AS sample_number, order_number, id, version, tie_part, tie_supplier, crm_line_id
    FROM ranked WHERE sample_number <= 3""",
)
oracle(
    "orders_warnings",
    ORDER_VIEWS,
    f"""WITH {PREPARED} SELECT id, product_code, 'lookup_item_missing' AS warning_code,
        'item table lacks ' || product_code || ' for band ' || term_band AS warning_message
        FROM judged WHERE reject_code IS NULL AND product_code IN ('ECONOMY', 'LARGE') AND band_item_id IS NULL""",
)
oracle(
    "orders_refused_totals",
    ORDER_VIEWS,
    f"""WITH {PREPARED} SELECT order_number, min(billing_account_id) AS billing_account_id,
        max(order_total) AS total_amount, count(*) AS record_count
        FROM judged WHERE reject_code = 'zero_or_negative_total' GROUP BY order_number""",
)
oracle(
    "orders_zero_total_policy",
    ORDER_VIEWS,
    f"""WITH {prepared("= 0", "zero_total")}
    SELECT id, order_number, order_total,
           CASE WHEN product_code = 'MEDIUM' THEN 'IMEDIUM' WHEN product_code IN ('ECONOMY', 'LARGE')
                THEN product_code END AS product_code_branding,
           CASE WHEN product_code = 'MEDIUM' THEN 'legacy_item' WHEN product_code IN ('ECONOMY', 'LARGE')
                THEN 'banded' ELSE 'default_no_banding' END AS alloc_strategy
    FROM judged WHERE reject_code IS NULL""",
)

TERM = months("CAST(contract_start_date AS DATE)", "CAST(coalesce(contract_end_date, end_date_utc) AS DATE)")
oracle(
    "term_bands",
    "sub_versions",
    f"""SELECT id, version, tie_part, tie_supplier, product_code, term_months, {band('term_months')} AS term_band
        FROM (SELECT *, CASE WHEN product_code IN ('ECONOMY', 'LARGE') THEN {TERM} END AS term_months
              FROM sub_versions) AS termed""",
)
oracle(
    "billing_schedules",
    "sub_versions",
    f"""SELECT billing_frequency, billing_schedule_suggested, billing_schedule_year_offset,
               billing_schedule_scenario, billing_schedule_needs_review, count(*) AS versions
        FROM (SELECT billing_frequency, {schedule('contract_start_date', 'start_date_utc')} FROM sub_versions) AS s
        GROUP BY ALL""",
)
oracle(
    "group_date_span",
    "sub_versions",
    """SELECT id, version, tie_part, tie_supplier, order_number, product_code,
              CASE WHEN product_code IN ('STANDARD', 'SMALL') THEN min(CAST(start_date_utc AS DATE)) OVER w
                   ELSE CAST(start_date_utc AS DATE) END AS rr_start_date,
              CASE WHEN product_code IN ('STANDARD', 'SMALL') THEN max(CAST(end_date_utc AS DATE)) OVER w
                   ELSE CAST(end_date_utc AS DATE) END AS rr_end_date
       FROM sub_versions WINDOW w AS (PARTITION BY order_number, product_code)""",
)
oracle(
    "order_total_gate",
    "sub_versions",
    """SELECT order_number, CASE WHEN sum(amount) <= 0 THEN 'zero_or_negative_total' END AS reject_code,
              count(*) AS versions, CAST(sum(amount) AS DECIMAL(18,2)) AS order_total
       FROM sub_versions GROUP BY order_number""",
)

ACCOUNT_INPUT = """
    account_input AS (
        SELECT *, account_id AS billing_account_id,
               CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'STANDARD' END AS type,
               CASE CAST(id AS BIGINT) % 3 WHEN 0 THEN 'Sales_Assisted' WHEN 1 THEN 'monthly' END AS contract_type,
               CASE CAST(id AS BIGINT) % 5 WHEN 0 THEN 'RESELLER' WHEN 1 THEN 'Customer' WHEN 2 THEN 'MARKETPLACE'
                    WHEN 3 THEN 'RESELLER_MARKETPLACE' ELSE 'Reseller' END AS payer_type,
               CASE CAST(id AS BIGINT) % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' || CAST(CAST(id AS BIGINT) % 97 AS VARCHAR)
                    ELSE CAST(CAST(id AS BIGINT) % 97 AS VARCHAR) END AS third_party_payer_id
        FROM billing_info)"""
ACCOUNTS = f"""{ACCOUNT_INPUT},
    flat AS (
        SELECT a.* EXCLUDE (billing_address, shipping_address, contract_type), {lacking(ORDER_FIELDS)} AS lacks,
               '' AS sales_rep,
               CASE WHEN contract_type IS NULL THEN NULL WHEN lower(contract_type) = 'sales_assisted' THEN 'Prepaid'
                    ELSE 'Self-Service' END AS contract_type,
               names.partner_name AS name,
               {flat('billing_address', 'billing', 'billaddress_attention', True)},
               {flat('shipping_address', 'shipping', 'shipping_attention', True)}
        FROM account_input a LEFT JOIN partner_names names
          ON trim(a.third_party_payer_id) = names.payer_id AND names.partner_name IS NOT NULL),
    mailed AS (
        SELECT *, concat_ws('; ', CASE WHEN billing_email IS NULL OR billing_email = '' THEN 'billing_email' END,
                            CASE WHEN shipping_email IS NULL OR shipping_email = '' THEN 'shipping_email' END)
                 AS mail_lacks,
               CASE WHEN third_party_payer_id = trim(third_party_payer_id) THEN name END AS partner
        FROM flat),
    judged AS (
        SELECT * EXCLUDE (lacks, name, mail_lacks),
               CASE WHEN partner IS NOT NULL AND payer_type IN ('MARKETPLACE', 'RESELLER_MARKETPLACE')
                    THEN 'true' ELSE 'false' END AS is_partner,
               CASE WHEN lacks <> '' THEN 'missing_fields'
                    WHEN payer_type = 'RESELLER' AND name IS NULL THEN 'invalid_reseller_mapping'
                    WHEN payer_type IN ('Customer', 'Reseller') AND mail_lacks <> '' THEN 'missing_email' END
                 AS reject_code,
               CASE WHEN lacks <> '' THEN 'lacks ' || lacks
                         || ' (account ' || billing_account_id || ')'
                         || coalesce(' (type ' || type || ')', '')
                    WHEN payer_type = 'RESELLER' AND name IS NULL
                    THEN 'no partner is known for payer '''
                         || coalesce(trim(third_party_payer_id), '') || '''.'
                    WHEN payer_type IN ('Customer', 'Reseller') AND mail_lacks <> ''
                    THEN 'this payer needs mail: ' || mail_lacks END AS reject_message
        FROM mailed)"""
oracle(
    "accounts_valid",
    "billing_info partner_names",
    f"WITH {ACCOUNTS} SELECT * EXCLUDE (reject_code, reject_message) FROM judged WHERE reject_code IS NULL",
)
oracle(
    "accounts_rejects",
    "billing_info partner_names",
    f"""WITH {ACCOUNTS} SELECT id, updated_at, payer_type, reject_code, reject_message
        FROM judged WHERE reject_code IS NOT NULL""",
)
oracle("accounts_metrics", "billing_info partner_names", f"WITH {ACCOUNTS} {METRICS}")

PRODUCT_ACCOUNTS = f"""
    taken AS (
        SELECT *, nullif({address('billing_address', 'email')}, '') AS billing_email,
               nullif({address('billing_address', 'country')}, '') AS billing_country,
               nullif({address('billing_address', 'postalCode')}, '') AS billing_zip
        FROM billing_info),
    judged AS (
        SELECT *, concat_ws(', ', CASE WHEN billing_email IS NULL THEN 'billing_email' END,
                            CASE WHEN billing_country IS NULL THEN 'billing_country' END,
                            CASE WHEN billing_zip IS NULL THEN 'billing_zip' END) AS lacks,
               CASE WHEN billing_address IS NULL THEN 'missing_fields'
                    WHEN NOT json_valid(billing_address) THEN 'invalid_billing_address'
                    WHEN billing_email IS NULL OR billing_country IS NULL OR billing_zip IS NULL
                    THEN 'fatal_missing_fields' END AS reject_code
        FROM taken)"""
oracle(
    "product_accounts_valid",
    "billing_info",
    f"""WITH {PRODUCT_ACCOUNTS} SELECT id, updated_at,
        CASE WHEN legal_name IS NULL OR legal_name = '' THEN billing_email ELSE legal_name END AS legal_name,
        billing_email, billing_country, billing_zip FROM judged WHERE reject_code IS NULL""",
)
oracle(
    "product_accounts_rejects",
    "billing_info",
    f"""WITH {PRODUCT_ACCOUNTS} SELECT id, updated_at, reject_code,
        CASE reject_code WHEN 'missing_fields' THEN 'lacks billing_address'
             WHEN 'invalid_billing_address' THEN 'billing_address is no JSON object'
             ELSE 'billing_address holds none of [' || lacks || ']' END
        || ' (account ' || account_id || ')' AS reject_message
        FROM judged WHERE reject_code IS NOT NULL""",
)

CHARACTER_SUM = "list_sum(list_transform(string_split({0}, ''), lambda x: unicode(x)))"
oracle(
    "control_totals",
    "sub_versions",
    f"""SELECT count(*) AS record_count, count(billing_account_id) AS valid_records,
        count(*) - count(billing_account_id) AS invalid_records, 0 AS bad_amounts,
        CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN amount END) AS DECIMAL(28,2)) AS total_amount,
        CAST(sum({CHARACTER_SUM.format('billing_account_id')}) AS BIGINT) AS hash_total,
        CAST(round(CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN amount END) AS DOUBLE)
                   / count(billing_account_id), 2) AS DECIMAL(28,2)) AS average_amount
        FROM sub_versions""",
)
ROUGH = """CASE WHEN CAST(product_quantity AS BIGINT) % 7 = 0 THEN repeat('9', 22)
                 WHEN CAST(product_quantity AS BIGINT) % 7 = 1 THEN 'twelve'
                 WHEN CAST(product_quantity AS BIGINT) % 7 = 2 THEN '' ELSE CAST(amount AS VARCHAR) END"""
oracle(
    "control_totals_rough",
    "sub_versions",
    f"""WITH rough AS (
            SELECT billing_account_id, {ROUGH} AS raw,
                   CASE WHEN {ROUGH} = '' THEN 0 ELSE TRY_CAST({ROUGH} AS DECIMAL(24,4)) END AS n FROM sub_versions)
        SELECT count(*) AS record_count, count(billing_account_id) AS valid_records,
               count(*) - count(billing_account_id) AS invalid_records,
               count(*) FILTER (billing_account_id IS NOT NULL AND n IS NULL AND raw IS NOT NULL) AS bad_amounts,
               CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN n END) AS DECIMAL(28,2)) AS total_amount,
               CAST(sum({CHARACTER_SUM.format('billing_account_id')}) AS BIGINT) AS hash_total,
               CAST(round(CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN n END) AS DOUBLE)
                          / count(billing_account_id), 2) AS DECIMAL(28,2)) AS average_amount
        FROM rough""",
)
oracle(
    "control_totals_observed",
    "sub_versions",
    f"""SELECT count(*) AS record_count, count(billing_account_id) AS valid_records,
        count(*) - count(billing_account_id) AS invalid_records, 0 AS bad_amounts,
        CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN amount END) AS DECIMAL(28,4)) AS total,
        CAST(sum({CHARACTER_SUM.format('billing_account_id')}) AS BIGINT) AS hash_total,
        count(*) - count(billing_account_id) AS errored FROM sub_versions""",
)
oracle(
    "control_totals_stamped",
    "sub_versions",
    f"""
    WITH totals AS (SELECT count(*) AS n, count(billing_account_id) AS k,
                           CAST(sum(CASE WHEN billing_account_id IS NOT NULL THEN amount END) AS DECIMAL(28,2)) AS t,
                           CAST(sum({CHARACTER_SUM.format('billing_account_id')}) AS BIGINT) AS h FROM sub_versions)
    SELECT id, version, tie_part, tie_supplier, billing_account_id, amount,
           CASE WHEN billing_account_id IS NOT NULL THEN n END AS control_record_count,
           CASE WHEN billing_account_id IS NOT NULL THEN k END AS control_valid_records,
           CASE WHEN billing_account_id IS NOT NULL THEN t END AS control_total_amount,
           CASE WHEN billing_account_id IS NOT NULL THEN h END AS control_hash_total,
           CASE WHEN billing_account_id IS NOT NULL
                THEN CAST(round(CAST(t AS DOUBLE) / k, 2) AS DECIMAL(28,2)) END AS control_average_amount,
           CASE WHEN billing_account_id IS NULL THEN 'invalid_record' END AS reject_code,
           CASE WHEN billing_account_id IS NULL THEN 'blank key (none)' END AS reject_message
    FROM sub_versions, totals""",
)


def cleaned(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR trim({column}) IN ('', '.00') THEN '0.00' ELSE {column} END AS {column}"


oracle(
    "clean_financial_lines",
    "financial_lines",
    f"""SELECT id, line_id, record_type, item, {', '.join(cleaned(c) for c in (
        'amount amount_remaining amount_paid applied_amount applied_paid applied_remaining linked_amount'.split()))},
        CASE WHEN lower(record_type) = 'invoice' THEN
             CASE WHEN lower(item) LIKE '%prepaid%' OR lower(item) LIKE '%services%' THEN 'Prepaid'
                  WHEN lower(item) LIKE '%evergreen%' THEN 'Self Service' ELSE 'Overage' END END AS invoice_type
        FROM financial_lines""",
)
oracle(
    "conformed_accounts",
    "accounts",
    """SELECT status, CAST(id AS DECIMAL(18,0)) AS id, CAST(synced_at AS DATE) AS synced_at, CAST(NULL AS VARCHAR) AS note,
              CAST(CASE status WHEN 'Customer' THEN 1 WHEN 'Lead' THEN 2 END AS INTEGER) AS rank FROM accounts""",
)
oracle(
    "inactive_flags",
    "accounts",
    """SELECT id, CASE status WHEN 'Customer' THEN 'Yes' WHEN 'Lead' THEN 'No' END AS active_status,
              CASE WHEN status = 'Customer' THEN 'No' ELSE 'Yes' END AS inactive FROM accounts""",
)

BARE_FOLDER = "replace(replace(replace(billing_account_id, '..', ''), '/', ''), chr(92), '')"
MANIFEST = f"""
    entries AS (
        SELECT batch_id, success, file_id, name, url, billing_account_id FROM manifest_files WHERE success
        UNION ALL SELECT DISTINCT batch_id, success, NULL, NULL, NULL, NULL FROM manifest_files WHERE false
        UNION ALL SELECT batch_id, success, NULL, NULL, NULL, NULL FROM manifest_files
                  WHERE NOT success AND url IS NOT NULL),
    judged AS (
        SELECT e.batch_id, e.file_id AS id,
               CASE WHEN name IS NULL THEN 'file_' || CAST(e.file_id AS VARCHAR) || '.pdf'
                    WHEN lower(name) LIKE '%.pdf' THEN name ELSE name || '.pdf' END AS file_name,
               CASE WHEN billing_account_id IS NULL OR billing_account_id = '' THEN 'unknown_billing_account_id'
                    WHEN regexp_full_match({BARE_FOLDER}, '[a-zA-Z0-9]+(_[a-zA-Z0-9]+){{0,3}}') THEN {BARE_FOLDER}
                    ELSE 'invalid_billing_account_format' END AS folder,
               c.content_type,
               CASE WHEN NOT success THEN 'upstream_failed' WHEN url IS NULL OR url = '' THEN 'missing_url'
                    WHEN content_url IS NULL THEN 'not_found'
                    WHEN NOT (content_type = 'application/pdf' OR lower(url) LIKE '%.pdf' OR head = '<!DOC')
                    THEN 'not_a_document' END AS reject_code
        FROM entries e LEFT JOIN file_contents c ON e.url = c.content_url),
    messages(reject_code, reject_message) AS (VALUES
        ('upstream_failed', 'the batch was not made'),
        ('missing_url', 'entry without url'), ('not_found', 'not among the stored files'),
        ('not_a_document', 'neither type, name nor first bytes tell a document'))"""
oracle(
    "document_manifest",
    "manifest_files file_contents",
    f"""WITH {MANIFEST} SELECT j.*, CASE WHEN j.reject_code IS NULL THEN folder || '/' || file_name END AS file_path,
        m.reject_message FROM judged j LEFT JOIN messages m ON j.reject_code = m.reject_code""",
)
ORACLE["document_manifest_listed"] = ORACLE["document_manifest"]
ORACLE["url_origins"] = """
    WITH shown AS (
        SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
    tried AS (
        SELECT page_id, CASE WHEN page_id % 7 = 6 THEN 'no url' ELSE CASE WHEN page_id % 3 = 0 THEN 'http://' ELSE 'https://' END
               || CASE page_id % 4 WHEN 1 THEN 'user@' || host WHEN 2 THEN host || ':8443' ELSE host END || '/a?b=1' END AS tried
        FROM shown)
    SELECT page_id, tried, starts_with(tried, 'https://m.ththth.example.net/') OR starts_with(tried, 'https://m.ththth.example.net:8443/')
           OR starts_with(tried, 'http://ththre.example.com/') OR starts_with(tried, 'https://therin.example.net/') AS allowed
    FROM tried"""
oracle(
    "batch_outcome",
    "manifest_files file_contents",
    f"""WITH {MANIFEST}, counts AS (SELECT batch_id, count(*) AS total_files, count(reject_code) AS failed
                                    FROM judged GROUP BY batch_id)
    SELECT batch_id, total_files, total_files - failed AS successful, failed,
           CAST(round((total_files - failed) * 100.0 / total_files, 2) AS DECIMAL(18,2)) AS success_rate,
           CASE WHEN failed = 0 THEN 'info' WHEN total_files > failed THEN 'warning' ELSE 'error' END AS level,
           CASE WHEN total_files > failed THEN 207 ELSE 400 END AS answer_code
    FROM counts""",
)
oracle(
    "batch_error_counts",
    "manifest_files file_contents",
    f"""WITH {MANIFEST} SELECT batch_id, reject_message AS error, count(*) AS occurrences
        FROM judged j JOIN messages m ON j.reject_code = m.reject_code GROUP BY batch_id, reject_message""",
)

OUTCOMES = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY batch_id, file_id ORDER BY attempted_at, attempt_id)
                   AS attempt FROM dispatch_attempts),
    ended AS (SELECT *, min(CASE WHEN status_code = 200 OR status_code BETWEEN 400 AND 499 THEN attempt END)
                   OVER (PARTITION BY batch_id, file_id) AS end_at,
                 max(attempt) OVER (PARTITION BY batch_id, file_id) AS last_try
              FROM numbered WHERE attempt <= 3),
    outcomes AS (SELECT batch_id, file_id, file_name, status_code, error, attempt AS attempts,
                        attempted_at AS finished_at, status_code = 200 AS success,
                        status_code BETWEEN 400 AND 499 AS no_retry
                 FROM ended WHERE attempt = coalesce(end_at, last_try))"""
oracle("dispatch_audit", "dispatch_attempts", f"WITH {OUTCOMES} SELECT * FROM outcomes")
oracle(
    "dispatch_summary",
    "dispatch_attempts",
    f"""WITH {OUTCOMES} SELECT batch_id, count(*) AS total_files, count(*) FILTER (WHERE success) AS successful,
        count(*) FILTER (WHERE NOT success) AS failed, CAST(sum(attempts) AS BIGINT) AS attempts,
        CAST(round(count(*) FILTER (WHERE success) * 100.0 / count(*), 2) AS DECIMAL(18,2)) AS success_rate
        FROM outcomes GROUP BY batch_id""",
)

RETAINED = """folder_id = 2 AND CAST(created AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-02-20'"""
oracle("retention_candidates", "stored_files", f"SELECT * FROM stored_files WHERE {RETAINED}")
oracle(
    "retention_summary",
    "stored_files",
    f"""SELECT folder_id, count(*) AS processed, count(*) FILTER (WHERE failed) AS errors,
        min(created) AS first_created, max(created) AS last_created
        FROM stored_files WHERE {RETAINED} GROUP BY folder_id""",
)
ORACLE["redact"] = """
    SELECT page_id, CASE WHEN length(u) > 100 THEN substr(u, 1, 50) || '...' || right(u, 30) ELSE u END AS url,
           '[REDACTED]' AS session_token, '[REDACTED]' AS api_key_id
    FROM (SELECT page_id, url || '?' || repeat('x', page_id % 90) AS u FROM pages) AS long_urls"""

ORACLE["redact_maps"] = """
    SELECT page_id, '[REDACTED]' AS authtoken, url AS host,
           CASE WHEN length(u) > 100 THEN substr(u, 1, 50) || '...' || right(u, 30) ELSE u END AS fullurl,
           CASE WHEN page_id % 2 = 0 THEN '[REDACTED]' END AS password, CASE WHEN page_id % 2 = 1 THEN 'abc' END AS word,
           CAST(NULL AS VARCHAR) AS apikey, true AS secret_gone, '[REDACTED]' AS inner_token, page_id AS inner_n
    FROM (SELECT page_id, url, url || '?' || repeat('x', page_id % 90) AS u FROM pages) AS long_urls"""

oracle(
    "contact_upsert_plan",
    "reps contacts recipients",
    """
    WITH active AS (SELECT customer_id, lower(trim(rep_email)) AS rep_email FROM reps
                    WHERE inactive = 'F' AND trim(coalesce(rep_email, '')) <> ''),
    known AS (SELECT customer_id, lower(trim(email)) AS email, max(contact_id) AS contact_id
              FROM contacts GROUP BY ALL),
    listed AS (SELECT customer_id, min(recipient_id) AS recipient_id FROM recipients WHERE level = 3 GROUP BY ALL)
    SELECT a.customer_id, a.rep_email, k.contact_id,
           CASE WHEN k.contact_id IS NULL THEN 'create_contact' ELSE 'flag_contact' END AS contact_action,
           l.recipient_id,
           CASE WHEN a.rep_email <> 'self.service@example.com'
                THEN CASE WHEN l.recipient_id IS NULL THEN 'create_recipient' ELSE 'update_recipient' END
                WHEN l.recipient_id IS NULL THEN 'none' ELSE 'deactivate_recipient' END AS recipient_action,
           CASE WHEN a.rep_email <> 'self.service@example.com' THEN 3 END AS recipient_level,
           TIMESTAMP '2001-08-01' AS customer_updated_at, '' AS customer_error
    FROM active a LEFT JOIN known k ON a.customer_id = k.customer_id AND a.rep_email = k.email
    LEFT JOIN listed l ON a.customer_id = l.customer_id""",
)

oracle(
    "quality_checks",
    USAGE_VIEWS + " billing_info product_orgs",
    f"""
    WITH usage_lines AS (WITH {USAGE} SELECT * FROM usage),
    product_lines AS (WITH {PRODUCT} SELECT * FROM product),
    orgs AS (SELECT DISTINCT billing_info_id AS k FROM product_orgs WHERE NOT is_deleted),
    strange AS (SELECT DISTINCT product_type FROM revenue_records WHERE product_type <> 'LINE_A'),
    checks AS (
        SELECT 'usage_rows_of_product_orgs' AS check_name, count(*) AS failures, CAST(NULL AS VARCHAR) AS detail
        FROM usage_lines WHERE billing_account_id IN (SELECT k FROM orgs)
        UNION ALL SELECT 'product_rows_outside_orgs', count(*), NULL FROM product_lines
                  WHERE billing_account_id NOT IN (SELECT k FROM orgs)
        UNION ALL SELECT 'invoice_line_repeats', count(*), NULL
                  FROM (SELECT 1 FROM product_lines GROUP BY external_id, transaction_type, line_number
                        HAVING count(*) > 1) AS repeats
        UNION ALL SELECT 'payment_term_other', count(*), NULL FROM product_lines WHERE payment_term <> 'Autopay'
        UNION ALL SELECT 'usage_with_product_prefix', count(*), NULL FROM usage_lines
                  WHERE external_id LIKE 'PINV%' OR external_id LIKE 'PCM%'
        UNION ALL SELECT 'product_rows_with_profile', count(payment_profile_id), NULL FROM product_lines
        UNION ALL SELECT 'revenue_rows_against_baseline', abs(count(*) - 1000), CAST(count(*) AS VARCHAR)
                  FROM revenue_records
        UNION ALL SELECT 'product_types_unexpected', count(*), min(product_type) FROM strange)
    SELECT *, failures = 0 AS passed FROM checks""",
)
