"""The stand-in tables of ``workload/views.py`` in SQL, for the side-by-side check."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "sub_versions": """
        SELECT l_orderkey * 10 + l_linenumber AS id,
               CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS crm_line_id,
               'CRM' || CAST(o_custkey // 3 AS VARCHAR) AS crm_account_id,
               CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_number,
               CASE WHEN o_custkey % 101 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS billing_account_id,
               CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS version,
               l_partkey AS tie_part,
               l_suppkey AS tie_supplier,
               CASE o_orderstatus WHEN 'F' THEN 'FREE' WHEN 'P' THEN 'CROSS_SELL' ELSE 'STANDARD' END AS type,
               CASE WHEN p_type = 'PROMO' THEN 'Free_PROMO' ELSE p_type END AS product_code,
               CASE WHEN l_suppkey % 8 = 5 THEN 'reseller' WHEN l_suppkey % 4 = 0 THEN 'CUSTOMER'
                    WHEN l_suppkey % 4 = 1 THEN 'RESELLER' WHEN l_suppkey % 4 = 2 THEN 'MARKETPLACE'
                    ELSE 'RESELLER_MARKETPLACE' END AS payer_type,
               CASE WHEN l_suppkey % 4 <> 0 AND l_suppkey % 10 <> 3 THEN CAST(l_suppkey AS VARCHAR) END
                 AS third_party_payer_id,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * CASE WHEN l_orderkey % 50 = 0 THEN 0 WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                 AS DECIMAL(18,2)) AS amount,
               CAST(l_quantity AS DECIMAL(18,2)) AS product_quantity,
               CASE p_size % 5 WHEN 0 THEN 'ANNUAL_UPFRONT' WHEN 1 THEN 'SEMI_ANNUAL' WHEN 2 THEN 'quarterly'
                    WHEN 3 THEN 'Monthly' ELSE 'CUSTOM' END AS billing_frequency,
               l_shipdate AS start_date_utc,
               l_shipdate + to_days(CAST(l_quantity * 30 AS INTEGER)) AS end_date_utc,
               o_orderdate AS contract_start_date,
               CASE WHEN l_linenumber <> 7 THEN o_orderdate + to_days(l_linenumber * 200) END AS contract_end_date,
               CASE WHEN l_linenumber = 5 THEN l_shipdate END AS termination_date_utc,
               o_orderdate AS created_at,
               l_shipdate AS synced_at,
               l_tax = 0 AS is_evergreen,
               l_discount = 0 AS is_deleted
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "accounts": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Customer' WHEN 'MACHINERY' THEN 'Frozen'
                    WHEN 'FURNITURE' THEN 'Partner' ELSE 'Lead' END AS status,
               CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Free' ELSE 'Paid' END AS platform_tier,
               CASE WHEN c_acctbal < 0 THEN 'TRIAL_EXPIRED' END AS freeze_reason,
               CASE WHEN c_custkey % 5 <> 0 THEN 'P' || CAST(c_custkey AS VARCHAR) END AS payment_profile_id,
               TIMESTAMP '2001-07-31 00:00:00' - to_days(CAST(c_custkey % 900 AS INTEGER)) AS synced_at,
               c_custkey % 31 = 0 AS is_deleted
        FROM customer""",
    "billing_info": """
        SELECT CAST(k AS VARCHAR) AS id, CAST(k AS VARCHAR) AS account_id,
               CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN ' ' ELSE c_name END AS legal_name,
               'T' || CAST(k AS VARCHAR) AS tax_id,
               CASE WHEN kind <> 'current' OR k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN '{bad'
                    ELSE head || CASE WHEN k % 4 = 0 THEN '' ELSE mail END || tail
                         || CASE WHEN k % 29 = 0 THEN '' ELSE zip END || '"}' END AS billing_address,
               CASE WHEN kind = 'current' AND k % 23 <> 0
                    THEN head || CASE WHEN k % 37 = 0 THEN '' ELSE mail END || tail || zip || '"}' END
                 AS shipping_address,
               CASE WHEN kind = 'current' AND k % 5 <> 0 THEN 'P' || CAST(k AS VARCHAR)
                    WHEN kind = 'older' THEN 'Q' || CAST(k AS VARCHAR)
                    WHEN kind = 'deleted' THEN 'D' || CAST(k AS VARCHAR) END AS payment_profile_id,
               moment AS updated_at, moment AS synced_at, kind = 'deleted' AS is_deleted
        FROM (SELECT c_custkey AS k, c_name, kind,
                     '{"firstName":"' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Fn' || CAST(c_custkey AS VARCHAR) END
                     || '","lastName":"' || CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Ln' || CAST(c_custkey AS VARCHAR) END
                     || '","email":"' AS head,
                     'u' || CAST(c_custkey AS VARCHAR) || '@example.com' AS mail,
                     '","country":"' || CASE WHEN c_nationkey < 5 THEN 'UK' WHEN c_nationkey < 10 THEN 'USA'
                                             ELSE CAST(c_nationkey AS VARCHAR) END
                     || '","state":"' || CASE WHEN c_nationkey = 3 THEN 'Old State' ELSE 'S' END
                     || '","postalCode":"' AS tail,
                     'Z' || CAST(c_nationkey AS VARCHAR) AS zip,
                     CASE kind WHEN 'current'
                               THEN TIMESTAMP '2001-07-30 00:00:00' - to_days(CAST(c_custkey % 700 AS INTEGER))
                               WHEN 'older' THEN TIMESTAMP '1999-01-01 00:00:00'
                               ELSE TIMESTAMP '2001-07-31 00:00:00' END AS moment
              FROM customer JOIN (VALUES ('current', -1), ('older', 0), ('deleted', 1)) AS kinds(kind, remainder)
                ON remainder = -1 OR c_custkey % 6 = remainder) AS versions""",
    "product_orgs": """
        SELECT 'ORG' || CAST(s_suppkey // 2 AS VARCHAR) AS org_id,
               CAST(s_suppkey AS VARCHAR) AS billing_info_id, s_suppkey % 8 = 7 AS is_deleted
        FROM supplier""",
    "partner_names": """
        SELECT CAST(s_suppkey AS VARCHAR) AS payer_id,
               CASE WHEN s_acctbal >= 2000 THEN s_name END AS partner_name
        FROM supplier""",
    "item_map": """
        SELECT DISTINCT p_type AS product_code, 'I' || p_type AS erp_item_id FROM part""",
    "band_items": """
        SELECT product_code, term_band,
               CASE WHEN NOT (product_code = 'LARGE' AND term_band = 'Y3')
                    THEN erp_item_id || '_' || term_band END AS band_item_id
        FROM (SELECT DISTINCT p_type AS product_code, 'I' || p_type AS erp_item_id FROM part
              WHERE p_type IN ('ECONOMY', 'LARGE')) AS banded
        CROSS JOIN (VALUES ('Y1'), ('Y2'), ('Y3')) AS bands(term_band)""",
    "revenue_records": """
        SELECT CAST(user_id AS VARCHAR) AS billing_account_id,
               'CRM' || CAST(user_id // 3 AS VARCHAR) AS crm_account_id,
               ts + to_days(CAST(event_id % 3 * 31 AS INTEGER)) AS revenue_date_utc,
               'Tier' || CAST(user_id % 6 AS VARCHAR) AS account_tier,
               CASE WHEN event_type IN ('purchase', 'view') THEN 'SELF_SERVICE' WHEN event_type = 'click' THEN 'OVERAGE'
                    WHEN event_type = 'error' THEN 'Overage_Adjustment' ELSE 'PREPAID' END AS type,
               CASE WHEN event_type IN ('purchase', 'click') THEN 'LINE_A' ELSE 'LINE_B' END AS product_type,
               CASE WHEN event_id % 2 = 0 THEN 'BILLED' ELSE 'PENDING' END AS status,
               CASE WHEN event_type <> 'view'
                    THEN CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) END AS credits_used,
               CASE WHEN user_id % 25 = 7 THEN CAST(0.01 AS DECIMAL(18,2))
                    WHEN event_type = 'error' THEN -CAST(value AS DECIMAL(18,2))
                    ELSE CAST(value AS DECIMAL(18,2)) END AS amount,
               event_id % 50 = 0 AS is_deleted
        FROM events""",
    "erp_customers": """
        SELECT c_custkey + 100000 AS id, CAST(c_custkey AS VARCHAR) AS billing_account_id, c_name AS name,
               CASE WHEN c_custkey % 3 <> 1 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
               CASE WHEN c_custkey % 3 = 0 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@example.com'
                    WHEN c_custkey % 6 = 5 THEN NULL
                    ELSE 'alt' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS alt_email,
               CASE WHEN c_custkey % 4 = 0 THEN CAST(c_nationkey AS BIGINT) END AS partner_id,
               CASE WHEN c_acctbal < 0 THEN 'T' ELSE 'F' END AS inactive,
               CASE WHEN c_custkey % 10 = 9 THEN 6 ELSE 13 END AS entity_status,
               CASE WHEN c_custkey % 17 = 0 THEN 'T' ELSE 'F' END AS is_person,
               c_custkey % 43 = 0 AS is_deleted
        FROM customer""",
    "partners": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, 'payer_' || lower(n_name) AS third_party_payer,
               n_nationkey % 9 = 0 AS is_deleted
        FROM nation""",
    "erp_items": """
        SELECT CAST(n_nationkey AS BIGINT) + 500 AS id, 'ITEM' || CAST(n_nationkey AS VARCHAR) AS item_code,
               'Tier' || CAST(n_nationkey // 5 AS VARCHAR) AS account_tier,
               CAST(n_nationkey % 5 AS BIGINT) AS usage_type, false AS is_deleted
        FROM nation""",
    "payment_profiles": """
        SELECT 'P' || CAST(c_custkey AS VARCHAR) AS id,
               CASE c_custkey % 4 WHEN 0 THEN '{"erp_customer_id":"' || CAST(c_custkey + 100000 AS VARCHAR) || '"}'
                    WHEN 1 THEN '{"account":"' || CAST(c_custkey AS VARCHAR) || '"}'
                    WHEN 2 THEN '{bad' END AS metadata,
               c_custkey % 53 = 0 AS is_deleted
        FROM customer""",
    "crm_orders": """
        SELECT '  Ord' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 10 = 0 THEN '-c' ELSE '' END
                 AS order_number,
               'SO' || CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS account_id,
               o_orderstatus AS status, o_orderpriority AS type, o_orderdate AS effective_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
               CASE WHEN o_orderkey % 9 = 0 THEN 'true' ELSE 'false' END AS skip_export,
               CASE WHEN o_orderkey % 14 = 0 THEN 'true' ELSE 'false' END AS test_mode,
               CASE o_orderkey % 8 WHEN 0 THEN 'false' WHEN 1 THEN NULL ELSE 'true' END AS synced_flag,
               CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 5 <> 0 THEN 'E' || CAST(o_orderkey AS VARCHAR) END
                 AS erp_id,
               CASE WHEN o_orderkey % 12 = 0 THEN 'L' || CAST(o_orderkey AS VARCHAR) END AS legacy_erp_id,
               o_orderkey % 41 = 0 AS is_deleted
        FROM orders""",
    "erp_transactions": """
        SELECT 'ord' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 7 = 0 THEN '-e' ELSE '' END AS memo,
               'D' || CAST(o_orderkey AS VARCHAR) AS document_number, o_orderkey AS transaction_id,
               o_orderdate AS transaction_date, o_orderstatus AS transaction_status,
               CASE WHEN o_orderkey % 11 = 0 THEN 'Invoice' ELSE 'SalesOrd' END AS transaction_type,
               CASE WHEN o_orderkey % 13 = 0 THEN 'Secondary' ELSE 'Primary' END AS book_name,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS VARCHAR)
                 AS amount,
               CAST(o_custkey AS VARCHAR) AS billing_account_id
        FROM orders""",
    "erp_sales_orders": """
        SELECT ' ' || CAST(l_orderkey AS VARCHAR) AS memo,
               'SO' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
                 || CAST(l_partkey AS VARCHAR) AS document_number,
               l_shipdate AS transaction_date,
               CASE WHEN l_returnflag = 'N' THEN 'Invoice' ELSE 'Sales Order' END AS transaction_type
        FROM lineitem""",
    "owner_history": """
        SELECT event_id AS history_id, 'CRM' || CAST(user_id // 3 AS VARCHAR) AS crm_account_id,
               CASE WHEN event_type IN ('signup', 'view') THEN 'Owner' ELSE 'Phone' END AS field,
               CASE WHEN event_id % 6 = 0 THEN 'Text' ELSE 'EntityId' END AS data_type,
               CAST(event_id % 31 AS VARCHAR) AS old_value, CAST(event_id % 37 AS VARCHAR) AS new_value,
               ts AS created_date, event_id % 20 = 0 AS is_deleted
        FROM events""",
    "crm_accounts": """
        SELECT 'CRM' || CAST(k AS VARCHAR) AS id, k % 13 = 0 AS is_deleted
        FROM (SELECT DISTINCT c_custkey // 3 AS k FROM customer) AS ks""",
    "crm_account_map": """
        SELECT 'CRM' || CAST(c_custkey // 3 AS VARCHAR) AS crm_account_id,
               CASE WHEN c_custkey % 59 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS billing_account_id
        FROM customer""",
    "crm_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_custkey = 5 THEN 'Self.Service@example.com'
                    WHEN c_custkey % 10 <> 7 THEN 'Owner' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email
        FROM customer""",
    "dispatch_attempts": """
        SELECT 'b' || CAST(user_id AS VARCHAR) AS batch_id, event_id % 40 AS file_id,
               'file' || CAST(event_id % 40 AS VARCHAR) AS file_name,
               CASE event_type WHEN 'purchase' THEN 200 WHEN 'view' THEN 200 WHEN 'click' THEN 500
                    WHEN 'signup' THEN 503 ELSE 404 END AS status_code,
               CASE WHEN event_type NOT IN ('purchase', 'view') THEN 'HTTP ' || event_type END AS error,
               ts AS attempted_at, event_id AS attempt_id
        FROM events""",
    "manifest_files": """
        SELECT 'b' || CAST(page_id % 20 AS VARCHAR) AS batch_id, page_id % 20 <> 19 AS success,
               page_id * 2 + second AS file_id,
               CASE WHEN page_id % 9 = 0 THEN NULL WHEN page_id % 2 = 0 THEN 'doc' || CAST(page_id AS VARCHAR) || '.PDF'
                    ELSE 'doc' || CAST(page_id AS VARCHAR) END AS name,
               CASE WHEN second = 0 THEN url END AS url,
               CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '../ab/c' WHEN 2 THEN 'two_words'
                    WHEN 3 THEN 'a_b_c_d_e' ELSE 'one' END AS billing_account_id
        FROM pages CROSS JOIN (VALUES (0), (1)) AS parts(second)""",
    "file_contents": """
        SELECT url AS content_url, CASE WHEN page_id % 3 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
               substr(html, 1, 5) AS head
        FROM pages""",
    "stored_files": """
        SELECT page_id AS file_id, 'doc' || CAST(page_id AS VARCHAR) || '.pdf' AS name, page_id % 4 AS folder_id,
               TIMESTAMP '2024-01-01 08:00:00' + to_days(CAST(page_id % 60 AS INTEGER)) AS created,
               page_id % 16 = 0 AS failed
        FROM pages""",
    "financial_lines": """
        SELECT l_orderkey AS id, l_linenumber AS line_id,
               CASE WHEN l_linestatus = 'O' THEN 'INVOICE' ELSE 'CreditMemo' END AS record_type,
               CASE l_partkey % 5 WHEN 0 THEN 'Prepaid credits' WHEN 1 THEN 'Support SERVICES'
                    WHEN 2 THEN 'Evergreen plan' WHEN 3 THEN 'Usage' END AS item,
               CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ' .00' ELSE price END AS amount,
               CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN ' .00' ELSE price END AS amount_remaining,
               CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN ' .00' ELSE price END AS amount_paid,
               CASE l_linenumber WHEN 4 THEN NULL WHEN 5 THEN ' .00' ELSE price END AS applied_amount,
               CASE l_linenumber WHEN 5 THEN NULL WHEN 6 THEN ' .00' ELSE price END AS applied_paid,
               CASE l_linenumber WHEN 6 THEN NULL WHEN 7 THEN ' .00' ELSE price END AS applied_remaining,
               CASE l_linenumber WHEN 7 THEN '' ELSE price END AS linked_amount
        FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM lineitem) AS lines""",
    "reps": """
        SELECT c_custkey AS customer_id, CASE WHEN c_acctbal < 0 THEN 'T' ELSE 'F' END AS inactive,
               CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 1 THEN ' Self.Service@Example.com'
                    ELSE ' Rep' || CAST(c_custkey % 40 AS VARCHAR) || '@Example.com' END AS rep_email
        FROM customer""",
    "contacts": """
        SELECT o_custkey AS customer_id, o_orderkey AS contact_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'rep' || CAST(o_custkey % 40 AS VARCHAR) || '@example.com'
                    ELSE 'c' || CAST(o_orderkey AS VARCHAR) || '@example.com' END AS email
        FROM orders""",
    "recipients": """
        SELECT c_custkey AS customer_id, c_custkey + 900000 AS recipient_id, 1 + c_custkey % 4 AS level
        FROM customer""",
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named stand-in tables."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in names.split()]
    tail = body.strip()
    if tail.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + tail[5:]
    return "WITH " + ", ".join(parts) + " " + tail
