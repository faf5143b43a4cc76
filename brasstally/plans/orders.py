"""Subscription lines to order lines ready for the ERP."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brasstally.functions.address import flatten_address
from brasstally.functions.dates import as_date, term_band, term_months, with_billing_schedule
from brasstally.functions.numbers import number_in, rate
from brasstally.functions.text import is_blank, is_empty, strip
from brasstally.operators.lookups import brought
from brasstally.operators.rules import open_judgement, refuse, required_fields
from brasstally.operators.skew import NONE_HOT, HotKeys, enrich, group_totals
from brasstally.plans.validation import PARTNER_PAYERS, PAYER_NAMES, Lookups, payer_name, with_item, with_partner
from brasstally.result import Result
from brasstally.sources.staging import staged, to_stage_by

# How a line's item was found.
NOT_BANDED = "default_no_banding"
BANDED = "banded"
BAND_MISSING = "band_missing"
BAND_TERM_ERROR = "band_term_error"
LEGACY_ITEM = "legacy_item"

# Which order totals are refused, and the code of each.
TOTAL_CODES = {"<=0": "zero_or_negative_total", "==0": "zero_total"}

# What the order rules read of the written lines, and what items, terms and dates are derived from.
RULE_COLUMNS = ("order_number", "amount", "reject_code", "reject_message")
DERIVING_COLUMNS = ("product_code", "start_date_utc", "end_date_utc", "contract_start_date", "contract_end_date")


@dataclass(frozen=True)
class OrderOptions:
    """Variants of the order preparation.

    total_policy: '<=0' refuses orders whose lines sum to zero or less, '==0' only zero.
    branding: 'item' puts the ERP item of the term band on the line, 'code' the product code.
    schedules: whether to suggest billing schedules.
    frequencies: columns that may tell how often is billed; the first filled one counts.
    grouped_products: products whose revenue dates span the whole order.
    """

    total_policy: str = "<=0"
    branding: str = "item"
    schedules: bool = True
    frequencies: Sequence[str] = ("billing_frequency", "subscription_billing_frequency", "billing_schedule")
    banded_products: Sequence[str] = ()
    grouped_products: Sequence[str] = ()
    countries: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)


def missing_order_fields() -> list[tuple[str, Column]]:
    return [
        ("billing_address", is_empty("billing_address")),
        ("shipping_address", is_empty("shipping_address")),
        ("legal_name", is_blank("legal_name")),
        ("billing_account_id", is_blank("billing_account_id")),
    ]


def missing_fields_message(names: Column) -> Column:
    return F.concat(
        F.lit("lacks "),
        names,
        F.lit(" (account "),
        F.coalesce("billing_account_id", F.lit("")),
        F.lit(")"),
    )


def term_columns(df: DataFrame, banded: Column) -> DataFrame:
    """``term_months`` and ``term_band`` for banded products, from contract dates where given."""
    start = as_date(F.coalesce("contract_start_date", "start_date_utc"))
    end = as_date(F.coalesce("contract_end_date", "end_date_utc"))
    return df.withColumn("term_months", F.when(banded, term_months(start, end))).withColumn(
        "term_band", F.when(banded, term_band("term_months"))
    )


def service_period() -> tuple[Column, Column]:
    """Start and end of service: the billing period, else the contract."""
    start = F.coalesce(as_date("start_date_utc"), as_date("contract_start_date"))
    return start, F.coalesce(as_date("end_date_utc"), as_date("contract_end_date"))


def service_dates(df: DataFrame) -> DataFrame:
    """Service dates from the billing period, else the contract; revenue dates start equal to them."""
    start, end = service_period()
    return df.withColumns(
        {"service_start_date": start, "service_end_date": end, "rr_start_date": start, "rr_end_date": end}
    )


def order_keys(hot: HotKeys | None) -> HotKeys:
    """Known hot order numbers as group keys; missing numbers are a group of their own."""
    found = hot or NONE_HOT
    keyed = found.mapped(lambda v: f"={v}")
    return HotKeys((*keyed.values, ""), False, found.splits) if found.nulls else keyed


# Fixed value: over how many groups lines without an order number are dealt while they are staged by order.
UNNUMBERED_PARTS = 1 << 20


def by_order(df: DataFrame) -> DataFrame:
    """Adds the group key of the order rules. A missing number is not the empty one."""
    return df.withColumn("_order", F.coalesce(F.concat(F.lit("="), "order_number"), F.lit("")))


def _dates_spanned(df: DataFrame, products: Sequence[str], hot: HotKeys, spread: Sequence[str]) -> DataFrame:
    counted = F.col("reject_code").isNull() if "reject_code" in df.columns else F.lit(True)
    spanned = group_totals(
        df.withColumn("_product", F.coalesce(strip("product_code"), F.lit(""))),
        ["_order", "_product"],
        {
            "_first": F.min(F.when(counted, F.col("service_start_date"))),
            "_last": F.max(F.when(counted, F.col("service_end_date"))),
        },
        hot=hot,
        spread=spread,
    )
    listed = F.col("_product").isin(*products) & counted
    return spanned.withColumns(
        {
            "rr_start_date": F.when(listed, F.col("_first")).otherwise(F.col("rr_start_date")),
            "rr_end_date": F.when(listed, F.col("_last")).otherwise(F.col("rr_end_date")),
        }
    ).drop("_product", "_first", "_last")


def _with_order_total(df: DataFrame, hot: HotKeys, spread: Sequence[str]) -> DataFrame:
    number = number_in(df, "amount").try_cast("decimal(24,4)")
    counted = F.when(F.col("reject_code").isNull(), F.coalesce(number, F.lit(0)))
    totalled = group_totals(
        df, ["_order"], {"order_total": F.sum(counted)}, hot=hot, spread=spread
    )
    return totalled.withColumn("order_total", F.col("order_total").cast("decimal(28,4)"))


def _figure_totals(keyed: DataFrame, products: Sequence[str]) -> dict[str, Column]:
    """The aggregates of one order: its total, and first and last service date of each listed product."""
    counted = F.col("reject_code").isNull()
    number = F.coalesce(number_in(keyed, "amount").try_cast("decimal(24,4)"), F.lit(0))
    totals = {"order_total": F.sum(F.when(counted, number))}
    for i, product in enumerate(products):
        start, end = (F.when(counted & (F.col("_product") == product), c) for c in service_period())
        totals |= {f"_first_{i}": F.min(start), f"_last_{i}": F.max(end)}
    return totals


def _order_figures(df: DataFrame, products: Sequence[str], hot: HotKeys, *, unnumbered_dealt: bool = False) -> DataFrame:
    """Adds ``order_total``, and for lines of listed products ``_first`` and ``_last`` service date of the product in its order.

    One aggregate per order serves all, with two columns for each listed product: an order
    has one row of figures, and its lines are moved once, by their order alone. Lines staged
    by their order are not moved. With ``unnumbered_dealt`` lines without an order number lie dealt over
    many groups (``_dealt_by_order``): they are one order still, whose one row of figures is sent to all tasks.
    """
    keyed = df.withColumn("_product", F.coalesce(strip("product_code"), F.lit("")))
    totals = _figure_totals(keyed, products)
    figured = group_totals(keyed, ["_order"], totals, hot=hot, spread=["crm_line_id"])
    if unnumbered_dealt:
        lone = F.col("order_number").isNull()
        whole = keyed.filter(lone).agg(*[c.alias(f"_whole_{n}") for n, c in totals.items()])
        figured = figured.crossJoin(F.broadcast(whole)).withColumns(
            {n: F.when(lone, F.col(f"_whole_{n}")).otherwise(F.col(n)) for n in totals}
        ).drop(*[f"_whole_{n}" for n in totals])
    none = F.lit(None).cast("date")
    first, last = F.when(F.lit(False), none), F.when(F.lit(False), none)
    for i, product in enumerate(products):
        same = F.col("_product") == product
        first, last = first.when(same, F.col(f"_first_{i}")), last.when(same, F.col(f"_last_{i}"))
    dated = figured.withColumns({"order_total": F.col("order_total").cast("decimal(28,4)"), "_first": first, "_last": last})
    return dated.drop(*[f"_{end}_{i}" for i in range(len(products)) for end in ("first", "last")])


def _dealt_by_order(df: DataFrame) -> DataFrame:
    """``by_order``, to be staged by it. Lines without an order number are dealt out by what they hold."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    dealt = F.concat(F.lit("#"), F.pmod(F.xxhash64(*plain), F.lit(UNNUMBERED_PARTS)).cast("string"))
    keyed = by_order(df)
    return to_stage_by(keyed.withColumn("_order", F.when(F.col("order_number").isNull(), dealt).otherwise(F.col("_order"))), "_order")


def _with_details(lines: DataFrame, details: DataFrame, options: OrderOptions) -> DataFrame:
    """Lines staged by order, with the billing details of their accounts and flat addresses. The lines are not moved."""
    flat = details if "billing_attention" in details.columns else flat_addresses(details, options)
    # Beside the flat ones, it is only asked whether there is an address.
    short = flat.withColumns({c: F.substring(c, 1, 1) for c in ("billing_address", "shipping_address")})
    pairs = lines.select("_order", "billing_account_id").filter(F.col("billing_account_id").isNotNull()).distinct()
    found = pairs.join(short, F.col("billing_account_id") == F.col("info_account")).drop("info_account")
    return brought(lines, found, "_order", "billing_account_id")


def _refuse_totals(df: DataFrame, policy: str) -> DataFrame:
    bad = F.col("order_total") <= 0 if policy == "<=0" else F.col("order_total") == 0
    message = F.concat(
        F.lit("Order "),
        F.coalesce("order_number", F.lit("null")),
        F.lit(" sums to "),
        F.col("order_total").cast("string"),
    )
    return refuse(df, bad, TOTAL_CODES[policy], message)


def group_date_span(
    df: DataFrame, products: Sequence[str], *, hot: HotKeys | None = None, spread: Sequence[str] = ("crm_line_id",)
) -> DataFrame:
    """For listed products, revenue dates from the first service start to the last service end
    of the product's accepted lines in the order."""
    if not products:
        return df
    return _dates_spanned(by_order(df), products, order_keys(hot), spread).drop("_order")


def order_total_gate(
    df: DataFrame,
    policy: str = "<=0",
    *,
    hot: HotKeys | None = None,
    spread: Sequence[str] = ("crm_line_id",),
) -> DataFrame:
    """Refuse every line of an order whose accepted amounts sum to zero (or less).

    The sum runs over the whole table. An amount that is no number, or too large
    for one, counts as 0; lines without an order number are one order, those with an
    empty one another.
    """
    return _refuse_totals(_with_order_total(by_order(df), order_keys(hot), spread), policy).drop("_order")


def flat_addresses(details: DataFrame, options: OrderOptions = OrderOptions()) -> DataFrame:
    """Billing details with both addresses flat beside their text: parsed once per detail, not once per line."""
    flat = flatten_address(details, "billing_address", "billing", countries=options.countries)
    return flatten_address(flat, "shipping_address", "shipping", countries=options.countries)


def prepare_subscription_orders(
    subs: DataFrame,
    lookups: Lookups,
    options: OrderOptions = OrderOptions(),
    *,
    hot: Mapping[str, HotKeys] | None = None,
    columns: Sequence[str] | None = None,
    details: DataFrame | None = None,
) -> Result:
    """Checked, addressed, priced, banded and dated order lines, judged line by line and order by order.

    Banding faults are warnings: the line stays. Lines joined with ``flat_addresses``
    of their billing details are not parsed again. ``columns`` names those of the result
    that the caller uses besides the refusal: only what they and the rules need is then moved and written.
    ``details`` are the billing details by ``info_account``, for lines that come without them: the lines are
    then staged by order without addresses, and the addresses of an order's accounts are sent to its lines.
    """
    heavy_orders = order_keys((hot or {}).get("order_number"))
    near = details is not None and not heavy_orders and columns is None
    if near:
        lines = staged(_dealt_by_order(subs).drop("order_number"), "order-lines")
        numbered = F.when(F.startswith("_order", F.lit("=")), F.substr("_order", F.lit(2))).alias("order_number")
        lines = lines.select(*[numbered if c == "order_number" else c for c in subs.columns], "_order")
        subs = _with_details(lines, details, options)
    elif details is not None:
        subs = subs.join(details, F.col("billing_account_id") == F.col("info_account"), "left").drop("info_account")
    checked = required_fields(open_judgement(subs), missing_order_fields(), missing_fields_message)
    flat = checked if "billing_attention" in checked.columns else flat_addresses(checked, options)
    flat = flat.drop("billing_address", "shipping_address")
    if options.defaults:
        flat = flat.withColumns({k: F.lit(v) for k, v in options.defaults.items()})

    third = F.col("third_party_payer_id")
    trimmed = strip(third)
    named = with_partner(flat, lookups.partner_names).withColumn(
        "payer_type", payer_name("payer_type")
    )
    by_third = F.coalesce(F.col("payer_type").isin("Marketplace", "Reseller", "Reseller_Marketplace"), F.lit(False))
    partnered = named.withColumns(
        {
            "rate": rate(number_in(named, "amount"), number_in(named, "product_quantity")),
            "third_party_payer_name": F.when(by_third & ~is_empty(third), F.col("partner_name")),
            # The partner is looked up by the id as it stands, the display name by its trimmed form.
            "partner": F.when(third == trimmed, F.col("partner_name")),
        }
    ).withColumns(
        {
            "is_partner": F.col("partner").isNotNull()
            & F.coalesce(F.col("payer_type").isin(*PARTNER_PAYERS), F.lit(False)),
            "third_party_payer_id": F.when(by_third & ~is_empty(third), trimmed).otherwise(third),
        }
    )
    gated = refuse(
        partnered,
        (F.col("payer_type") == PAYER_NAMES["RESELLER"]) & F.col("partner_name").isNull(),
        "invalid_reseller_mapping",
        F.concat(
            F.lit("no partner is known for payer '"),
            F.when(is_blank("third_party_payer_id"), "(empty)").otherwise(F.col("third_party_payer_id")),
            F.lit("'."),
        ),
    ).drop("partner_name")

    # The lines are written once: their orders' figures and the lines themselves are read from
    # there, so that what is behind them is evaluated once. The figures come before the row-level
    # rest: narrower rows are shuffled, and no generated method grows too large for the JIT compiler.
    if columns is not None:
        used = {*columns, *RULE_COLUMNS} | ({"crm_line_id"} if heavy_orders else set())
        if derives := not {*columns} <= {*gated.columns, "order_total"}:
            used |= {*DERIVING_COLUMNS, *(options.frequencies if options.schedules else ())}
        unread = {f.name: F.lit(None).cast(f.dataType) for f in gated.schema if f.name in DERIVING_COLUMNS and f.name not in used}
        gated = gated.select(*[c for c in gated.columns if c in used], *[none.alias(c) for c, none in unread.items()])
    products = options.grouped_products if columns is None or derives else ()
    if near:
        figured = _order_figures(gated, products, heavy_orders, unnumbered_dealt=True)
    elif heavy_orders:
        figured = _order_figures(by_order(staged(gated, "order-lines")), products, heavy_orders)
    else:
        figured = _order_figures(staged(_dealt_by_order(gated), "order-lines"), products, heavy_orders, unnumbered_dealt=True)
    coded = figured.withColumn("_code", F.coalesce(strip("product_code"), F.lit("")))
    banded = F.col("_code").isin(*options.banded_products) if options.banded_products else F.lit(False)
    itemed = with_item(term_columns(coded, banded), lookups, options.banded_products, "_code")
    term_failed = banded & F.col("term_months").isNull()
    lookup_failed = F.lit(False)
    brand = F.col("_code")
    if options.branding == "item":
        lookup_failed = banded & ~term_failed & F.col("band_item_id").isNull()
        brand = F.col("band_item_id")
    legacy = F.col("legacy_item_id").isNotNull()
    done = banded & ~term_failed & ~lookup_failed
    # With the product code as brand, a banded line keeps no separate source code.
    sourced = (done | legacy) if options.branding == "item" else legacy
    warning = "struct<code:string,message:string>"
    branded = itemed.withColumns(
        {
            "product_code_branding": F.when(legacy, F.col("legacy_item_id")).when(done, brand),
            "alloc_strategy": F.when(legacy, LEGACY_ITEM)
            .when(term_failed, BAND_TERM_ERROR)
            .when(lookup_failed, BAND_MISSING)
            .when(done, BANDED)
            .otherwise(NOT_BANDED),
            "source_product_code": F.when(sourced, F.col("_code")),
            "warnings": F.array_compact(
                F.array(
                    F.when(
                        term_failed,
                        F.struct(
                            F.lit("term_calc_failed").alias("code"),
                            F.lit("no term without both dates").alias("message"),
                        ),
                    ).cast(warning),
                    F.when(
                        lookup_failed,
                        F.struct(
                            F.lit("lookup_item_missing").alias("code"),
                            F.concat(
                                F.lit("item table lacks "), "_code", F.lit(" for band "), "term_band"
                            ).alias("message"),
                        ),
                    ).cast(warning),
                )
            ),
        }
    ).drop("band_item_id", "legacy_item_id", "_code")
    dated = service_dates(branded)
    if options.schedules:
        contract = F.coalesce(as_date("contract_start_date"), F.col("rr_start_date"))
        told = [F.when(~is_blank(c), F.col(c)) for c in options.frequencies if c in dated.columns]
        dated = with_billing_schedule(dated, F.coalesce(*told, F.lit(None).cast("string")), contract, "service_start_date")
    if options.grouped_products:
        listed = F.col("_product").isin(*options.grouped_products) & F.col("reject_code").isNull()
        dated = dated.withColumns(
            {
                "rr_start_date": F.when(listed, F.col("_first")).otherwise(F.col("rr_start_date")),
                "rr_end_date": F.when(listed, F.col("_last")).otherwise(F.col("rr_end_date")),
            }
        )
    judged = _refuse_totals(dated, options.total_policy).drop("_order", "_product", "_first", "_last")
    if columns is not None:
        judged = judged.select(*columns, *[c for c in ("reject_code", "reject_message") if c not in columns])
    return Result(judged)


def refused_orders(judged: DataFrame, policy: str = "<=0") -> DataFrame:
    """One row per order refused for its total, with how many lines went with it."""
    return (
        judged.filter(F.col("reject_code") == TOTAL_CODES[policy])
        .groupBy("order_number")
        .agg(
            F.min("billing_account_id").alias("billing_account_id"),
            F.first("order_total").alias("total_amount"),
            F.count("*").alias("record_count"),
        )
    )
