"""Bronze JSON -> silver entity tables.

Each entity is described by a field spec (output column, parse rule, JSON
path) plus its dedup order; one generic builder turns the spec into a
single projection over the parsed VARIANT payload, so every field is
extracted in one pass and stays inside whole-stage codegen.

Parse rules
  text     trimmed, blank -> NULL          title   title-cased (punctuation breaks)
  upper    upper-cased                      lower   lower-cased
  date     null-on-failure date             money   '$1,234.56' -> decimal(18,2)
  money0   money, NULL/bad -> 0.00          dec:p,s null-on-failure decimal(p,s)
  number   whole number (rounds), bigint    number0 number, NULL/bad -> 0
  rate0    percent -> rate decimal(18,6), default 0
  bool     lenient boolean words            bool!   strict boolean (raises on junk)
  json     the raw JSON text of an object / array
  email    validated, lower-cased e-mail    phone10 exactly 10 digits   phone10+ at least 10 digits
  name     letters, apostrophes, hyphens, spaces kept, title-cased
  name_ns  same without spaces             street  same keeping digits
  measure  number inside text with a unit, decimal(10,2)
  instant  zoned timestamp as an instant     wallclock  the timestamp as written, offset dropped (H7)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions import clean as S
from shelfspark.functions import metrics as M
from shelfspark.functions.keys import surrogate_key
from shelfspark.operators.dedup import OrderItem, latest_per_key
from shelfspark.operators.joins import flatten_items
from shelfspark.plans import orders as O

Field = tuple[str, str, str]  # (output column, rule, JSON path)


def _rule(text: Column, rule: str) -> Column:
    if rule == "text":
        return S.blank_to_null(text)
    if rule == "title":
        return F.nullif(S.title_case(F.trim(text)), F.lit(""))
    if rule == "upper":
        return F.nullif(F.upper(F.trim(text)), F.lit(""))
    if rule == "lower":
        return F.lower(F.trim(text))
    if rule == "date":
        return S.parse_date(text)
    if rule == "money":
        return S.parse_money(text)
    if rule == "money0":
        return S.parse_money(text, default="0")
    if rule.startswith("dec:"):
        p, s = rule[4:].split(",")
        return S.parse_decimal(text, int(p), int(s))
    if rule == "number":
        return S.parse_number(text)
    if rule == "number0":
        return F.coalesce(S.parse_number(text), F.lit(0).cast("bigint"))
    if rule == "rate0":
        return S.percent_to_rate(text)
    if rule == "bool":
        return S.parse_bool(text)
    if rule == "bool!":
        return S.parse_bool(text, strict=True)
    if rule == "json":
        return text
    if rule == "email":
        return S.valid_email(text)
    if rule == "phone10":
        return S.phone(text, exact=10)
    if rule == "phone10+":
        return S.phone(text, exact=None, minimum=10)
    if rule == "name":
        return S.clean_name(text)
    if rule == "name_ns":
        return S.clean_name(text, "A-Za-z0-9", strip_first=False)
    if rule == "street":
        return S.clean_name(text, "A-Za-z0-9' -")
    if rule == "title_strip":
        return S.clean_name(text, "A-Za-z0-9' -", strip_first=False)
    if rule == "prose":
        return F.trim(F.regexp_replace(text, r"[^A-Za-z0-9 '.,;:/()&%-]", ""))
    if rule == "specs":
        return F.trim(F.regexp_replace(text, r"[^A-Za-z0-9 '.,;:/()&%_=-]", ""))
    if rule == "measure":
        return S.parse_measure(text)
    if rule == "instant":
        return S.parse_ts(text, zoned=True)
    if rule == "wallclock":
        return S.parse_ts(F.regexp_replace(F.trim(text), r"([+-]\d\d:?\d\d|Z)$", ""))
    raise ValueError(f"unknown rule {rule!r}")


def extract(bronze: DataFrame, key: str, fields: Sequence[Field], clean_key: bool = True,
            file_date_pattern: str = config.FILE_DATE_PATTERN, payload: str = "raw_payload") -> DataFrame:
    """One projection: key, every spec'd field, snapshot date from the file name, load metadata.

    ``clean_key`` trims the key and turns blanks into NULL (entities whose NULL
    keys are dropped after the dedup); otherwise the bronze key is kept as
    delivered (entities filtered on the raw key before the dedup, P2).
    """
    v = F.try_parse_json(F.col(payload))
    cols = [(S.blank_to_null(key) if clean_key else F.col(key)).alias(key)]
    for name, rule, path in fields:
        cols.append(_rule(S.json_text(v, path), rule).alias(name))
    cols += [S.file_date("_source_file", file_date_pattern).alias("source_snapshot_date"),
             "_source_file", "_loaded_at", "_batch_id"]
    return bronze.select(*cols)


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem]) -> DataFrame:
    return latest_per_key(df, list(keys), list(order))


NEWEST_FILE: list[OrderItem] = [("source_snapshot_date", True, False), ("_loaded_at", True, False)]
NEWEST_FILE_TIE: list[OrderItem] = NEWEST_FILE + [("_source_file", True, False)]
NEWEST_LOAD: list[OrderItem] = [("_loaded_at", True, False), ("_source_file", True, False)]

# ---------------------------------------------------------------------------
# entity specs
# ---------------------------------------------------------------------------

CAMPAIGN_FIELDS: list[Field] = [
    ("campaign_name", "text", "$.campaign_name"), ("start_date", "date", "$.start_date"),
    ("end_date", "date", "$.end_date"), ("budget", "money", "$.budget"), ("total_cost", "money", "$.total_cost"),
    ("total_revenue", "money", "$.total_revenue"), ("roi_calculation", "dec:18,2", "$.roi_calculation"),
    ("demographics", "json", "$.demographics"),
]

CUSTOMER_FIELDS: list[Field] = [
    ("first_name", "name", "$.first_name"), ("last_name", "name", "$.last_name"),
    ("email_raw", "text", "$.email"), ("phone_raw", "text", "$.phone"),
    ("birth_date", "date", "$.birth_date"), ("registration_date", "date", "$.registration_date"),
    ("last_purchase_date", "date", "$.last_purchase_date"), ("last_modified_date", "date", "$.last_modified_date"),
    ("income_bracket", "upper", "$.income_bracket"), ("occupation", "name", "$.occupation"),
    ("loyalty_tier", "upper", "$.loyalty_tier"), ("preferred_communication", "upper", "$.preferred_communication"),
    ("preferred_payment_method", "title", "$.preferred_payment_method"),
    ("marketing_opt_in", "bool", "$.marketing_opt_in"), ("total_purchases", "number", "$.total_purchases"),
    ("total_spend", "money", "$.total_spend"),
    ("address_street", "street", "$.address.street"), ("address_city", "title", "$.address.city"),
    ("address_state", "upper", "$.address.state"), ("address_zip_code", "text", "$.address.zip_code"),
    ("address_country", "title", "$.address.country"),
]

EMPLOYEE_FIELDS: list[Field] = [
    ("first_name", "text", "$.first_name"), ("last_name", "text", "$.last_name"),
    ("email", "email", "$.email"), ("phone", "phone10+", "$.phone"),
    ("date_of_birth", "date", "$.date_of_birth"), ("department", "title", "$.department"),
    ("role", "title", "$.role"), ("education", "title", "$.education"),
    ("employment_status", "title", "$.employment_status"), ("hire_date", "date", "$.hire_date"),
    ("last_modified_date", "date", "$.last_modified_date"), ("manager_id", "text", "$.manager_id"),
    ("work_location", "text", "$.work_location"), ("salary", "money0", "$.salary"),
    ("current_sales", "money0", "$.current_sales"), ("sales_target", "money0", "$.sales_target"),
    ("performance_rating", "dec:5,2", "$.performance_rating"), ("certifications", "json", "$.certifications"),
    ("address_street", "title", "$.address.street"), ("address_city", "title", "$.address.city"),
    ("address_state", "upper", "$.address.state"), ("address_zip_code", "text", "$.address.zip_code"),
]

ORDER_FIELDS: list[Field] = [
    ("customer_id", "text", "$.customer_id"), ("store_id", "text", "$.store_id"),
    ("employee_id", "text", "$.employee_id"), ("campaign_id", "text", "$.campaign_id"),
    ("order_datetime", "wallclock", "$.order_date"), ("order_instant", "instant", "$.order_date"),
    ("order_date", "date", "$.order_date"), ("shipping_date", "date", "$.shipping_date"),
    ("delivery_date", "date", "$.delivery_date"), ("estimated_delivery_date", "date", "$.estimated_delivery_date"),
    ("order_discount_rate", "rate0", "$.discount_amount"), ("shipping_cost", "money0", "$.shipping_cost"),
    ("tax_amount", "money0", "$.tax_amount"), ("order_source", "title", "$.order_source"),
    ("order_status", "title", "$.order_status"), ("payment_method", "title", "$.payment_method"),
    ("shipping_method", "title", "$.shipping_method"),
    ("billing_street", "title", "$.billing_address.street"), ("billing_city", "title", "$.billing_address.city"),
    ("billing_state", "upper", "$.billing_address.state"), ("billing_zip_code", "text", "$.billing_address.zip_code"),
    ("shipping_street", "title", "$.shipping_address.street"), ("shipping_city", "title", "$.shipping_address.city"),
    ("shipping_state", "upper", "$.shipping_address.state"),
    ("shipping_zip_code", "text", "$.shipping_address.zip_code"),
]

ITEM_FIELDS: list[Field] = [
    ("product_id", "text", "$.product_id"), ("quantity", "number0", "$.quantity"),
    ("unit_price", "money0", "$.unit_price"), ("cost_price", "money0", "$.cost_price"),
    ("item_discount_rate", "rate0", "$.discount_amount"),
]

PRODUCT_FIELDS: list[Field] = [
    ("product_name", "name_ns", "$.name"), ("short_description", "prose", "$.short_description"),
    ("technical_specs", "specs", "$.technical_specs"), ("category", "name_ns", "$.category"),
    ("subcategory", "name_ns", "$.subcategory"), ("product_line", "name_ns", "$.product_line"),
    ("brand", "title", "$.brand"), ("color", "title", "$.color"), ("size", "title", "$.size"),
    ("unit_price", "money", "$.unit_price"), ("cost_price", "money", "$.cost_price"),
    ("stock_quantity", "number", "$.stock_quantity"), ("reorder_level", "number", "$.reorder_level"),
    ("supplier_id", "text", "$.supplier_id"), ("dimensions", "text", "$.dimensions"),
    ("warranty_period", "text", "$.warranty_period"), ("weight_kg", "measure", "$.weight"),
    ("launch_date", "date", "$.launch_date"), ("last_modified_date", "date", "$.last_modified_date"),
    ("is_featured", "bool!", "$.is_featured"),
]

STORE_FIELDS: list[Field] = [
    ("store_name", "title_strip", "$.store_name"), ("size_sq_ft", "number", "$.size_sq_ft"),
    ("employee_count", "number", "$.employee_count"), ("opening_date", "date", "$.opening_date"),
    ("address_street", "street", "$.address.street"), ("address_city", "title", "$.address.city"),
    ("address_state", "upper", "$.address.state"), ("address_zip_code", "text", "$.address.zip_code"),
    ("address_country", "title", "$.address.country"),
    ("sales_target", "money", "$.sales_target"), ("current_sales", "money", "$.current_sales"),
]

SUPPLIER_FIELDS: list[Field] = [
    ("supplier_name", "title", "$.supplier_name"), ("supplier_type", "title", "$.supplier_type"),
    ("credit_rating", "title", "$.credit_rating"), ("is_active", "bool!", "$.is_active"),
    ("last_modified_date", "date", "$.last_modified_date"), ("last_order_date", "date", "$.last_order_date"),
    ("lead_time_days", "number", "$.lead_time_days"), ("minimum_order_quantity", "number", "$.minimum_order_quantity"),
    ("payment_terms", "title", "$.payment_terms"), ("preferred_carrier", "title", "$.preferred_carrier"),
    ("tax_id", "text", "$.tax_id"), ("website", "lower", "$.website"),
    ("year_established", "number", "$.year_established"), ("categories_supplied", "json", "$.categories_supplied"),
    ("contact_person", "title", "$.contact_information.contact_person"),
    ("email", "email", "$.contact_information.email"), ("phone", "phone10+", "$.contact_information.phone"),
    ("address", "title", "$.contact_information.address"),
    ("contract_id", "text", "$.contract_details.contract_id"),
    ("contract_start_date", "date", "$.contract_details.start_date"),
    ("contract_end_date", "date", "$.contract_details.end_date"),
    ("contract_exclusivity", "bool!", "$.contract_details.exclusivity"),
    ("contract_renewal_option", "bool!", "$.contract_details.renewal_option"),
    ("average_delay_days", "dec:10,2", "$.performance_metrics.average_delay_days"),
    ("defect_rate", "dec:10,2", "$.performance_metrics.defect_rate"),
    ("on_time_delivery_rate", "dec:10,2", "$.performance_metrics.on_time_delivery_rate"),
    ("quality_rating", "title", "$.performance_metrics.quality_rating"),
    ("response_time_hours", "dec:10,2", "$.performance_metrics.response_time_hours"),
    ("returns_percentage", "dec:10,2", "$.performance_metrics.returns_percentage"),
]


# ---------------------------------------------------------------------------
# builders
# ---------------------------------------------------------------------------

def silver_campaigns(bronze: DataFrame) -> DataFrame:
    df = extract(bronze, "campaign_id", CAMPAIGN_FIELDS)
    df = df.withColumn("campaign_duration_days", M.duration_days("start_date", "end_date"))
    return _latest(df, ["campaign_id"], NEWEST_FILE).filter(F.col("campaign_id").isNotNull())


def silver_customers(bronze: DataFrame, as_of) -> DataFrame:
    df = extract(bronze, "customer_id", CUSTOMER_FIELDS)
    age = M.whole_years("birth_date", as_of)
    df = df.withColumns({
        "full_name": S.full_name("first_name", "last_name"),
        "email_id": S.valid_email("email_raw"), "email_valid": S.email_valid_flag("email_raw"),
        "phn_no": S.phone("phone_raw"), "phn_no_valid": S.phone_valid("phone_raw"),
        "standardized_address": F.nullif(S.join_parts(", ", "address_street", "address_city", "address_state",
                                                      "address_zip_code", "address_country"), F.lit("")),
        "customer_age": age, "customer_segment": M.age_band(age),
    }).drop("email_raw", "phone_raw")
    order = [("source_snapshot_date", True, False), ("last_modified_date", True, False), ("_loaded_at", True, False),
             ("_source_file", True, False)]
    return _latest(df, ["customer_id"], order).filter(F.col("customer_id").isNotNull())


def silver_employees(bronze: DataFrame) -> DataFrame:
    df = extract(bronze.filter(F.col("employee_id").isNotNull()), "employee_id", EMPLOYEE_FIELDS, clean_key=False)
    df = df.withColumn("full_name", S.full_name("first_name", "last_name", strict=True))
    return _latest(df, ["employee_id"], NEWEST_LOAD).filter(F.col("employee_id").isNotNull())


def silver_stores(bronze: DataFrame, as_of) -> DataFrame:
    df = extract(bronze, "store_id", STORE_FIELDS)
    ach = M.target_achievement_pct("current_sales", "sales_target")
    df = df.withColumns({
        "store_size_category": M.store_size_band("size_sq_ft"),
        "standardized_address": F.nullif(S.join_parts(", ", "address_street", "address_city", "address_state",
                                                      "address_zip_code", "address_country"), F.lit("")),
        "store_age_years": M.whole_years("opening_date", as_of),
        "sales_target_achievement_percentage": ach,
        "revenue_per_sq_ft": M.safe_ratio("current_sales", "size_sq_ft", 1.0, decimal_scale=2),
        "employee_efficiency": M.safe_ratio("current_sales", "employee_count", 1.0, decimal_scale=2),
        "performance_issue_flag": M.performance_issue(ach),
    })
    return _latest(df, ["store_id"], NEWEST_FILE).filter(F.col("store_id").isNotNull())


def silver_suppliers(bronze: DataFrame) -> DataFrame:
    df = extract(bronze.filter(F.col("supplier_id").isNotNull()), "supplier_id", SUPPLIER_FIELDS, clean_key=False)
    return _latest(df, ["supplier_id"], NEWEST_LOAD)


def _product_common(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "product_hierarchy": S.join_parts(" > ", "category", "subcategory", "product_line"),
        "profit_margin_percentage": M.margin_pct("unit_price", "cost_price"),
    })


def silver_products(bronze: DataFrame) -> DataFrame:
    """Latest attributes per product (names keep their spaces here)."""
    own = {"product_name": "street", "category": "street", "subcategory": "street", "product_line": "street",
           "short_description": "text", "technical_specs": "text"}
    fields = [(out, own.get(out, rule), path) for out, rule, path in PRODUCT_FIELDS]
    df = _product_common(extract(bronze, "product_id", fields))
    df = df.withColumn("low_stock_flag", M.low_stock("stock_quantity", "reorder_level"))
    return _latest(df, ["product_id"], NEWEST_FILE).filter(F.col("product_id").isNotNull())


def silver_product_history(bronze: DataFrame) -> DataFrame:
    """One row per (product, snapshot date); newest file wins within a day."""
    df = _product_common(extract(bronze.filter(F.col("product_id").isNotNull()), "product_id", PRODUCT_FIELDS))
    df = df.filter(F.col("product_id").isNotNull()).withColumns({
        "is_featured": F.coalesce("is_featured", F.lit(False)),
        "product_history_key": surrogate_key("product_id", "source_snapshot_date"),
        "low_stock_flag": M.low_stock("stock_quantity", "reorder_level", on_null=None),
        "profit_margin_percentage": M.margin_pct("unit_price", "cost_price", decimal_scale=None),
    })
    order = [("_source_file", True, False), ("_loaded_at", True, False)]
    return _latest(df, ["product_id", "source_snapshot_date"], order)


def order_item_rows(orders_bronze: DataFrame) -> DataFrame:
    """Every item of every delivered order version (J12), parsed."""
    v = F.try_parse_json(F.col("raw_payload"))
    base = orders_bronze.filter(F.col("order_id").isNotNull()).select(
        "order_id", S.json_field(v, "$.customer_id").alias("customer_id"),
        S.json_field(v, "$.store_id").alias("store_id"),
        S.parse_date(S.json_text(v, "$.order_date")).alias("order_date"),
        S.title_case(F.trim(S.json_text(v, "$.order_status"))).alias("order_status"),
        F.try_variant_get(v, "$.order_items", "array<variant>").alias("order_items"),
        S.file_date("_source_file").alias("source_snapshot_date"), "_source_file", "_loaded_at", "_batch_id")
    flat = flatten_items(base, "order_items", "item_data", "item_number")
    return flat.select(
        *[c for c in flat.columns if c != "item_data"],
        *[_rule(S.json_text("item_data", path), rule).alias(name) for name, rule, path in ITEM_FIELDS])


def silver_order_items(orders_bronze: DataFrame) -> DataFrame:
    items = order_item_rows(orders_bronze).withColumn("order_item_key", surrogate_key("order_id", "item_number"))
    return _latest(items, ["order_id", "item_number"], NEWEST_FILE_TIE)


def silver_orders(orders_bronze: DataFrame, as_of) -> DataFrame:
    """Header fields + item totals + metrics, newest version per order.

    Item totals cover every delivered version of the order (reference parity,
    H11).  ``order_hour`` and the time-of-day band use the wall-clock time as
    written (H7); ``order_instant`` keeps the zoned instant.
    """
    headers = extract(orders_bronze.filter(F.col("order_id").isNotNull()), "order_id", ORDER_FIELDS, clean_key=False)
    rollup = O.order_rollup(order_item_rows(orders_bronze))
    derived = O.with_order_metrics(O.order_header_items(headers, rollup), as_of)
    return _latest(derived, ["order_id"], NEWEST_FILE_TIE)
