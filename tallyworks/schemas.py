"""Column lists, table schemas and the registry of reason codes."""

from __future__ import annotations

# The seven columns of a sales file, in their canonical order.
SALES_FIELDS = (
    "order_id",
    "order_date",
    "customer_id",
    "product_id",
    "quantity",
    "unit_price",
    "discount_rate",
)

# Reason codes a rejected row can carry.
ROW_CODES = (
    "MISSING_FIELD",
    "BAD_INT_ORDER_ID",
    "BAD_DATE_FORMAT",
    "BAD_INT_QUANTITY",
    "NON_NUMERIC_CURRENCY",
    "BAD_DECIMAL_PRICE",
    "BAD_DECIMAL_DISCOUNT",
    "DATE_IN_FUTURE",
    "DATE_OUT_OF_PERIOD",
    "QTY_NOT_POSITIVE",
    "QTY_EXCEEDS_THRESHOLD",
    "PRICE_NOT_POSITIVE",
    "PRICE_PRECISION",
    "DISCOUNT_EQ_ONE",
    "DISCOUNT_OUT_OF_RANGE",
    "UNKNOWN_CUSTOMER",
    "UNKNOWN_PRODUCT",
    "DUPLICATE_ORDER_ID",
)
# The code of a whole file refused, and the one of a repair (never a rejection).
SCHEMA_MISMATCH = "SCHEMA_MISMATCH"
KEY_NORMALIZED = "KEY_NORMALIZED"

# Column order of the two CSV outputs.
REJECTED_COLUMNS = (
    "source_file",
    "row_num",
    "reason_code",
    "reason_detail",
    "raw_payload",
    "rejected_at",
)
PREVIEW_COLUMNS = (
    "order_id",
    "order_date",
    "customer_id",
    "product_id",
    "quantity",
    "unit_price",
    "discount_rate",
    "gross_sales",
    "discount_amount",
    "net_sales",
    "row_num",
    "source_file",
)

PRICE = "decimal(12,2)"
RATE = "decimal(5,4)"
MONEY = "decimal(14,2)"


# Columns and types of the warehouse tables.
TABLES: dict[str, dict[str, str]] = {
    "stg_sales": {
        "run_id": "string",
        "source_file": "string",
        "row_num": "bigint",
        "order_id": "bigint",
        "order_date": "date",
        "customer_id": "string",
        "product_id": "string",
        "quantity": "int",
        "unit_price": "decimal(12,2)",
        "discount_rate": "decimal(5,4)",
        "loaded_at": "timestamp",
    },
    "fact_sales": {
        "sales_key": "bigint",
        "order_id": "bigint",
        "order_date": "date",
        "customer_key": "bigint",
        "product_key": "bigint",
        "quantity": "int",
        "unit_price": "decimal(12,2)",
        "discount_rate": "decimal(5,4)",
        "gross_sales": "decimal(14,2)",
        "discount_amount": "decimal(14,2)",
        "net_sales": "decimal(14,2)",
        "run_id": "string",
        "loaded_at": "timestamp",
        "source_file": "string",
    },
    "etl_rejected_sales": {
        "rejected_id": "bigint",
        "run_id": "string",
        "source_file": "string",
        "row_num": "bigint",
        "raw_payload": "string",
        "reason_code": "string",
        "reason_detail": "string",
        "reason_codes": "array<string>",
        "rejected_at": "timestamp",
    },
    "dim_customers": {
        "customer_key": "bigint",
        "customer_id": "string",
        "customer_name": "string",
        "region": "string",
        "segment": "string",
        "signup_date": "date",
        "updated_at": "timestamp",
    },
    "dim_products": {
        "product_key": "bigint",
        "product_id": "string",
        "product_name": "string",
        "category": "string",
        "list_price": "decimal(12,2)",
        "updated_at": "timestamp",
    },
    "etl_run_log": {
        "run_id": "string",
        "source_file": "string",
        "started_at": "timestamp",
        "finished_at": "timestamp",
        "rows_extracted": "bigint",
        "rows_valid": "bigint",
        "rows_rejected": "bigint",
        "rows_loaded": "bigint",
        "status": "string",
    },
}

# Sums of each file's facts, for a warehouse that keeps them; the key comes first.
SUMS = {
    "sums_by_day": {
        "order_date": "date", "order_lines": "bigint", "units": "bigint", "gross_sales": "decimal(24,2)",
        "discount_amount": "decimal(24,2)", "net_sales": "decimal(24,2)", "source_file": "string",
    },
    "sums_by_product": {
        "product_key": "bigint", "units": "bigint", "net_sales": "decimal(24,2)", "rates": "decimal(15,4)",
        "rated": "bigint", "source_file": "string",
    },
    "sums_by_customer": {
        "customer_key": "bigint", "order_lines": "bigint", "net_sales": "decimal(24,2)", "first_order": "date",
        "last_order": "date", "source_file": "string",
    },
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


# Columns that may hold nulls; every other one is NOT NULL.
NULLABLE = {
    "fact_sales": (),
    "stg_sales": (),
    "dim_customers": ("segment", "signup_date"),
    "dim_products": ("list_price",),
    "etl_rejected_sales": ("reason_detail",),
    "etl_run_log": (
        "finished_at",
        "rows_extracted",
        "rows_valid",
        "rows_rejected",
        "rows_loaded",
    ),
}
