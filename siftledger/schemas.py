"""Declared relations: the raw feed, the reason vocabulary and the mart contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Source column order, reason codes, unknown-customer key, namespaces.
RAW_COLUMNS = (
    "transaction_id",
    "customer_id",
    "transaction_date",
    "product_id",
    "product_name",
    "quantity",
    "price",
    "tax",
)
REASON_CODES = (
    "price_not_numeric",
    "tax_not_numeric",
    "quantity_missing_or_invalid",
    "date_unparseable",
    "transaction_id_invalid",
    "price_non_positive",
    "tax_negative",
    "quantity_non_positive",
    "duplicate_transaction_id",
)
# Codes of this library's own: numbers that MONEY cannot hold.
RANGE_CODES = ("price_out_of_range", "tax_out_of_range")
UNKNOWN_CUSTOMER = -1
NAMESPACES = ("raw", "staging", "analytics", "dq_audit")

# Money is exact, with 18 digits before the point and six after it; sums have 32 before
# it. Larger numbers, and prices that would round to nothing, are rejected under codes of
# their own. The ``digits_lost`` checks count longer fractions, which are rounded, and
# larger numbers; a run stores both counts.
MONEY = T.DecimalType(24, 6)
SUBTOTAL = T.DecimalType(35, 6)
TOTAL = T.DecimalType(36, 6)


def field(name: str, dtype: T.DataType, comment: str = "", nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment} if comment else None)


_string, _long, _int, _bool = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_stamp, _date = T.TimestampType(), T.DateType()
_codes = T.ArrayType(_string, containsNull=False)

SOURCE_SCHEMA = T.StructType(
    [
        field("transaction_id", _string, "Transaction id as received; may carry a T prefix."),
        field("customer_id", _string, "Customer id as received; float form, may be empty."),
        field("transaction_date", _string, "Date as received; year-first or day-first."),
        field("product_id", _string, "Product id as received; may carry a P prefix."),
        field("product_name", _string, "Product name as received."),
        field("quantity", _string, "Quantity as received; float form, may be empty."),
        field("price", _string, "Unit price as received; may be words."),
        field("tax", _string, "Absolute tax amount as received; may be words."),
    ]
)

_LINEAGE = [
    field("_ingested_at", _stamp, "Start of the load that landed the row.", nullable=False),
    field("_source_file", _string, "Base name of the file the row came from."),
]


@dataclass(frozen=True)
class Relation:
    """A relation's place, description, columns and enforced constraints."""

    namespace: str
    name: str
    comment: str
    schema: T.StructType
    primary_key: str | None = None
    enforced: bool = False
    # The column that stored files are divided by, and how it follows from the others if
    # it is not one of them.
    partition: T.StructField | None = None
    partition_sql: str | None = None

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def stored_schema(self) -> T.StructType:
        """The declared columns, and the partition column if it is an added one."""
        added = [] if self.partition_sql is None else [self.partition]
        return T.StructType(self.schema.fields + added)

    @property
    def required(self) -> list[str]:
        """Columns that may not be NULL."""
        return [f.name for f in self.schema if not f.nullable]


RAW = Relation(
    "raw",
    "customer_transactions",
    "Landing zone: transactions as received, all text, never rejected for content.",
    T.StructType(SOURCE_SCHEMA.fields + _LINEAGE),
)

STAGED = Relation(
    "staging",
    "stg_customer_transactions",
    "Every received row with its original text, typed values, and verdict.",
    T.StructType(
        [field(f"{f.name}_raw", _string, f.metadata["comment"]) for f in SOURCE_SCHEMA]
        + [
            field("transaction_id", _long, "Typed id; NULL when unrecoverable."),
            field("customer_id", _long, "Typed customer id; NULL when unrecoverable."),
            field("transaction_date", _date, "Parsed date; NULL when unparseable."),
            field("product_id", _long, "Typed product id; NULL when unrecoverable."),
            field("product_name", _string, "Trimmed name; NULL when blank."),
            field("quantity", _int, "Quantity rounded half up to a whole number."),
            field("unit_price", MONEY, "Unit price; NULL when not numeric."),
            field("tax_amount", MONEY, "Absolute tax; NULL when not numeric."),
        ]
        + _LINEAGE
        + [
            field("is_duplicate_id", _bool, "True on every row whose typed id is shared."),
            field("dq_reasons", _codes, "Codes of the rules the row breaks, in rule order."),
            field("missing_customer", _bool, "Soft flag: kept, but without a customer."),
            field("is_valid", _bool, "True when no rule is broken."),
            field("subtotal", SUBTOTAL, "quantity * unit_price."),
            field("total_amount", TOTAL, "quantity * unit_price + tax_amount."),
        ]
    ),
    partition=field("is_valid", _bool, "True when no rule is broken."),
)

DIM_PRODUCT = Relation(
    "analytics",
    "dim_product",
    "Products, keyed by product id.",
    T.StructType(
        [
            field("product_id", _long, "Product key.", nullable=False),
            field("product_name", _string, "Product name.", nullable=False),
        ]
    ),
    primary_key="product_id",
    enforced=True,
)

DIM_CUSTOMER = Relation(
    "analytics",
    "dim_customer",
    "Customers, plus the unknown member -1.",
    T.StructType(
        [
            field("customer_id", _long, "Customer key; -1 stands for unknown.", nullable=False),
            field("is_unknown", _bool, "True for the unknown member.", nullable=False),
        ]
    ),
    primary_key="customer_id",
    enforced=True,
)

DIM_DATE = Relation(
    "analytics",
    "dim_date",
    "One row per calendar day.",
    T.StructType(
        [
            field("date_key", _int, "Day as yyyymmdd.", nullable=False),
            field("date_day", _date, "The day.", nullable=False),
            field("year", _int, "Calendar year."),
            field("month", _int, "Month of the year."),
            field("day", _int, "Day of the month."),
            field("month_name", _string, "Short English month name."),
            field("day_of_week", _int, "1 is Monday, 7 is Sunday."),
        ]
    ),
    primary_key="date_key",
    enforced=True,
)

FACT = Relation(
    "analytics",
    "fct_transactions",
    "One row per valid transaction.",
    T.StructType(
        [
            field("transaction_id", _long, "Transaction key.", nullable=False),
            field("customer_id", _long, "Customer key; -1 when unknown.", nullable=False),
            field("product_id", _long, "Product key.", nullable=False),
            field("date_key", _int, "Date key.", nullable=False),
            field("transaction_date", _date, "Day of the transaction.", nullable=False),
            field("quantity", _int, "Units sold.", nullable=False),
            field("unit_price", MONEY, "Price per unit.", nullable=False),
            field("subtotal", SUBTOTAL, "quantity * unit_price.", nullable=False),
            field("tax_amount", MONEY, "Absolute tax.", nullable=False),
            field("total_amount", TOTAL, "subtotal + tax_amount.", nullable=False),
            field("missing_customer", _bool, "The feed named no customer.", nullable=False),
            field("_ingested_at", _stamp, "Start of the load that landed the row."),
        ]
    ),
    primary_key="transaction_id",
    enforced=True,
    partition=field("month", _date, "First day of the month; files are divided by it."),
    partition_sql="CAST(trunc(transaction_date, 'month') AS DATE)",
)

QUARANTINE = Relation(
    "analytics",
    "quarantine_customer_transactions",
    "Rejected rows, verbatim, with the reasons.",
    T.StructType(
        [field(f"{f.name}_raw", _string, f.metadata["comment"]) for f in SOURCE_SCHEMA]
        + [
            field("dq_reasons", _codes, "Codes of the rules the row breaks."),
            field("_ingested_at", _stamp, "Start of the load that landed the row."),
            field("_quarantined_at", _stamp, "Run that quarantined the row."),
        ]
    ),
)

RUN_AUDIT = Relation(
    "analytics",
    "dq_run_audit",
    "Quality history: one row per run.",
    T.StructType(
        [
            field("invocation_id", _string, "Run id; unique."),
            field("run_started_at", _stamp, "Start of the run."),
            field("rows_received", _long, "Rows landed."),
            field("rows_modelled", _long, "Rows in the fact."),
            field("rows_quarantined", _long, "Rows rejected."),
            field("quarantine_pct", T.DecimalType(28, 1), "Rejected share of received rows."),
            field("n_price_not_numeric", _long, "Rows with this reason."),
            field("n_tax_not_numeric", _long, "Rows with this reason."),
            field("n_quantity_invalid", _long, "Rows with quantity_missing_or_invalid."),
            field("n_date_unparseable", _long, "Rows with this reason."),
            field("n_transaction_id_invalid", _long, "Rows with this reason."),
        ]
    ),
)

COMPLETENESS = Relation(
    "analytics",
    "dq_completeness",
    "How the received rows were divided, and whether they add up.",
    T.StructType(
        [
            field("rows_received", _long, "Rows landed."),
            field("rows_modelled", _long, "Rows in the fact."),
            field("rows_quarantined", _long, "Rows rejected."),
            field("reconciles", _bool, "Modelled and quarantined rows are the received rows."),
            field("quarantine_pct", T.DecimalType(28, 1), "Rejected share of received rows."),
        ]
    ),
)

_summed = T.DecimalType(38, 6)
_tax_summed = T.DecimalType(34, 6)
_average = T.DecimalType(28, 2)
_measures = [
    field("total_quantity", _long, "Units sold."),
    field("total_subtotal", _summed, "Revenue before tax."),
    field("total_tax", _tax_summed, "Tax."),
    field("total_amount", _summed, "Revenue with tax."),
]

MONTHLY_SALES = Relation(
    "analytics",
    "agg_monthly_sales",
    "Sales per calendar month.",
    T.StructType(
        [
            field("month", _date, "First day of the month."),
            field("num_transactions", _long, "Transactions."),
            field("num_customers", _long, "Known customers."),
            field("distinct_products", _long, "Products sold."),
            *_measures,
            field("avg_transaction_value", _average, "total_amount per transaction."),
            field("avg_units_per_transaction", _average, "Units per transaction."),
        ]
    ),
)

SALES_BY_CUSTOMER = Relation(
    "analytics",
    "agg_sales_by_customer",
    "Sales per customer; -1 gathers the unknown ones.",
    T.StructType(
        [
            field("customer_id", _long, "Customer key."),
            field("is_unknown", _bool, "True for the unknown member."),
            field("num_transactions", _long, "Transactions."),
            field("distinct_products", _long, "Products bought."),
            *_measures,
            field("avg_transaction_value", _average, "total_amount per transaction."),
            field("first_transaction_date", _date, "Earliest transaction."),
            field("last_transaction_date", _date, "Latest transaction."),
        ]
    ),
)

SALES_BY_PRODUCT = Relation(
    "analytics",
    "agg_sales_by_product",
    "Sales per product.",
    T.StructType(
        [
            field("product_id", _long, "Product key."),
            field("product_name", _string, "Product name."),
            field("num_transactions", _long, "Transactions."),
            *_measures,
            field("avg_unit_price", _average, "Mean unit price over transactions."),
            field("revenue_share_pct", T.DecimalType(28, 1), "Share of all revenue."),
        ]
    ),
)

MONTHLY_IDS = Relation(
    "analytics",
    "agg_monthly_ids",
    "Which customers and products a month has, as bitmaps of blocks of ids.",
    T.StructType(
        [
            field("month", _date, "First day of the month."),
            field("kind", _string, "customer (known ones) or product."),
            field("block", _long, "Number of the block of ids."),
            field("bits", T.BinaryType(), "One bit per id of the block."),
        ]
    ),
)

# What batches keep beside the marts.

LANDED_FILES = Relation(
    "raw",
    "landed_files",
    "One row per source file that a batch has landed.",
    T.StructType(
        [
            field("path", _string, "Where the file was."),
            field("name", _string, "Base name, as in _source_file."),
            field("size", _long, "Bytes."),
            field("modified_at", _stamp, "Last change of the file."),
            field("n_rows", _long, "Records without the header, counted apart from landing."),
            field("batch", _string, "Batch that landed it."),
        ]
    ),
)

ID_INDEX = Relation(
    "staging",
    "transaction_id_counts",
    "Rows per typed transaction id over all batches.",
    T.StructType(
        [
            field("transaction_id", _long, "Typed id."),
            field("n_rows", _long, "Rows that hold it."),
            field("n_added", _long, "Those of them that the last batch brought."),
            field("first_batch", _string, "Batch that brought the first."),
        ]
    ),
    primary_key="transaction_id",
)

PRODUCT_NAMES = Relation(
    "staging",
    "product_names",
    "Valid rows per product id and name.",
    T.StructType(
        [
            field("product_id", _long, "Product key."),
            field("product_name", _string, "Product name."),
            field("n_rows", _long, "Valid rows."),
        ]
    ),
)

PRODUCT_TOTALS = Relation(
    "staging",
    "product_totals",
    "Sums per product that batches add to and take from.",
    T.StructType(
        [
            field("product_id", _long, "Product key."),
            field("num_transactions", _long, "Transactions."),
            *_measures,
            field("price_sum", _tax_summed, "Sum of unit prices."),
        ]
    ),
)

CONTRACTS = tuple(r for r in (DIM_PRODUCT, DIM_CUSTOMER, DIM_DATE, FACT) if r.enforced)
