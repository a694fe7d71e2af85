"""Row judgement: every rule of every tier over each raw row, one verdict per row.

Rules are listed in the order their defects are reported: by tier, then by column. Each is one
predicate; a null predicate, as over a value that did not parse, does not fire. So a missing
or unreadable field silences the later rules on that field and no others.

A verdict is one bigint, ``fired``, with one bit per rule in that order; zero is a clean row.
The texts that explain it are made for rejected rows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import parsing as P
from tallyworks.functions.money import with_measures
from tallyworks.schemas import KEY_NORMALIZED, PRICE, RATE, ROW_CODES, SALES_FIELDS
from tallyworks.workspace import Workspace

DEFAULT_MAX_QUANTITY = 1000

IS_CLEAN = "fired = 0"

# Precedence tiers; the lowest one to fire gives the primary code.
MISSING, PARSE, RANGE, FOREIGN_KEY, FILE_SCOPE = 1, 2, 3, 4, 5
DETAIL_SEPARATOR = " | "

# A judged row keeps these; a value that does not fit is null, which the table audit refuses.
STORED = {"quantity": "int", "unit_price": PRICE, "discount_rate": "decimal(13,12)"}

# A row in the plain form: digits in 64 bits, an ISO date, ids in normal form, a price in cents, a rate from 0 to below 1.
# No other rule than those over typed values and an impossible date can fire on it.
PLAIN_MARK = "\x1f"
PLAIN_ROW = r"^" + PLAIN_MARK.join([
    r"[0-9]{1,18}+", r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[!-`]++", r"[!-`]++", r"[0-9]{1,9}+",
    r"[0-9]{1,9}+(?:\.[0-9]{1,2}+)?+", r"0(?:\.[0-9]{1,12}+)?+",
]) + r"\z"

# The code of each bit of a verdict: seven missing fields, then the other codes in their order.
RULE_CODES = (*["MISSING_FIELD"] * len(SALES_FIELDS), *ROW_CODES[1:])


@dataclass(frozen=True)
class Rule:
    code: str
    tier: int
    field: str
    fires: Column
    detail: Column


def _text(fields: tuple[str, ...] = SALES_FIELDS) -> Column:
    """The struct ``text``: raw fields, trimmed, the ids in normal form."""
    ids = ("customer_id", "product_id")
    return F.struct(*[(P.normal_key if c in ids else P.trimmed)(F.col(f"raw.{c}")).alias(c) for c in fields])


def _is_plain() -> Column:
    """One look at a whole row: every field is written the plain way, so casts alone read it. A null is not plain."""
    return F.concat_ws(PLAIN_MARK, *[F.col(f"raw.{c}") for c in SALES_FIELDS]).rlike(PLAIN_ROW)


def _usual_text(field: str) -> Column:
    """How the typed value of a field is usually written: what a plain row need not keep."""
    value = F.col(field)
    return (value.try_cast("decimal(4,2)") if field == "discount_rate" else value).cast("string")


def _odd_raw() -> Column:
    """The raw fields that typed values don't give back: all of a row that isn't plain, and of a plain one those not written
    the usual way. Null where none is left, as on most rows, which then carry no text twice."""
    odd = {c: F.when(~F.equal_null(F.col(f"raw.{c}"), _usual_text(c)), F.col(f"raw.{c}")) for c in SALES_FIELDS}
    kept = F.when(F.coalesce(*odd.values()).isNotNull(), F.struct(*[value.alias(c) for c, value in odd.items()]))
    return F.when(F.col("plain"), kept).otherwise(F.col("raw"))


def _whole_raw() -> Column:
    """The raw fields again, each as it was: a plain row has no null among them."""
    fields = [F.coalesce(F.col(f"raw.{c}"), _usual_text(c)).alias(c) for c in SALES_FIELDS]
    return F.when(F.col("plain"), F.struct(*fields)).otherwise(F.col("raw"))


def parsed(raw: DataFrame, price: str = P.WIDE_DECIMAL, rate: str = P.WIDE_DECIMAL) -> DataFrame:
    """Keep the raw fields in a struct ``raw`` and add the typed values; ``price`` and ``rate`` are their types. A
    quantity beyond 64 bits is held at the bound, so the range rules still see it.

    A ``plain`` row is read by casts. Any other has its trimmed fields in ``text``, which is null on a plain row: a
    predicate over ``text`` is null there, and costs nothing.
    """
    rows = raw.select("source_file", "row_num", F.struct(*SALES_FIELDS).alias("raw")).withColumn("plain", _is_plain())
    rows = rows.withColumn("text", F.when(~F.col("plain"), _text()))
    quantity = F.col("text.quantity")
    bound = F.when(quantity.startswith("-"), F.lit(-(2**63))).otherwise(F.lit(2**63 - 1))
    key = {c: F.col(f"text.{c}") for c in ("customer_id", "product_id")}

    def read(field: str, kind: str, value: Column) -> Column:
        return F.when(F.col("plain"), F.col(f"raw.{field}").try_cast(kind)).otherwise(value.try_cast(kind))

    return rows.withColumns(
        {
            "order_id": read("order_id", "bigint", P.to_integer(F.col("text.order_id"))),
            "order_date": read("order_date", "date", P.to_iso_date(F.col("text.order_date"))),
            **{c: read(c, "string", F.when(value != "", value)) for c, value in key.items()},
            "quantity": read("quantity", "bigint", F.coalesce(
                P.to_integer(quantity), F.when(P.is_integer(quantity), bound)
            )),
            # no text with a currency mark parses
            "unit_price": read("unit_price", price, P.to_decimal(F.col("text.unit_price"))),
            "discount_rate": read("discount_rate", rate, P.to_decimal(F.col("text.discount_rate"))),
            # read from the name once; the period looks at it several times
            "year_month": P.year_month(F.col("source_file")),
            "price_reads": P.is_decimal(F.col("text.unit_price")),
            "rate_reads": P.is_decimal(F.col("text.discount_rate")),
        }
    )


def _missing(field: str) -> Rule:
    return Rule(
        "MISSING_FIELD", MISSING, field, F.col(f"text.{field}") == "",
        F.lit(f"{field} is required but absent or empty"),
    )


def _unreadable(code: str, field: str, but: str, fires: Column | None = None) -> Rule:
    """The field is present and its typed column is null."""
    fires = F.col(field).isNull() if fires is None else fires
    return Rule(
        code, PARSE, field, (F.col("plain") | (F.col(f"text.{field}") != "")) & fires,
        F.concat(F.lit(f"{field} "), P.quoted(F.col(f"raw.{field}")), F.lit(f" {but}")),
    )


def _not_decimal(code: str, field: str, fires: Column) -> Rule:
    text = F.col(f"text.{field}")
    return Rule(
        code, PARSE, field, (text != "") & fires,
        F.concat(
            F.lit(f"{field} "), P.quoted(text),
            F.when(F.translate(text, "_", "").rlike(P.NON_FINITE),
                   F.lit(" is not a finite decimal"))
            .otherwise(F.lit(" is not a decimal")),
        ),
    )


def row_rules(today: dt.date, max_quantity: int) -> list[Rule]:
    """Tiers 1 to 3: rules that need only the row itself."""
    date, quantity = F.col("order_date"), F.col("quantity")
    price_text, rate_text = F.col("text.unit_price"), F.col("text.discount_rate")
    # a decimal is judged as written, so digits beyond any column's count too
    priced, rated = F.col("price_reads"), F.col("rate_reads")
    marked = price_text.rlike(P.CURRENCY_MARKS)
    period = P.file_period(F.col("source_file"), F.col("year_month"))
    iso = date.cast("string")
    month = F.substring(F.when(F.col("plain"), F.col("raw.order_date")).otherwise(iso), 1, 7)
    shown_quantity = P.integer_text(F.col("text.quantity"))
    return [
        *[_missing(field) for field in SALES_FIELDS],
        _unreadable("BAD_INT_ORDER_ID", "order_id", "is not an integer"),
        _unreadable("BAD_DATE_FORMAT", "order_date", "is not YYYY-MM-DD"),
        _unreadable("BAD_INT_QUANTITY", "quantity", "is not an integer"),
        _unreadable(
            "NON_NUMERIC_CURRENCY", "unit_price",
            "carries currency formatting; expected a bare decimal", marked,
        ),
        _not_decimal("BAD_DECIMAL_PRICE", "unit_price", ~marked & ~priced),
        _not_decimal("BAD_DECIMAL_DISCOUNT", "discount_rate", ~rated),
        Rule(
            "DATE_IN_FUTURE", RANGE, "order_date", date > F.lit(today),
            F.concat(F.lit("order_date "), iso, F.lit(f" is after today ({today.isoformat()})")),
        ),
        Rule(
            "DATE_OUT_OF_PERIOD", RANGE, "order_date", date.isNotNull() & (month != period),
            F.concat(F.lit("order_date "), iso, F.lit(" is outside the file's period "), period),
        ),
        Rule(
            "QTY_NOT_POSITIVE", RANGE, "quantity", quantity <= 0,
            F.concat(F.lit("quantity "), shown_quantity, F.lit(" must be greater than zero")),
        ),
        Rule(
            "QTY_EXCEEDS_THRESHOLD", RANGE, "quantity", quantity > max_quantity,
            F.concat(
                F.lit("quantity "), shown_quantity,
                F.lit(f" exceeds the {max_quantity} outlier threshold"),
            ),
        ),
        Rule(
            "PRICE_NOT_POSITIVE", RANGE, "unit_price",
            F.when(F.col("plain"), F.col("unit_price") == 0).otherwise(
                priced & (P.is_negative(price_text) | P.is_zero(price_text))),
            F.concat(
                F.lit("unit_price "), P.decimal_text(price_text),
                F.lit(" must be greater than zero"),
            ),
        ),
        Rule(
            "PRICE_PRECISION", RANGE, "unit_price",
            priced & (P.decimal_places(price_text) > 2),
            F.concat(
                F.lit("unit_price "), price_text, F.lit(" has more than two decimal places")
            ),
        ),
        Rule(
            "DISCOUNT_EQ_ONE", RANGE, "discount_rate", rated & P.is_one(rate_text),
            F.lit("discount_rate is exactly 1.0, which posts zero revenue"),
        ),
        Rule(
            "DISCOUNT_OUT_OF_RANGE", RANGE, "discount_rate",
            rated & (P.is_negative(rate_text) | P.is_above_one(rate_text)),
            F.concat(
                F.lit("discount_rate "), P.decimal_text(rate_text), F.lit(" is outside [0, 1)")
            ),
        ),
    ]


def reference_rules() -> list[Rule]:
    """Tiers 4 and 5: rules answered by the exception sets joined to the row."""
    return [
        Rule(
            "UNKNOWN_CUSTOMER", FOREIGN_KEY, "customer_id", F.col("unknown_customer"),
            F.concat(
                F.lit("customer_id "), P.quoted(F.col("customer_id")),
                F.lit(" is not in the customer reference set"),
            ),
        ),
        Rule(
            "UNKNOWN_PRODUCT", FOREIGN_KEY, "product_id", F.col("unknown_product"),
            F.concat(
                F.lit("product_id "), P.quoted(F.col("product_id")),
                F.lit(" is not in the product reference set"),
            ),
        ),
        Rule(
            "DUPLICATE_ORDER_ID", FILE_SCOPE, "order_id",
            F.col("row_num") > F.col("first_accepted"),
            F.concat(
                F.lit("order_id "), F.col("order_id").cast("string"),
                F.lit(" already appeared in this file"),
            ),
        ),
    ]


def all_rules(today: dt.date, max_quantity: int) -> list[Rule]:
    return row_rules(today, max_quantity) + reference_rules()


def bits_of(rules: list[Rule], first: int = 0) -> Column:
    """The bits of the rules that fire; the first rule has bit ``first``."""
    bits = [F.when(r.fires, F.lit(1 << (first + i))).otherwise(F.lit(0)).cast("bigint")
            for i, r in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bit(position: int) -> str:
    """SQL for a verdict with this bit."""
    return f"fired & {1 << position} <> 0"


def unknown_keys(rows: DataFrame, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """Ids in the rows that the dimension lacks, each once.

    The ids are made distinct before they meet the dimension, and partly so before they are
    shuffled: an id on a third of all rows is one row per task.
    """
    used = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return used.join(dim.select(key), key, "left_anti").withColumn(flag, F.lit(True))


def first_accepted(rows: DataFrame) -> DataFrame:
    """Per file and order id: the first row without a defect, where later rows repeat the id.

    A later row is a duplicate exactly when its number is above this one, so no running state
    is kept. Minimum and maximum are combined before the shuffle, and ids used once drop out.
    """
    return (
        rows.where(F.col("order_id").isNotNull())
        .groupBy("source_file", "order_id")
        .agg(
            F.min(F.when(F.expr(IS_CLEAN), F.col("row_num"))).alias("first_accepted"),
            F.max("row_num").alias("last_row"),
        )
        .where("last_row > first_accepted")
        .drop("last_row")
    )


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans that run meanwhile make no method longer than the JVM compiles; the rules' would be."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def judge(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    today: dt.date,
    space: Workspace,
    max_quantity: int = DEFAULT_MAX_QUANTITY,
) -> DataFrame:
    """Judge raw rows: the typed columns, the verdict ``fired`` and, on a row with a defect only, the fields ``raw``.

    The wide rows are never regrouped. Narrow aggregates find the exceptions (unknown ids,
    repeated order ids), which are written and joined back: broadcast where their known size
    allows, sort-merged with runtime skew splitting where it does not.
    """
    early = row_rules(today, max_quantity)
    # values take the sizes a clean row needs; the verdict reads decimals as written, and the quantity in 64 bits
    rows = parsed(raw, STORED["unit_price"], STORED["discount_rate"]).withColumn("fired", bits_of(early))
    rows = rows.withColumn("quantity", F.col("quantity").try_cast(STORED["quantity"]))
    rows = rows.withColumn("raw", _odd_raw()).drop("text", "year_month", "price_reads", "rate_reads")
    with compiled_methods(raw.sparkSession):
        rows = space.settle(rows, "rows", dictionary=False)
    bad_customers = space.settle(
        unknown_keys(rows, customers, "customer_id", "unknown_customer"), "unknown-customers"
    )
    bad_products = space.settle(
        unknown_keys(rows, products, "product_id", "unknown_product"), "unknown-products"
    )
    keyed = rows.join(bad_customers, "customer_id", "left").join(
        bad_products, "product_id", "left"
    )
    *foreign, duplicate = reference_rules()
    keyed = keyed.withColumn(
        "fired", F.col("fired").bitwiseOR(bits_of(foreign, len(early)))
    ).drop("unknown_customer", "unknown_product")
    repeats = space.settle(first_accepted(keyed), "repeats")
    # the order id comes first, as a sort compares its first key by far the fastest, and file names hardly differ
    judged = keyed.join(repeats, ["order_id", "source_file"], "left")
    last_bit = bits_of([duplicate], len(early) + len(foreign))
    judged = judged.withColumn("fired", F.col("fired").bitwiseOR(last_bit))
    raw_fields = F.when(~F.expr(IS_CLEAN), _whole_raw()).alias("raw")
    return judged.select("source_file", "row_num", raw_fields, *SALES_FIELDS, "fired")


def settled_judgement(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    today: dt.date,
    space: Workspace,
    max_quantity: int = DEFAULT_MAX_QUANTITY,
) -> DataFrame:
    """``judge``, written; the rows it was made from are then dropped."""
    passing = space.inner()
    judged = judge(raw, customers, products, today, passing, max_quantity)
    judged = space.settle(judged, "judged", dictionary=False)
    passing.drop()
    return judged


def clean(judged: DataFrame) -> DataFrame:
    """Rows without a defect, typed."""
    return judged.where(IS_CLEAN).drop("raw", "fired")


def measured(rows: DataFrame) -> DataFrame:
    """Clean rows with their measures, which use the discount rate as it was read; the stored rate has four decimals."""
    return with_measures(rows).withColumn("discount_rate", F.col("discount_rate").try_cast(RATE))


def accepted(judged: DataFrame) -> DataFrame:
    """Rows without a defect, typed and measured."""
    return measured(clean(judged))


def rejected(
    judged: DataFrame, today: dt.date, max_quantity: int = DEFAULT_MAX_QUANTITY
) -> DataFrame:
    """Rows with a defect: the raw fields as JSON, the primary code, and every other one."""
    rules = all_rules(today, max_quantity)
    rows = judged.where(f"not ({IS_CLEAN})").withColumns({
        "text": _text(("quantity", "unit_price", "discount_rate")), "year_month": P.year_month(F.col("source_file"))})
    # the texts of rules that did not fire are null, and left out
    details = [
        F.when(F.expr(bit(i)), F.concat(F.lit(f"{rule.code}: "), rule.detail))
        for i, rule in enumerate(rules)
    ]
    codes = ", ".join(f"if({bit(i)}, '{rule.code}', null)" for i, rule in enumerate(rules))
    return rows.select(
        "source_file",
        "row_num",
        F.to_json("raw").alias("raw_payload"),
        primary_code().alias("reason_code"),
        F.concat_ws(DETAIL_SEPARATOR, *details).alias("reason_detail"),
        F.expr(f"split(concat_ws(' ', {codes}), ' ')").alias("reason_codes"),
    )


def settled_rejects(
    judged: DataFrame, today: dt.date, space: Workspace, max_quantity: int = DEFAULT_MAX_QUANTITY
) -> DataFrame:
    """``rejected``, written: its texts make a longer method than the JVM compiles wherever they are read lazily."""
    with compiled_methods(judged.sparkSession):
        return space.settle(rejected(judged, today, max_quantity), "rejects", dictionary=False)


def primary_code() -> Column:
    """The code of the first rule that fired; null on a clean row."""
    cases = " ".join(f"when {bit(i)} then '{code}'" for i, code in enumerate(RULE_CODES))
    return F.expr(f"case {cases} end")


def repaired_keys(raw: DataFrame) -> DataFrame:
    """Ids that were trimmed or upper-cased: repairs, which do not reject a row."""
    fields = ("customer_id", "product_id")
    repairs = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.col(f).alias("before"),
                P.normal_key(F.col(f)).alias("after"),
            )
            for f in fields
        ]
    )
    return (
        raw.select("source_file", "row_num", F.inline(repairs))
        .where("after <> '' and after <> before")
        .withColumn("code", F.lit(KEY_NORMALIZED))
    )


def code_counts(rejects: DataFrame) -> DataFrame:
    """How often each code fired, as the primary one and at all."""
    return (
        rejects.select(F.posexplode("reason_codes").alias("pos", "reason_code"))
        .groupBy("reason_code")
        .agg(
            F.count(F.lit(1)).alias("fired"),
            F.count_if(F.col("pos") == 0).alias("as_primary"),
        )
    )


def with_code(rejects: DataFrame, code: str) -> DataFrame:
    """Every rejected row on which the code fired, primary or not."""
    return rejects.where(F.array_contains("reason_codes", code))
