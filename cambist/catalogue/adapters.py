"""Star-schema tables → payments, rates, merchants and change messages.

Each mapping covers its whole table. Faults in the messages follow from a
number each event carries in ``props``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How star-schema attributes read as payment attributes.
CURRENCIES = ("USD", "EUR", "GBP", "CHF", "CAD", "AUD", "XYZ")
METHODS = ("card", "paypal", "apple_pay", "bank_transfer", "google_pay")
STATUSES = ("authorized", "failed", "captured", "pending", "refunded", "authorized", "chargeback", "cancelled")
COUNTRIES = ("NL", "US", "DE", "GB", "CH")
CATEGORIES = ("fashion", "travel", "grocery", "health", "home")
BASE_RATES = {"EUR": "0.90", "GBP": "0.77", "CHF": "0.88", "CAD": "1.30", "AUD": "1.45"}
EVENT_OPS = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}
EVENT_STATUSES = {
    "signup": "authorized", "view": "captured", "click": "pending", "purchase": "refunded", "error": "failed",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(frame: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over tasks.

    A file is divided at its row groups, whatever its size: of a file that has one, a single
    task reads all rows, and would do all that follows up to the next exchange.
    """
    spark = frame.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return frame.repartition(tasks)


def pick(values, index: Column) -> Column:
    """The value at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their customers as staged payments."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("payment_id"),
        (F.col("o_orderkey") % 10).alias("merchant_id"),
        F.col("o_custkey").alias("shopper_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        pick(CURRENCIES, F.col("c_nationkey") % 7).alias("currency"),
        pick(METHODS, F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("payment_method"),
        pick(STATUSES, F.col("o_orderkey") % 8).alias("payment_status"),
        pick(COUNTRIES, F.col("c_nationkey") % 5).alias("country_code"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a landed text extract, with the padding and case staging has to remove."""
    p = payments(spark, sf_dir)
    return p.select(
        F.col("payment_id").cast("string").alias("payment_id"),
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("shopper_id").cast("string").alias("shopper_id"),
        F.col("amount").cast("string").alias("amount"),
        F.concat(F.lit(" "), F.lower("currency"), F.lit("  ")).alias("currency"),
        F.concat(F.upper("payment_method"), F.lit(" ")).alias("payment_method"),
        F.concat(F.lit("  "), F.initcap("payment_status")).alias("payment_status"),
        F.concat(F.lower("country_code"), F.lit(" ")).alias("country_code"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weekday feed for five currencies on the order dates; CAD starts in 1996."""
    days = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").cast("date").alias("rate_date"))
        .distinct()
        .withColumn("n", F.date_diff("rate_date", F.lit("1995-01-02").cast("date")))
    )
    bases = F.array(
        *[F.struct(F.lit(c).alias("currency"), F.lit(b).cast("decimal(4,2)").alias("base")) for c, b in BASE_RATES.items()]
    )
    step = (F.col("n") % 50).cast("decimal(10,0)") * F.lit("0.001").cast("decimal(4,3)")
    return (
        days.where(F.col("n") % 7 < 5)
        .select("rate_date", "n", F.inline(bases))
        .where((F.col("currency") != "CAD") | (F.col("rate_date") >= F.lit("1996-01-01").cast("date")))
        .select(
            "rate_date",
            F.lit("USD").alias("base_currency"),
            "currency",
            (F.col("base") + step).cast("decimal(18,8)").alias("rate"),
        )
    )


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as text, with padding, and with a zero, a negative and a missing rate each day."""
    r = rates(spark, sf_dir)
    good = r.select(
        F.col("rate_date").cast("string").alias("rate_date"),
        F.lit(" usd").alias("base_currency"),
        F.concat(F.lower("currency"), F.lit(" ")).alias("currency"),
        F.col("rate").cast("string").alias("rate"),
    )
    bad = F.array(
        *[
            F.struct(F.lit(c).alias("currency"), F.lit(v).cast("string").alias("rate"))
            for c, v in (("zer", "0"), ("neg", "-1"), ("nul", None))
        ]
    )
    spoiled = r.select(F.col("rate_date").cast("string").alias("rate_date")).distinct()
    spoiled = spoiled.select("rate_date", F.lit("usd").alias("base_currency"), F.inline(bad))
    return good.unionByName(spoiled)


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per feed day, with entries that must vanish, and one malformed document per day."""
    r = rates(spark, sf_dir)
    entries = F.concat(F.lit('"'), F.lower("currency"), F.lit('":'), F.col("rate").cast("string"))
    spoiled = ',"NUL":null,"ZER":"0","NEG":-1,"TXT":"abc"'
    daily = r.groupBy("rate_date").agg(F.array_join(F.collect_list(entries), ",").alias("entries"))
    good = F.concat(
        F.lit('{"base":"usd","date":"'), F.col("rate_date").cast("string"),
        F.lit('","rates":{'), F.col("entries"), F.lit(spoiled + "}}"),
    )
    bad_date = F.concat(F.lit('{"date":"on '), F.col("rate_date").cast("string"), F.lit('","rates":{"EUR":1}}'))
    return daily.select(F.explode(F.array(good, bad_date)).alias("value"))


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias("merchant_name"),
        F.concat(F.lower(pick(COUNTRIES, F.col("s_nationkey") % 5)), F.lit(" ")).alias("country_code"),
        F.concat(F.lit(" "), F.upper(pick(CATEGORIES, F.col("s_suppkey") % 5))).alias("category"),
    )


def lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def event_facts(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """Events with the payment attributes the messages will carry; errors have negative amounts.

    ``spread``: dealt out as narrow rows, since many times their size is made of them and decoded.
    """
    events = table(spark, sf_dir, "events")
    events = dealt(events) if spread else events
    cents = F.round(F.col("value") * 100).cast("bigint")
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("ts"),
        lookup(EVENT_OPS, F.col("event_type")).alias("op"),
        lookup(EVENT_STATUSES, F.col("event_type")).alias("status"),
        pick(CURRENCIES, F.col("user_id") % 7).alias("currency"),
        pick(METHODS, F.col("user_id") % 5).alias("method"),
        pick(COUNTRIES, F.col("user_id") % 5).alias("country"),
        F.when(F.col("event_type") == "error", -cents).otherwise(cents).alias("cents"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def sixteen_digits(cents: Column) -> Column:
    """A signed 64-bit integer as 8 big-endian bytes in hex."""
    return F.lpad(F.hex(cents), 16, "0")


def minimal_digits(cents: Column) -> Column:
    """The fewest bytes that keep the sign, as the connector sends it."""
    return minimal_digits_of(sixteen_digits(cents))


def minimal_digits_of(digits: Column) -> Column:
    return F.regexp_replace(digits, "^(?:(?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")


def base64_of(digits: Column) -> Column:
    return F.base64(F.unhex(digits))


def thirty_two_digits(whole: Column) -> Column:
    """A signed whole decimal as 16 big-endian bytes in hex."""
    base = F.lit(str(1 << 64)).cast("decimal(38,0)")
    lower = F.pmod(whole, base)
    upper = ((whole - lower) / base).cast("bigint")
    return F.concat(sixteen_digits(upper), F.lpad(F.conv(lower.cast("string"), 10, 16), 16, "0"))


def wide_amount(cents: Column, digits: int) -> Column:
    """A whole decimal of that many digits, with the sign and the digits of the cents."""
    most, size = F.lit("1" + "0" * (digits - 1)).cast("decimal(38,0)"), F.abs(cents).cast("decimal(18,0)")
    # Not a negated sum: a decimal's sign is turned at 34 digits.
    return F.when(cents < 0, F.lit("-1" + "0" * (digits - 1)).cast("decimal(38,0)") - size).otherwise(most + size).cast("decimal(38,0)")


def digits_of(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)").cast("string")


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def messages(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """One log record per event, in the six-column record schema; ``spread`` as for the events.

    Fixed values, by ``k``: 0 no value · 1 no JSON · 2 unknown operation · 3 no
    key · 4 JSON null · 5 an array · 6 truncate · 7 wrapped in payload · 8 log
    position as text · 9 negative log position · 10 no source · 11 amount as
    digits · 12 as whole cents · 13 as a number · 14 null · 15 unreadable
    creation time · 16 update without after image · 17 key as text · 18 empty
    amount · 19 more text behind the document · 20 two documents · 21 key with a
    fraction of zeros.
    """
    e, k = event_facts(spark, sf_dir, spread), F.col("k")
    cents, micros = F.col("cents"), F.unix_micros("ts").cast("string")
    amount = (
        F.when(k == 11, quoted(digits_of(cents)))
        .when(k == 12, cents.cast("string"))
        .when(k == 13, digits_of(cents))
        .when(k == 14, F.lit("null"))
        .when(k == 18, F.lit('""'))
        .otherwise(quoted(base64_of(minimal_digits(cents))))
    )
    key = F.col("user_id").cast("string")
    key_member = (
        F.when(k == 3, F.lit(""))
        .when(k == 17, F.concat(F.lit('"payment_id":'), quoted(key), F.lit(",")))
        .when(k == 21, F.concat(F.lit('"payment_id":'), key, F.lit(".0,")))
        .otherwise(F.concat(F.lit('"payment_id":'), key, F.lit(",")))
    )
    created = F.when(k == 15, F.lit('"unreadable"')).otherwise(micros)
    image = F.concat(
        F.lit("{"), key_member,
        F.lit('"merchant_id":'), (F.col("user_id") % 10).cast("string"),
        F.lit(',"shopper_id":'), (F.col("user_id") + 500).cast("string"),
        F.lit(',"amount":'), amount,
        F.lit(',"currency":'), quoted(F.col("currency")),
        F.lit(',"payment_method":'), quoted(F.col("method")),
        F.lit(',"payment_status":'), quoted(F.col("status")),
        F.lit(',"country_code":'), quoted(F.col("country")),
        F.lit(',"created_at":'), created,
        F.lit(',"updated_at":'), micros,
        F.lit(',"note":"not captured"}'),
    )
    op = F.when(k == 2, F.lit("x")).when(k == 6, F.lit("t")).otherwise(F.col("op"))
    in_before = (F.col("op") == "d") | ((F.col("op") == "u") & (k == 16))
    event_id = F.col("event_id").cast("string")
    lsn = F.when(k == 8, quoted(event_id)).when(k == 9, F.concat(F.lit("-"), (F.col("event_id") + 1).cast("string")))
    source = F.when(k == 10, F.lit("null")).otherwise(
        F.concat(
            F.lit('{"table":"payments","lsn":'), F.coalesce(lsn, event_id),
            F.lit(',"ts_ms":'), F.unix_millis("ts").cast("string"), F.lit("}"),
        )
    )
    envelope = F.concat(
        F.when(k == 7, F.lit('{"schema":{"type":"struct"},"payload":')).otherwise(F.lit("")),
        F.when(in_before, F.lit('{"before":')).otherwise(F.lit('{"before":null,"after":')),
        F.when(k == 6, F.lit("null")).otherwise(image),
        F.when(in_before, F.lit(',"after":null')).otherwise(F.lit("")),
        F.lit(',"source":'), source, F.lit(',"op":'), quoted(op), F.lit("}"),
        F.when(k == 7, F.lit("}")).otherwise(F.lit("")),
    )
    value = (
        F.when(k == 0, F.lit(None))
        .when(k == 1, F.lit("not json at all"))
        .when(k == 4, F.lit("null"))
        .when(k == 5, F.lit("[]"))
        .when(k == 19, F.concat(envelope, F.lit(" and more }")))
        .when(k == 20, F.concat(envelope, F.lit("\n"), envelope))
        .otherwise(envelope)
    )
    return e.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("cdc.public.payments").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def change(spec_name: str, op: Column, lsn: Column, image: Column) -> Column:
    """A change of another captured table, ``image`` being a struct."""
    envelope = F.struct(
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        F.struct(F.lit(spec_name).alias("table"), lsn.alias("lsn"), F.lit(1767225600000).alias("ts_ms")).alias("source"),
        op.alias("op"),
    )
    return F.to_json(envelope)


def merchant_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is created and renamed; the health ones are deleted between the two, a stale rename follows."""
    supplier = table(spark, sf_dir, "supplier")
    key, category = F.col("s_suppkey"), pick(CATEGORIES, F.col("s_suppkey") % 5)

    def image(name: Column) -> Column:
        return F.struct(
            key.alias("merchant_id"),
            name.alias("merchant_name"),
            pick(COUNTRIES, F.col("s_nationkey") % 5).alias("country_code"),
            category.alias("category"),
            F.lit(1767225600000000).alias("created_at"),
        )

    renamed = F.concat(F.col("s_name"), F.lit(" Ltd"))
    last_op = F.when(category == "health", F.lit("d")).otherwise(F.lit("u"))
    values = F.array(
        change("merchants", last_op, key * 10 + 3, image(renamed)),
        change("merchants", F.lit("c"), key * 10 + 1, image(F.col("s_name"))),
        change("merchants", F.lit("u"), key * 10 + 2, image(F.upper("s_name"))),
    )
    return supplier.select(F.explode(values).alias("value"))


def refund_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is refunded in full; the refund is read in a snapshot, then given its reason."""
    p = payments(spark, sf_dir)
    cents = (F.col("amount") * 100).cast("bigint")

    def image(reason: Column) -> Column:
        return F.struct(
            F.col("payment_id").alias("refund_id"),
            F.col("payment_id").alias("payment_id"),
            base64_of(minimal_digits(-cents)).alias("refund_amount"),
            reason.alias("refund_reason"),
            F.unix_micros("created_at").alias("created_at"),
        )

    values = F.array(
        change("refunds", F.lit("u"), F.col("payment_id") * 2 + 1, image(F.col("payment_status"))),
        change("refunds", F.lit("r"), F.col("payment_id") * 2, image(F.lit("unknown"))),
    )
    return p.select(F.explode(values).alias("value"))
