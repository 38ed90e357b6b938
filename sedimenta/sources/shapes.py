"""The business tables the jobs work on, derived from the Parquet inputs.

Each function reads only the columns it needs and stays lazy.  Every shape has
a twin in ``registry.sqlshapes`` for the check queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.scale import broadcast_if_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str | Column) -> Column:
    """Exact cents: sums do not depend on the order of the rows."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def latest(df: DataFrame, column: str) -> Column:
    """The newest value of a timestamp column as a literal, so that filters on
    it are pushed to the scan.  One aggregated row reaches the driver."""
    value = df.agg(F.max(column).cast("string")).first()[0]
    return F.lit(value).cast(df.schema[column].dataType)


def copies(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(1), n))


def orders(spark: SparkSession, sf_dir: str, code: str | None = None) -> DataFrame:
    """Orders; with ``code`` only those of a status code, filtered in the scan."""
    raw = table(spark, sf_dir, "orders")
    if code is not None:
        raw = raw.filter(F.col("o_orderstatus") == code)
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("processing")
    )
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as raw strings with defects on fixed keys and some copies."""
    k = F.col("o_orderkey")

    def defect(every: int, bad: Column, good: Column) -> Column:
        return F.when(k % every == 0, bad).otherwise(good)

    none = F.lit(None)
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        defect(107, none, F.concat(F.lit("ORD"), k.cast("string"))).alias("order_id"),
        defect(97, none, F.concat(F.lit("CUST"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        defect(109, none, defect(89, -price, price)).alias("amount"),
        defect(113, none, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        defect(
            127, none,
            defect(
                101, F.lit("invalid_status"),
                F.when(F.col("o_orderstatus") == "F", "completed")
                .when(F.col("o_orderstatus") == "O", "pending")
                .otherwise("cancelled"),
            ),
        ).alias("status"),
        defect(
            131, none,
            defect(
                83, F.lit("invalid-email"),
                F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@mail.example.com")),
            ),
        ).alias("email"),
        copies(defect(53, F.lit(2), F.lit(1))).alias("_copy"),
    ).drop("_copy")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with personal data made up from the key."""
    k = F.col("c_custkey")
    four = F.lpad((k % 10000).cast("string"), 4, "0")
    geo = table(spark, sf_dir, "nation").join(
        broadcast_if_small(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(broadcast_if_small(geo), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("CUST"), k.cast("string")).alias("customer_id"),
            F.when(k % 71 != 0, F.concat(
                F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                F.lower("c_mktsegment"), F.lit(".example.com"),
            )).alias("email"),
            F.when(k % 73 != 0, F.concat(F.lit("555-010-"), four)).alias("phone"),
            F.concat(F.lit("900-55-"), four).alias("ssn"),
            F.initcap(F.lower("c_mktsegment")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat((k % 500).cast("string"), F.lit(" Main Street")).alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
            four.alias("credit_card_last4"),
            F.date_add(F.lit("1950-01-01").cast("date"), (k % 15000).cast("int")).alias("date_of_birth"),
            F.date_add(F.lit("1994-01-01").cast("date"), (k % 1500).cast("int")).alias("signup_date"),
            (k % 2 == 0).alias("consent_marketing"),
            (k % 3 != 0).alias("consent_data_sharing"),
            F.col("c_mktsegment").alias("segment"),
            money("c_acctbal").alias("balance"),
        )
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer id in the form ``customers`` has it."""
    return orders(spark, sf_dir).withColumn(
        "customer_id", F.concat(F.lit("CUST"), F.col("customer_id").cast("string"))
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        money("p_retailprice").alias("retail_price"),
        (money("p_retailprice") * F.lit("0.70").cast("decimal(3,2)")).cast("decimal(18,2)").alias("cost_price"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: product, quantity, exact line total and ship date."""
    gross = F.col("l_extendedprice").cast("decimal(14,2)")
    rest = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (gross * rest).cast("decimal(18,4)").alias("line_total"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log: the newest row per ``user_id`` is its state."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("status"),
        F.col("value").alias("amount"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )


# Status code of a completed order.
COMPLETED = "F"

# Split of the change log into a first load and the changes after it.
CUTOVER = "2024-01-15 00:00:00"


def cutover() -> Column:
    return F.lit(CUTOVER).cast("timestamp_ntz")


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, e = F.col("user_id"), F.col("event_id")
    role = F.when(u % 4 == 0, "data_engineer").when(u % 4 == 1, "data_analyst").when(
        u % 4 == 2, "marketing_team").otherwise("customer_service")
    target = F.when(e % 5 == 0, "silver.customers").when(e % 5 == 1, "silver.orders").when(
        e % 5 == 2, "silver.patient_records").when(e % 5 == 3, "gold.customers_masked").otherwise("silver.products")
    failed = F.col("event_type") == "error"
    message = F.when(e % 4 == 0, "permission denied").when(e % 4 == 1, "timeout").when(
        e % 4 == 2, "table not found").otherwise("row filter rejected")
    return table(spark, sf_dir, "events").select(
        e.alias("audit_id"),
        F.concat(F.lit("user"), u.cast("string"), F.lit("@corp.example.com")).alias("user_email"),
        role.alias("user_role"),
        F.col("event_type").alias("action_type"),
        target.alias("table_name"),
        F.floor(F.col("value") * 100).cast("bigint").alias("row_count"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("10.0.0."), (e % 3).cast("string")).alias("ip_address"),
        (~failed).alias("success"),
        F.when(failed, message).alias("error_message"),
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    failed = F.col("event_type") == "error"
    state = F.when(e % 3 == 0, "FAILED").when(e % 3 == 1, "TIMEOUT").otherwise("CANCELLED")
    message = (
        F.when(e % 5 == 0, "java.lang.OutOfMemoryError: heap")
        .when(e % 5 == 1, "read timeout after 300 s")
        .when(e % 5 == 2, "TableNotFoundException: silver.orders")
        .when(e % 5 == 3, "AnalysisException: cannot resolve column")
        .otherwise("unknown")
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("job_"), (F.col("user_id") % 20).cast("string")).alias("job_name"),
        e.alias("run_id"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts")).alias("end_time"),
        F.when(failed, state).otherwise("SUCCESS").alias("result_state"),
        F.col("value").alias("execution_duration"),
        F.when(failed, message).alias("error_message"),
    )


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between all parts as tables: k is fed by k/2 and k/3."""
    k = F.col("p_partkey")
    at = F.timestamp_add("MINUTE", (k % 100000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    edges = table(spark, sf_dir, "part").select(
        k.alias("_k"), at.alias("created_at"), "p_type",
        F.explode(F.array(F.floor(k / 2).cast("bigint"), F.floor(k / 3).cast("bigint"))).alias("_src"),
    )
    named = lambda c: F.concat(F.lit("lake.t"), c.cast("string"))
    return edges.filter(F.col("_src") > 0).select(
        named(F.col("_src")).alias("source_table"),
        named(F.col("_k")).alias("target_table"),
        F.when(F.col("p_type") == "PROMO", "VIEW").otherwise("TABLE").alias("target_type"),
        "created_at",
    )


def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily average of the event values per event type, as a metric."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("metric_name"), F.col("ts").cast("date").alias("metric_date"))
        .agg(
            F.sum(money("value")).alias("_sum"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(
            "metric_name", "metric_date",
            F.round(F.col("_sum").cast("double") / F.col("_n"), 4).alias("metric_value"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as product reviews with a rating from 1 to 5."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("review_text"),
        (F.col("doc_id") % 5 + 1).cast("bigint").alias("rating"),
        "source", "lang",
    )
