"""Masking, subject rights and audit queries."""

from pyspark.sql import functions as F

from sedimenta.functions import masking as m
from sedimenta.plans import governance as g
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import AUDIT, CUSTOMER_ORDERS, CUSTOMERS, EVENTS_END
from sedimenta.sources import shapes

SALT = "north-sea"
MASK_EMAIL = "left(split_part(email, '@', 1), 2) || '***@' || split_part(email, '@', 2)"
MASK_PHONE = "'***-***-' || right(phone, 4)"
# Subjects: customers who agreed to nothing.
SUBJECT = "NOT consent_marketing AND NOT consent_data_sharing"
SUBJECTS = f"(SELECT customer_id FROM {CUSTOMERS} WHERE {SUBJECT})"
TOKEN = f"sha256(concat_ws('|', customer_id, '{SALT}'))"
DAY = "2024-01-20"


def customers(spark, sf_dir):
    return shapes.customers(spark, sf_dir)


def orders(spark, sf_dir):
    return shapes.customer_orders(spark, sf_dir)


def subjects(spark, sf_dir):
    return customers(spark, sf_dir).filter(SUBJECT).select("customer_id")


def log(spark, sf_dir):
    return shapes.audit_log(spark, sf_dir)


def since(spark, sf_dir, interval):
    return shapes.latest(shapes.table(spark, sf_dir, "events"), "ts") - F.expr(f"INTERVAL {interval}")


@query("mask_pii", f"""
SELECT customer_id, {MASK_EMAIL} AS email, {MASK_PHONE} AS phone, '***-**-****' AS ssn, '****-****-****-' || credit_card_last4 AS credit_card FROM {CUSTOMERS}""")
def mask_pii(spark, sf_dir):
    return customers(spark, sf_dir).select(
        "customer_id", m.mask_email(F.col("email")).alias("email"), m.mask_phone(F.col("phone")).alias("phone"),
        m.mask_ssn(F.col("ssn")).alias("ssn"), m.mask_card(F.col("credit_card_last4")).alias("credit_card"),
    )


@query("mask_pii_sql", f"""
SELECT customer_id, {MASK_EMAIL} AS email, {MASK_PHONE} AS phone, '***-**-****' AS ssn, '****-****-****-' || credit_card_last4 AS credit_card FROM {CUSTOMERS}""")
def mask_pii_sql(spark, sf_dir):
    m.create_sql_functions(spark)
    return customers(spark, sf_dir).selectExpr(
        "customer_id", "mask_email(email) AS email", "mask_phone(phone) AS phone", "mask_ssn(ssn) AS ssn",
        "mask_card(credit_card_last4) AS credit_card",
    )


@query("customers_service", f"""
SELECT customer_id, {MASK_EMAIL} AS email, {MASK_PHONE} AS phone, '***-**-****' AS ssn, first_name, last_name, city, state,
  '****-****-****-' || credit_card_last4 AS credit_card FROM {CUSTOMERS}""")
def customers_service(spark, sf_dir):
    return g.service_view(customers(spark, sf_dir))


@query("customers_masked", f"""
SELECT customer_id, '***@' || split_part(email, '@', 2) AS email_masked, {MASK_PHONE} AS phone_masked, '***-**-****' AS ssn_masked,
  first_name, last_name, city, state FROM {CUSTOMERS}""")
def customers_masked(spark, sf_dir):
    return g.analyst_view(customers(spark, sf_dir))


@query("customers_marketing", f"SELECT customer_id, email, first_name, last_name, city, state FROM {CUSTOMERS} WHERE consent_marketing")
def customers_marketing(spark, sf_dir):
    return g.marketing_view(customers(spark, sf_dir))


@query("consent_counts", f"""
SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (consent_marketing) AS marketing_consent_count,
  COUNT(*) FILTER (consent_data_sharing) AS sharing_consent_count FROM {CUSTOMERS}""")
def consent_counts(spark, sf_dir):
    return g.consent_counts(customers(spark, sf_dir))


@query("view_min_necessary", f"SELECT customer_id, segment, CAST(balance AS DOUBLE) AS balance FROM {CUSTOMERS} WHERE consent_data_sharing")
def view_min_necessary(spark, sf_dir):
    policies = {
        "billing": g.Policy(("customer_id", "segment", "balance"), "consent_data_sharing"),
        "support": g.Policy(("customer_id", "first_name", "phone")),
    }
    out = g.minimum_necessary(customers(spark, sf_dir), policies, "billing")
    return out.withColumn("balance", F.col("balance").cast("double"))


@query("mask_by_role", f"SELECT customer_id, '***-**-****' AS ssn_analyst, ssn AS ssn_officer FROM {CUSTOMERS}")
def mask_by_role(spark, sf_dir):
    ssn, allowed = F.col("ssn"), {"privacy_officer"}
    return customers(spark, sf_dir).select(
        "customer_id",
        m.mask_for_role(ssn, m.mask_ssn(ssn), "analyst", allowed).alias("ssn_analyst"),
        m.mask_for_role(ssn, m.mask_ssn(ssn), "privacy_officer", allowed).alias("ssn_officer"),
    )


@query("tokenize", f"SELECT {TOKEN} AS customer_token, sha256(email) AS email_token, first_name, last_name, city, state FROM {CUSTOMERS}")
def tokenize(spark, sf_dir):
    return g.tokenize(customers(spark, sf_dir), SALT)


@query("token_mapping", f"SELECT customer_id, {TOKEN} AS customer_token, email, ssn FROM {CUSTOMERS}")
def token_mapping(spark, sf_dir):
    return g.token_mapping(customers(spark, sf_dir), SALT)


@query("gdpr_access", f"""
SELECT 'Customer Profile' AS data_category, customer_id, email, phone, first_name, last_name, address, city, state, zip_code, date_of_birth,
  consent_marketing, consent_data_sharing, NULL::VARCHAR AS order_id, NULL::DOUBLE AS total_amount, NULL::VARCHAR AS status, NULL::DATE AS order_date
FROM {CUSTOMERS} WHERE {SUBJECT}
UNION ALL SELECT 'Order History', customer_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CAST(order_id AS VARCHAR), CAST(amount AS DOUBLE), status, order_date FROM {CUSTOMER_ORDERS} WHERE customer_id IN {SUBJECTS}""")
def gdpr_access(spark, sf_dir):
    return g.subject_access(customers(spark, sf_dir), orders(spark, sf_dir), subjects(spark, sf_dir))


@query("gdpr_erasure", f"""
WITH kept AS (SELECT customer_id FROM {CUSTOMERS} WHERE NOT ({SUBJECT}))
SELECT 'customers' AS table_name, COUNT(*) AS remaining FROM kept
UNION ALL SELECT 'orders', COUNT(*) FROM {CUSTOMER_ORDERS} WHERE customer_id NOT IN {SUBJECTS}
UNION ALL SELECT 'tokenized', COUNT(*) FROM kept UNION ALL SELECT 'mapping', COUNT(*) FROM kept""")
def gdpr_erasure(spark, sf_dir):
    from sedimenta.sources.files import format_counts

    c = customers(spark, sf_dir)
    left = g.erase_cascade(
        {"customers": c, "orders": orders(spark, sf_dir)},
        g.token_mapping(c, SALT), g.tokenize(c, SALT), subjects(spark, sf_dir),
    )
    return format_counts(left).withColumnsRenamed({"name": "table_name", "row_count": "remaining"})


@query("gdpr_erasure_orders", f"""
SELECT order_id, customer_id FROM {CUSTOMER_ORDERS} WHERE customer_id NOT IN {SUBJECTS}""")
def gdpr_erasure_orders(spark, sf_dir):
    return g.erase(orders(spark, sf_dir), subjects(spark, sf_dir)).select("order_id", "customer_id")


@query("gdpr_deletion_log", f"""
SELECT 'DEL-' || left(sha256(concat_ws('|', customer_id, '2024-02-01 00:00:00', '{SALT}')), 16) AS request_id, customer_id,
  TIMESTAMP '2024-02-01 00:00:00' AS request_date, 'privacy@corp.example.com' AS requested_by, 'completed' AS status,
  TIMESTAMP '2024-02-01 00:00:00' AS completed_date FROM {SUBJECTS}""")
def gdpr_deletion_log(spark, sf_dir):
    return g.deletion_log(subjects(spark, sf_dir), "2024-02-01 00:00:00", "privacy@corp.example.com", SALT)


@query("gdpr_export_json", f"""
SELECT customer_id, CAST(json_merge_patch('{{}}', to_json({{customer_id: customer_id, email: email, first_name: first_name, last_name: last_name,
  address: address, city: city, state: state}})) AS VARCHAR) AS customer_data_json FROM {CUSTOMERS} WHERE {SUBJECT}""")
def gdpr_export_json(spark, sf_dir):
    return g.portable_json(customers(spark, sf_dir), subjects(spark, sf_dir))


@query("audit_daily", f"""
SELECT CAST("timestamp" AS DATE) AS access_date, user_email, user_role, action_type, COUNT(*) AS operation_count, SUM(row_count)::BIGINT AS total_rows_accessed,
  COUNT(*) FILTER (success) AS successful_operations, COUNT(*) FILTER (NOT success) AS failed_operations FROM {AUDIT} GROUP BY 1, 2, 3, 4""")
def audit_daily(spark, sf_dir):
    return g.audit_day(log(spark, sf_dir), ["user_email", "user_role", "action_type"])


# Metric, amount, hours looked back, usual amount.
VOLUMES = [("rows_1h", "row_count", 1, 500), ("rows_24h", "row_count", 24, 10000), ("accesses_24h", "1", 24, 2), ("rows_7d", "row_count", 168, 40000)]


@query("audit_suspicious", "\nUNION ALL\n".join(f"""
SELECT user_email, user_role, '{name}' AS metric, SUM({amount})::BIGINT AS observed, {usual}::BIGINT AS usual FROM {AUDIT}
WHERE success AND "timestamp" >= {EVENTS_END} - INTERVAL {hours} HOUR GROUP BY 1, 2 HAVING SUM({amount}) > {usual}""" for name, amount, hours, usual in VOLUMES))
def audit_suspicious(spark, sf_dir):
    """Users above the usual amount of an hour, a day or a week."""
    return g.unusual_volumes(log(spark, sf_dir), [
        g.Volume(name, amount, since(spark, sf_dir, f"{hours} HOUR"), usual) for name, amount, hours, usual in VOLUMES])


@query("audit_failed", f"""
WITH f AS (SELECT user_email, ip_address, table_name, error_message, COUNT(*) AS n, MAX("timestamp") AS last FROM {AUDIT}
  WHERE NOT success AND "timestamp" >= {EVENTS_END} - INTERVAL 28 DAY GROUP BY 1, 2, 3, 4)
SELECT user_email, ip_address, table_name, SUM(n)::BIGINT AS failed_attempts, MAX(last) AS last_attempt,
  array_to_string(list(error_message || ' x' || n ORDER BY error_message || ' x' || n), '; ') AS error_messages, CAST(0 AS BIGINT) AS piece FROM f GROUP BY 1, 2, 3 HAVING SUM(n) >= 3""")
def audit_failed(spark, sf_dir):
    return g.failed_attempts(log(spark, sf_dir), since(spark, sf_dir, "28 DAY"), 3)


_SENSITIVE = f"""(SELECT *, CAST("timestamp" AS DATE) AS access_date FROM {AUDIT}
  WHERE table_name LIKE '%customers%' AND success AND "timestamp" >= {EVENTS_END} - INTERVAL 7 DAY)"""


@query("audit_sensitive", f"""
SELECT access_date, user_email, user_role, table_name, COUNT(*) AS access_count, SUM(row_count)::BIGINT AS rows_accessed,
  COUNT(DISTINCT ip_address) AS ip_addresses FROM {_SENSITIVE} GROUP BY 1, 2, 3, 4""")
def audit_sensitive(spark, sf_dir):
    return g.sensitive_access(log(spark, sf_dir), since(spark, sf_dir, "7 DAY"), "%customers%")


@query("audit_addresses", f"SELECT DISTINCT access_date, user_email, user_role, table_name, ip_address FROM {_SENSITIVE}")
def audit_addresses(spark, sf_dir):
    return g.addresses(log(spark, sf_dir), since(spark, sf_dir, "7 DAY"), "%customers%")


@query("audit_access_summary", f"""
SELECT user_email, action_type, table_name, COUNT(*) AS access_count, MIN("timestamp") AS first_access, MAX("timestamp") AS last_access
FROM {AUDIT} WHERE table_name LIKE '%customers%' GROUP BY 1, 2, 3""")
def audit_access_summary(spark, sf_dir):
    return g.access_summary(log(spark, sf_dir), F.col("table_name").like("%customers%"))


@query("compliance_user_summary", f"""
SELECT user_email, action_type, COUNT(*) AS operation_count, SUM(row_count)::BIGINT AS total_rows FROM {AUDIT} WHERE CAST("timestamp" AS DATE) = DATE '{DAY}' GROUP BY 1, 2""")
def compliance_user_summary(spark, sf_dir):
    report = g.compliance_report(log(spark, sf_dir), DAY).filter("report = 'operations'")
    return report.select("user_email", F.col("subject").alias("action_type"), F.col("events").alias("operation_count"),
                         F.col("rows").alias("total_rows"))


@query("compliance_sensitive", f"""
SELECT user_email, table_name, COUNT(*) AS access_count FROM {AUDIT} WHERE CAST("timestamp" AS DATE) = DATE '{DAY}'
  AND (contains(table_name, 'customers') OR contains(table_name, 'patient')) GROUP BY 1, 2""")
def compliance_sensitive(spark, sf_dir):
    report = g.compliance_report(log(spark, sf_dir), DAY).filter("report = 'sensitive'")
    return report.select("user_email", F.col("subject").alias("table_name"), F.col("events").alias("access_count"))
