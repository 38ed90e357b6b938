"""Features, models and text queries."""

from pyspark.sql import functions as F

from sedimenta.functions import text as tx
from sedimenta.operators.merge import key_violations
from sedimenta.plans import churn, features as ft
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import LINES, ORDERS, ORDERS_END, PRODUCTS, REVIEWS
from sedimenta.sources import shapes

HIGH, MIDDLE = 3000000, 2000000


def rfm(spark, sf_dir):
    orders = shapes.orders(spark, sf_dir)
    today = shapes.latest(orders, "order_date")
    return ft.rfm_features(orders, shapes.lines(spark, sf_dir), shapes.products(spark, sf_dir), today)


RFM = f"""(SELECT customer_id, CAST(date_diff('day', max(order_date), {ORDERS_END}) AS INTEGER) AS recency_days, COUNT(DISTINCT order_id) AS frequency,
  CAST(SUM(amount) AS DOUBLE) AS monetary, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_order_value, COUNT(DISTINCT order_date) AS active_days,
  coalesce(any_value(k), 0) AS categories_purchased, CAST(date_diff('day', max(order_date), {ORDERS_END}) > 90 AS INTEGER) AS churned
  FROM {ORDERS} o LEFT JOIN (SELECT customer_id AS cid, COUNT(DISTINCT category) AS k FROM {LINES} JOIN {ORDERS} USING (order_id) JOIN {PRODUCTS} USING (product_id) GROUP BY 1) c
  ON o.customer_id = c.cid GROUP BY customer_id)"""

SEGMENTS = f"""(SELECT *, CASE WHEN recency_days <= 30 THEN 'Active' WHEN recency_days <= 90 THEN 'At Risk' ELSE 'Churned' END AS recency_segment,
  CASE WHEN frequency >= 10 THEN 'High' WHEN frequency >= 5 THEN 'Medium' ELSE 'Low' END AS frequency_segment,
  CASE WHEN monetary >= {HIGH} THEN 'High Value' WHEN monetary >= {MIDDLE} THEN 'Medium Value' ELSE 'Low Value' END AS monetary_segment FROM {RFM})"""


@query("rfm_features", f"SELECT * FROM {RFM}")
def rfm_features(spark, sf_dir):
    return rfm(spark, sf_dir)


@query("rfm_segments", f"SELECT * FROM {SEGMENTS}")
def rfm_segments(spark, sf_dir):
    return ft.rfm_segments(rfm(spark, sf_dir), HIGH, MIDDLE)


@query("churn_by_segment", f"""
SELECT recency_segment, frequency_segment, COUNT(*) AS customer_count, SUM(churned)::BIGINT AS churned_count,
  round(SUM(churned) * 100.0 / COUNT(*), 2) AS churn_rate_pct FROM {SEGMENTS} GROUP BY 1, 2""")
def churn_by_segment(spark, sf_dir):
    return ft.churn_by_segment(ft.rfm_segments(rfm(spark, sf_dir), HIGH, MIDDLE))


_ORDER_FEATURES = f"""SELECT customer_id, COUNT(*) AS order_count, CAST(SUM(amount) AS DOUBLE) AS total_spent, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_order,
  max(order_date) AS last_order_date, CAST(date_diff('day', max(order_date), {ORDERS_END}) AS INTEGER) AS days_since_last_order FROM {ORDERS} GROUP BY 1"""


def order_features_(spark, sf_dir):
    orders = shapes.orders(spark, sf_dir)
    return ft.order_features(orders, shapes.latest(orders, "order_date"))


@query("order_features", _ORDER_FEATURES)
def order_features(spark, sf_dir):
    return order_features_(spark, sf_dir)


@query("feature_lookup", f"""
SELECT o.order_id, o.customer_id, f.order_count, f.total_spent, f.days_since_last_order FROM {ORDERS} o LEFT JOIN ({_ORDER_FEATURES}) f USING (customer_id)""")
def feature_lookup(spark, sf_dir):
    rows = shapes.orders(spark, sf_dir).select("order_id", "customer_id")
    return ft.lookup(rows, order_features_(spark, sf_dir), "customer_id").select(
        "order_id", "customer_id", "order_count", "total_spent", "days_since_last_order"
    )


@query("feature_key_check", f"""
SELECT customer_id, COUNT(*) AS row_count FROM {ORDERS} GROUP BY 1 HAVING COUNT(*) > 1""")
def feature_key_check(spark, sf_dir):
    """Raw orders are no feature table of customers: the keys repeat."""
    return key_violations(shapes.orders(spark, sf_dir), ["customer_id"])


ANOMALY = """(SELECT event_id, user_id, event_type, value, hour(ts)::INT AS hour, (dayofweek(ts) + 1)::INT AS day_of_week,
  CAST(COUNT(*) OVER (PARTITION BY user_id) AS DOUBLE) AS lifetime_events FROM events)"""


@query("anomaly_features", f"SELECT * FROM {ANOMALY}")
def anomaly_features(spark, sf_dir):
    return ft.anomaly_features(shapes.table(spark, sf_dir, "events"))


_SCORE_COLUMNS = ["value", "hour", "day_of_week", "lifetime_events"]


def scored_events(spark, sf_dir):
    from sedimenta.plans.models import detect_anomalies

    return detect_anomalies(
        ft.anomaly_features(shapes.table(spark, sf_dir, "events")), "event_id", _SCORE_COLUMNS
    )


@query("anomaly_iforest")
def anomaly_iforest(spark, sf_dir):
    return scored_events(spark, sf_dir)


@query("high_risk")
def high_risk(spark, sf_dir):
    """Only the rows flagged as unusual."""
    return scored_events(spark, sf_dir).filter(F.col("predicted_fraud") == 1)


# A fixed rule in place of the model, so that the reports can be checked.
_RULE_SQL = """(SELECT event_id, user_id, event_type, value, CAST(value > 150 OR event_type = 'error' AS INTEGER) AS predicted_fraud,
  CAST(value > 120 AS INTEGER) AS is_fraud, (100 - value) / 200 AS anomaly_score FROM events)"""


def ruled(spark, sf_dir):
    v = F.col("value")
    return shapes.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        ((v > 150) | (F.col("event_type") == "error")).cast("int").alias("predicted_fraud"),
        (v > 120).cast("int").alias("is_fraud"),
        ((100 - v) / 200).alias("anomaly_score"),
    )


@query("confusion_metrics", f"""
WITH c AS (SELECT COUNT(*) FILTER (is_fraud = 1 AND predicted_fraud = 1) AS tp, COUNT(*) FILTER (is_fraud = 0 AND predicted_fraud = 1) AS fp,
  COUNT(*) FILTER (is_fraud = 1 AND predicted_fraud = 0) AS fn, COUNT(*) FILTER (is_fraud = 0 AND predicted_fraud = 0) AS tn FROM {_RULE_SQL}),
m AS (SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, tn / (tn + fn) AS precision_0, tn / (tn + fp) AS recall_0, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM c)
SELECT *, 2 * precision * recall / (precision + recall) AS f1, 2 * precision_0 * recall_0 / (precision_0 + recall_0) AS f1_0 FROM m""")
def confusion_metrics(spark, sf_dir):
    return ft.confusion(ruled(spark, sf_dir), "is_fraud", "predicted_fraud")


@query("risk_levels", f"""
SELECT event_id, event_type, predicted_fraud, anomaly_score, CASE WHEN predicted_fraud = 1 THEN 'High Risk' WHEN anomaly_score < -0.3 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level
FROM (SELECT e.event_id, e.event_type, c.predicted_fraud, c.anomaly_score FROM events e LEFT JOIN (SELECT * FROM {_RULE_SQL} WHERE event_type <> 'signup') c USING (event_id))""")
def risk_levels(spark, sf_dir):
    rows = shapes.table(spark, sf_dir, "events").select("event_id", "event_type")
    return ft.with_risk(rows, ruled(spark, sf_dir).filter("event_type <> 'signup'"), "event_id")


@query("fraud_summary", f"""
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (predicted_fraud = 1) AS flagged_orders,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (predicted_fraud = 1) AS DOUBLE) AS flagged_amount,
  round(COUNT(*) FILTER (predicted_fraud = 1) * 100.0 / COUNT(*), 2) AS fraud_rate_pct FROM {_RULE_SQL}""")
def fraud_summary(spark, sf_dir):
    return ft.fraud_summary(ruled(spark, sf_dir), "value")


@query("gold_ai_orders", f"""
SELECT r.event_id, r.user_id, r.value, r.predicted_fraud, CASE WHEN predicted_fraud = 1 THEN 'High Risk' WHEN anomaly_score < -0.3 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level,
  f.events, f.total_value FROM {_RULE_SQL} r JOIN (SELECT user_id, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM events GROUP BY 1) f USING (user_id)""")
def gold_ai_orders(spark, sf_dir):
    """Risk and customer features on every row."""
    rows = ruled(spark, sf_dir)
    per_user = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum(shapes.money("value")).cast("double").alias("total_value")
    )
    risk = ft.risk_level(F.col("predicted_fraud"), F.col("anomaly_score"))
    return ft.lookup(rows, per_user, "user_id").select(
        "event_id", "user_id", "value", "predicted_fraud", risk.alias("risk_level"), "events", "total_value"
    )


_SPLIT = f"""(SELECT customer_id, churned, ('0x' || left(md5(CAST(customer_id AS VARCHAR)), 8))::BIGINT < CAST(floor(0.2 * 4294967296) AS BIGINT) AS is_test FROM {RFM})"""


@query("stratified_split", f"SELECT customer_id, churned, is_test FROM {_SPLIT}")
def stratified_split(spark, sf_dir):
    return ft.stratified_split(rfm(spark, sf_dir), "customer_id", 0.2).select("customer_id", "churned", "is_test")


CUTOFFS = 4


def training(spark, sf_dir):
    orders = shapes.orders(spark, sf_dir)
    at = churn.cutoffs(shapes.latest(orders, "order_date"), CUTOFFS)
    return churn.training_rows(orders, shapes.lines(spark, sf_dir), shapes.products(spark, sf_dir), at)


_CUTOFF_ROWS = f"""
WITH c AS (SELECT CAST({ORDERS_END} - INTERVAL (90 * (k + 1)) DAY AS DATE) AS cutoff FROM range({CUTOFFS}) t(k)),
o AS (SELECT * FROM {ORDERS}),
b AS (SELECT customer_id, cutoff, max(order_date) AS latest, COUNT(*) AS frequency, SUM(amount) AS spent, COUNT(DISTINCT order_date) AS active_days
  FROM o JOIN c ON order_date < cutoff GROUP BY 1, 2),
k AS (SELECT customer_id, cutoff, COUNT(DISTINCT category) AS kinds FROM o JOIN c ON order_date < cutoff JOIN {LINES} USING (order_id) JOIN {PRODUCTS} USING (product_id) GROUP BY 1, 2)
SELECT b.customer_id, b.cutoff, date_diff('day', latest, b.cutoff)::INT AS recency_days, frequency, CAST(spent AS DOUBLE) AS monetary,
  CAST(spent AS DOUBLE) / frequency AS avg_order_value, active_days, coalesce(kinds, 0) AS categories_purchased,
  CAST(NOT EXISTS (SELECT 1 FROM o n WHERE n.customer_id = b.customer_id AND n.order_date >= b.cutoff AND n.order_date < b.cutoff + INTERVAL 90 DAY) AS INTEGER) AS churned
FROM b LEFT JOIN k USING (customer_id, cutoff)"""


@query("churn_training_rows", _CUTOFF_ROWS)
def churn_training_rows(spark, sf_dir):
    """Features before each cutoff, the label from the 90 days after it."""
    return training(spark, sf_dir)


@query("order_history_as_of", f"""
SELECT o.order_id, o.customer_id, o.order_date, COUNT(b.order_id) AS orders_before, coalesce(CAST(SUM(b.amount) AS DOUBLE), 0) AS spent_before,
  date_diff('day', max(b.order_date), o.order_date)::INT AS days_since_order
FROM {ORDERS} o LEFT JOIN {ORDERS} b ON b.customer_id = o.customer_id AND b.order_date < o.order_date GROUP BY 1, 2, 3""")
def order_history_as_of(spark, sf_dir):
    """Features of the customer as they were before each order."""
    return churn.order_history(shapes.orders(spark, sf_dir))


@query("churn_rf")
def churn_rf(spark, sf_dir):
    """Quality of the churn classifier on the test rows."""
    from sedimenta.plans import models

    _, scored = models.fit_churn(training(spark, sf_dir))
    return models.churn_report(scored)


@query("churn_importance")
def churn_importance(spark, sf_dir):
    from sedimenta.plans import models

    model, _ = models.fit_churn(training(spark, sf_dir))
    return models.churn_importance(model, spark)


# --- text -------------------------------------------------------------------

_CLASSES = "CASE " + " ".join(
    f"WHEN regexp_matches(lower(text), '{'|'.join(ws)}') THEN '{c}'" for c, ws in tx.CATEGORY_WORDS.items()
) + f" ELSE '{tx.OTHER}' END"


@query("classify_text", f"SELECT doc_id, {_CLASSES} AS ai_category FROM documents")
def classify_text(spark, sf_dir):
    docs = shapes.table(spark, sf_dir, "documents").select("doc_id", "text")
    return tx.classify(docs, "text").drop("text")


@query("classify_conversations", f"SELECT conv_id, turn, {_CLASSES} AS ai_category FROM conversations")
def classify_conversations(spark, sf_dir):
    turns = shapes.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return tx.classify(turns, "text").drop("text")


@query("category_distribution", f"SELECT {_CLASSES} AS ai_category, COUNT(*) AS product_count FROM documents GROUP BY 1")
def category_distribution(spark, sf_dir):
    return (
        classify_text(spark, sf_dir).groupBy("ai_category").agg(F.count(F.lit(1)).alias("product_count"))
        .orderBy(F.desc("product_count"), "ai_category")
    )


def _hits(words):
    return "(" + " + ".join(f"contains(lower(review_text), '{w}')::INT" for w in words) + ")"


@query("sentiment", f"""
SELECT review_id, rating, CASE WHEN rating >= 4 OR g > b THEN 'Positive' WHEN rating <= 2 OR b > g THEN 'Negative' ELSE 'Neutral' END AS sentiment
FROM (SELECT review_id, rating, {_hits(tx.POSITIVE_WORDS)} AS g, {_hits(tx.NEGATIVE_WORDS)} AS b FROM {REVIEWS})""")
def sentiment(spark, sf_dir):
    return tx.sentiment(shapes.reviews(spark, sf_dir), "review_text", "rating").select(
        "review_id", "rating", "sentiment"
    )


def _first(pattern, source):
    return f"nullif(regexp_extract(lower({source}), '{pattern}', 1), '')"


_ATTR = ", ".join([
    _first(rf"\b({'|'.join(tx.COLOURS)})\b", "{s}") + " AS color",
    _first(rf"\b({'|'.join(tx.MATERIALS)})\b", "{s}") + " AS material",
    _first(tx.SIZE_PATTERN, "{s}").replace("{s}", "{s}") + " AS size",
])
_DESCRIBED = "p_name || ', ' || p_brand || ', size ' || p_size || ', ' || lower(p_type) || ' ' || (p_size * 2) || '-inch steel'"


@query("extract_attributes", f"SELECT p_partkey, {_ATTR.replace('{s}', _DESCRIBED)} FROM part")
def extract_attributes(spark, sf_dir):
    text = F.concat(
        "p_name", F.lit(", "), "p_brand", F.lit(", size "), F.col("p_size").cast("string"), F.lit(", "),
        F.lower("p_type"), F.lit(" "), (F.col("p_size") * 2).cast("string"), F.lit("-inch steel"),
    )
    return shapes.table(spark, sf_dir, "part").select("p_partkey", *tx.extract_attributes(text))


@query("extract_document_attributes", f"SELECT doc_id, {_ATTR.replace('{s}', 'text')} FROM documents")
def extract_document_attributes(spark, sf_dir):
    return shapes.table(spark, sf_dir, "documents").select("doc_id", *tx.extract_attributes(F.col("text")))
