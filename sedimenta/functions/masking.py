"""Masking and tokens as column functions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the masks.
SSN_MASK = "***-**-****"
PHONE_PREFIX = "***-***-"
CARD_PREFIX = "****-****-****-"


def mask_email(c: Column) -> Column:
    """First two characters and the domain; NULL stays NULL."""
    name, domain = F.split_part(c, F.lit("@"), F.lit(1)), F.split_part(c, F.lit("@"), F.lit(2))
    return F.concat(F.left(name, F.lit(2)), F.lit("***@"), domain)


def mask_email_domain(c: Column) -> Column:
    return F.concat(F.lit("***@"), F.split_part(c, F.lit("@"), F.lit(2)))


def mask_phone(c: Column) -> Column:
    return F.concat(F.lit(PHONE_PREFIX), F.right(c, F.lit(4)))


def mask_ssn(c: Column) -> Column:
    """A constant, whatever the value."""
    return F.lit(SSN_MASK)


def mask_card(c: Column) -> Column:
    return F.concat(F.lit(CARD_PREFIX), c)


def mask_for_role(c: Column, masked: Column, role: str, allowed: set[str]) -> Column:
    """Clear text for the allowed roles; the choice is made in the plan."""
    return c if role in allowed else masked


def token(c: Column, salt: str) -> Column:
    """The same value and salt give the same token, here and in the mapping."""
    return F.when(c.isNotNull(), F.sha2(F.concat_ws("|", c, F.lit(salt)), 256))


def create_sql_functions(spark: SparkSession) -> None:
    """The masks as temporary SQL functions of the session."""
    for name, body in {
        "mask_email": "concat(left(split_part(v, '@', 1), 2), '***@', split_part(v, '@', 2))",
        "mask_phone": f"concat('{PHONE_PREFIX}', right(v, 4))",
        "mask_ssn": f"'{SSN_MASK}'",
        "mask_card": f"concat('{CARD_PREFIX}', v)",
    }.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS STRING RETURN {body}"
        )
