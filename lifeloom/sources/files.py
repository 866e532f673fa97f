"""Readers: CSV snapshots, JSON events, row sets, cart SKU text, DMARC XML, filtered reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.functions.columns import truthy
from lifeloom.sources.registry import TableDef, table

CORRUPT = "_corrupt_record"


def _as_text(definition: TableDef) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.StringType()) for c in definition.columns])


def typed(raw: DataFrame, definition: TableDef, apply_defaults: bool = True) -> DataFrame:
    """Text columns to the declared types; absent columns become NULL or their default."""
    out = []
    for c in definition.columns:
        value = F.col(c.name) if c.name in raw.columns else F.lit(None).cast("string")
        text = F.nullif(F.trim(value.cast("string")), F.lit(""))
        if apply_defaults and c.default is not None:
            text = F.coalesce(text, F.lit(c.default))
        if isinstance(c.spark_type, T.BooleanType):
            value = truthy(text)
        elif isinstance(c.spark_type, T.TimestampNTZType):
            # Zoned input ("…Z", "+02:00") is moved to UTC, plain input is taken as UTC.
            zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
            utc = F.convert_timezone(
                F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz")
            )
            value = F.when(zoned, utc).otherwise(text.try_cast("timestamp_ntz"))
        elif isinstance(c.spark_type, T.StringType):
            value = text
        else:
            value = text.try_cast(c.spark_type)
        out.append(value.alias(c.name))
    extra = [F.col(CORRUPT)] if CORRUPT in raw.columns else []
    return raw.select(*out, *extra)


def read_csv(spark: SparkSession, path: str, name: str, header_columns: list[str] | None = None) -> DataFrame:
    """Header-matched CSV read of a registered table.

    ``header_columns`` lists the columns present in the files when they carry a
    subset; the header itself is matched by name, not by position.
    """
    definition = table(name)
    shape = _as_text(definition)
    if header_columns is not None:
        shape = T.StructType([T.StructField(h, T.StringType()) for h in header_columns])
    raw = (
        spark.read.schema(shape)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return typed(raw, definition)


def event_schema(data_fields: str) -> str:
    return f"ContactKey STRING, EventDefinitionKey STRING, Data STRUCT<{data_fields}>"


# Payload fields of the public event contracts.
EVENT_DATA_FIELDS = (
    "SubscriberKey: STRING, EmailAddress: STRING, FirstName: STRING, SignupSource: STRING, SignupDate: TIMESTAMP_NTZ, "
    "PromoCodeIssued: STRING, OrderId: STRING, OrderDate: TIMESTAMP_NTZ, ShippingCarrier: STRING, "
    "TrackingNumber: STRING, ShippedDate: TIMESTAMP_NTZ, EstimatedDeliveryDate: TIMESTAMP_NTZ, "
    "ActualDeliveryDate: TIMESTAMP_NTZ, ReturnedDate: TIMESTAMP_NTZ, CaseId: STRING, CaseSubject: STRING, "
    "CasePriority: STRING, EscalatedDate: TIMESTAMP_NTZ"
)


def parse_events(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON event text to typed columns; unknown fields are ignored, malformed text becomes NULLs."""
    parsed = F.from_json(F.col(value), event_schema(EVENT_DATA_FIELDS), {"mode": "PERMISSIVE"})
    return df.withColumn("_event", parsed).select(
        *[c for c in df.columns if c != value],
        F.col("_event.ContactKey").alias("ContactKey"),
        F.col("_event.EventDefinitionKey").alias("EventDefinitionKey"),
        F.col("_event.Data").alias("Data"),
    )


# Fields of the cart row-set contract.
ROWSET_SCHEMA = (
    "ARRAY<STRUCT<keys: STRUCT<CartId: STRING>, values: STRUCT<SubscriberKey: STRING, "
    "CartCreatedDate: TIMESTAMP_NTZ, CartLastUpdatedDate: TIMESTAMP_NTZ, CartStatus: STRING, "
    "CartTotal: DECIMAL(18,2), ItemCount: BIGINT, DiscountCode: STRING>>>"
)


def explode_rowset(df: DataFrame, value: str = "value", schema: str = ROWSET_SCHEMA) -> DataFrame:
    """``[{keys, values}, …]`` text to flat rows."""
    kept = [c for c in df.columns if c != value]
    entry = F.explode(F.from_json(F.col(value), schema)).alias("_entry")
    return df.select(*kept, entry).select(*kept, "_entry.keys.*", "_entry.values.*")


SKUS_SCHEMA = "ARRAY<STRUCT<sku: STRING, qty: BIGINT, price: DECIMAL(18,2)>>"


def explode_cart_skus(carts: DataFrame) -> DataFrame:
    """(CartId, SKU, Quantity, UnitPrice) from the SKU text; carts without any keep one row."""
    item = F.explode_outer(F.from_json("SKUsJSON", SKUS_SCHEMA)).alias("_item")
    return carts.select("CartId", item).select(
        "CartId",
        F.col("_item.sku").alias("SKU"),
        F.col("_item.qty").alias("Quantity"),
        F.col("_item.price").alias("UnitPrice"),
    )


# Nested as in real reports; the two result fields may also sit in auth_results.
DMARC_SCHEMA = (
    "row STRUCT<source_ip: STRING, count: BIGINT, "
    "policy_evaluated: STRUCT<disposition: STRING, dkim: STRING, spf: STRING>>, "
    "source_ip STRING, count BIGINT, dkim STRING, spf STRING, disposition STRING"
)


def _dmarc_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.coalesce("row.source_ip", "source_ip").alias("SourceIp"),
        F.coalesce("row.count", "count", F.lit(0)).alias("MessageCount"),
        F.coalesce("row.policy_evaluated.dkim", "dkim").alias("Dkim"),
        F.coalesce("row.policy_evaluated.spf", "spf").alias("Spf"),
        F.coalesce("row.policy_evaluated.disposition", "disposition").alias("Disposition"),
    )


def read_dmarc(spark: SparkSession, path: str) -> DataFrame:
    """Record rows of a folder of aggregate reports (nested or flat record layout)."""
    return _dmarc_columns(spark.read.format("xml").option("rowTag", "record").schema(DMARC_SCHEMA).load(path))


def parse_dmarc(df: DataFrame, value: str = "value") -> DataFrame:
    """Record rows from a column that holds one ``<record>`` element per row."""
    record = F.from_xml(F.col(value), DMARC_SCHEMA)
    return _dmarc_columns(df.select(record.alias("_r")).select("_r.*"))


def filtered_read(df: DataFrame, columns: list[str], where: dict[str, object]) -> DataFrame:
    """Projection plus equality (scalar) or IN (list) filters; both reach the parquet scan."""
    for name, wanted in where.items():
        condition = F.col(name).isin(*wanted) if isinstance(wanted, (list, tuple, set)) else F.col(name) == wanted
        df = df.filter(condition)
    return df.select(*columns)
