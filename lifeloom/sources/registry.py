"""Table definitions: typed schemas with key, required, default and retention metadata.

A definition is written as a list of column names; the Spark type follows from the
name (``…Date`` is a timestamp, ``…Count`` a long, …) and exceptions are marked
inline as ``Name:type``.  Deployments with their own definition files load them
with :meth:`TableDef.from_definition`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

from lifeloom.functions.columns import EMAIL_PATTERN

# Type tags.  A decimal has a scale only; precision is 18 throughout.
_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "email": T.StringType(),
    "phone": T.StringType(),
    "date": T.TimestampNTZType(),
    "day": T.DateType(),
    "flag": T.BooleanType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "money": T.DecimalType(18, 2),
    "rating": T.DecimalType(18, 1),
    "rate": T.DecimalType(18, 4),
}

# First rule whose suffix (or prefix ending in ^) matches decides; otherwise text.
_NAME_RULES: list[tuple[str, str]] = [
    ("EmailAddress", "email"),
    ("MobileNumber", "phone"),
    ("DateOfBirth", "day"),
    ("SendDate", "day"),
    ("Date", "date"),
    ("Timestamp", "date"),
    ("LastUpdated", "date"),
    ("RatePct", "rate"),
    ("AvgRating", "rating"),
    ("Category^", "flag"),
    ("OptIn", "flag"),
    ("TransactionalOnly", "flag"),
    ("Is^", "flag"),
    ("InStock", "flag"),
    ("Processed", "flag"),
    ("Resolved", "flag"),
    ("ReviewRequestSent", "flag"),
    ("CrossSellSent", "flag"),
    ("Used", "flag"),
    ("DiscountPercent", "int"),
    ("Year", "int"),
    ("Count", "long"),
    ("Quantity", "long"),
    ("Days^", "long"),
    ("JobID", "long"),
    ("EmailsSent", "long"),
    ("SMSSent", "long"),
    ("PointsBalance", "long"),
    ("PointsToNextTier", "money"),
    ("DaysSinceEngagement", "long"),
    ("Price", "money"),
    ("Total", "money"),
    ("Spend", "money"),
    ("OrderValue", "money"),
    ("ConfidenceScore", "money"),
    ("AvgScoreInBand", "money"),
]


@dataclass(frozen=True)
class Retention:
    kind: str = "None"  # PeriodAfterCreate | PeriodAfterDateAttribute | None
    days: int | None = None
    column: str | None = None
    action: str = "DeleteRecord"  # DeleteRecord | ArchiveThenDelete | None


@dataclass(frozen=True)
class ColumnDef:
    name: str
    kind: str
    key: bool = False
    required: bool = False
    default: str | None = None
    length: int | None = None
    scale: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.scale is not None:
            return T.DecimalType(18, self.scale)
        return _TYPES.get(self.kind, T.StringType())

    def struct_field(self) -> T.StructField:
        meta = {"pk": self.key, "required": self.required, "kind": self.kind}
        if self.default is not None:
            meta["default"] = self.default
        if self.length is not None:
            meta["length"] = self.length
        return T.StructField(self.name, self.spark_type, True, meta)


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[ColumnDef, ...]
    retention: Retention = field(default_factory=Retention)

    @property
    def key(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    def schema(self) -> T.StructType:
        return T.StructType([c.struct_field() for c in self.columns])

    @staticmethod
    def from_definition(doc: dict, name: str | None = None) -> "TableDef":
        """A definition document: ``{name, fields: [{name, type, length, …}], retentionPolicy}``."""
        kinds = {
            "text": "text", "emailaddress": "email", "phone": "phone", "date": "date",
            "boolean": "flag", "number": "long", "decimal": "money",
        }
        columns = tuple(
            ColumnDef(
                f["name"],
                kinds.get(str(f.get("type", "text")).lower(), "text"),
                bool(f.get("isPrimaryKey", False)),
                bool(f.get("isRequired", False)),
                f.get("defaultValue"),
                f.get("length"),
                f.get("scale", 2) if str(f.get("type", "")).lower() == "decimal" else None,
            )
            for f in doc["fields"]
        )
        rule = doc.get("retentionPolicy") or {}
        retention = Retention(
            rule.get("type", "None"), rule.get("periodDays"), rule.get("referenceAttribute"), rule.get("action", "None")
        )
        return TableDef(name or doc["name"], columns, retention)


def _kind_of(column: str) -> str:
    for rule, kind in _NAME_RULES:
        if rule.endswith("^"):
            if column.startswith(rule[:-1]) and column != "Category":
                return kind
        elif column.endswith(rule):
            return kind
    return "text"


def _table(
    name: str,
    columns: str,
    keys: int = 1,
    required: str = "",
    defaults: dict[str, str] | None = None,
    lengths: dict[str, int] | None = None,
    retention: Retention | None = None,
) -> TableDef:
    needed, defaults, lengths = set(required.split()), defaults or {}, lengths or {}
    defs = []
    for i, token in enumerate(columns.split()):
        column, _, kind = token.partition(":")
        kind = kind or _kind_of(column)
        fallback = 60 if column.endswith(("Key", "Id")) else None
        defs.append(
            ColumnDef(
                column, kind, i < keys, i < keys or column in needed, defaults.get(column), lengths.get(column, fallback)
            )
        )
    return TableDef(name, tuple(defs), retention or Retention())


def _after_create(days: int, column: str, action: str = "DeleteRecord") -> Retention:
    return Retention("PeriodAfterCreate", days, column, action)


# Table and column names, keys, defaults and retention periods of the data model.
_TABLES = [
    _table(
        "subscribers",
        "SubscriberKey EmailAddress MobileNumber FirstName LastName DateOfBirth Gender PreferredLanguage "
        "BusinessUnitMID EmailOptIn SMSOptIn SubscriberStatus SourceSystem CreatedDate LastModifiedDate "
        "LastEngagementDate UnifiedIndividualId",
        required="EmailAddress BusinessUnitMID CreatedDate",
        defaults={"PreferredLanguage": "en-US", "EmailOptIn": "true", "SMSOptIn": "false", "SubscriberStatus": "Active"},
        lengths={"FirstName": 100, "LastName": 100, "SubscriberStatus": 20},
        retention=Retention("PeriodAfterDateAttribute", 730, "LastEngagementDate"),
    ),
    _table(
        "preferences",
        "SubscriberKey CategoryWomens CategoryMens CategoryKids CategoryHome CategoryBeauty FrequencyPreference "
        "PromotionalOptIn TransactionalOnly SMSOptIn PushOptIn PreferredSendTimeStart PreferredSendTimeEnd "
        "LastUpdated UpdateSource",
        defaults={"CategoryWomens": "true", "CategoryMens": "true", "CategoryKids": "false", "CategoryHome": "false",
                  "CategoryBeauty": "false", "FrequencyPreference": "Standard", "PromotionalOptIn": "true",
                  "TransactionalOnly": "false", "SMSOptIn": "false", "PushOptIn": "false"},
        lengths={"FrequencyPreference": 20, "PreferredSendTimeStart": 5, "PreferredSendTimeEnd": 5},
    ),
    _table(
        "addresses",
        "AddressId SubscriberKey AddressType IsDefault Line1 Line2 City StateProvince PostalCode CountryCode "
        "LastModifiedDate",
        required="SubscriberKey", defaults={"IsDefault": "false"}, lengths={"CountryCode": 2, "PostalCode": 20},
    ),
    _table(
        "orders",
        "OrderId SubscriberKey OrderDate OrderStatus OrderTotal Currency ShippingCarrier TrackingNumber "
        "EstimatedDeliveryDate ActualDeliveryDate ReviewRequestSent CrossSellSent LastModifiedDate",
        required="SubscriberKey OrderDate",
        defaults={"Currency": "USD", "ReviewRequestSent": "false", "CrossSellSent": "false"},
        lengths={"Currency": 3, "OrderStatus": 30},
        retention=_after_create(1095, "OrderDate", "ArchiveThenDelete"),
    ),
    _table(
        "orders_archive",
        "OrderId SubscriberKey OrderDate OrderStatus OrderTotal Currency ShippingCarrier TrackingNumber "
        "EstimatedDeliveryDate ActualDeliveryDate ArchivedDate",
    ),
    _table(
        "order_lines", "LineItemId OrderId SKU ProductName Category Quantity UnitPrice LineTotal",
        required="OrderId SKU", lengths={"SKU": 40, "Category": 60},
    ),
    _table(
        "carts",
        "CartId SubscriberKey CartCreatedDate CartLastUpdatedDate CartStatus CartTotal ItemCount SKUsJSON "
        "DiscountCode RecoveryEmailsSent RecoverySMSSent RecoveredDate",
        required="SubscriberKey CartCreatedDate",
        defaults={"CartStatus": "Active", "RecoveryEmailsSent": "0", "RecoverySMSSent": "0"},
        lengths={"CartStatus": 20, "SKUsJSON": 4000, "DiscountCode": 30},
        retention=_after_create(14, "CartCreatedDate"),
    ),
    _table("cart_lines", "CartLineItemId CartId SubscriberKey SKU Quantity UnitPrice AddedToCartDate",
           required="CartId SubscriberKey SKU", lengths={"SKU": 40}),
    _table(
        "loyalty",
        "SubscriberKey LoyaltyMemberId CurrentTier PointsBalance PointsToNextTier TrailingTwelveMonthSpend "
        "TierEffectiveDate TierExpirationDate EnrollmentDate LastRecalculatedDate",
        defaults={"CurrentTier": "Bronze", "PointsBalance": "0"},
    ),
    _table("consent_log", "ConsentLogId SubscriberKey ChannelType ConsentAction ConsentSource IPAddress Timestamp",
           required="SubscriberKey Timestamp", lengths={"IPAddress": 45, "ConsentSource": 40},
           retention=_after_create(2555, "Timestamp", "None")),
    _table("discount_codes",
           "DiscountCode CampaignType DiscountPercent IsUsed AllocatedToSubscriberKey AllocatedDate ExpirationDate "
           "RedeemedDate",
           required="CampaignType", defaults={"IsUsed": "false"}, lengths={"DiscountCode": 30}),
    _table("ab_assignments", "TestId JourneyKey SubscriberKey TestName Variant EntryDate EmailNameSent",
           required="JourneyKey SubscriberKey"),
    _table("content_experiment", "ExperimentId SubscriberKey EmailName ContentVariant SendDate:date",
           required="SubscriberKey"),
    _table("suppression", "EmailAddress SuppressionReason SuppressedDate SourceBU SourceJourneyOrCampaign",
           required="SuppressedDate"),
    _table("products",
           "SKU ProductName Category SubCategory Brand Price SalePrice InStock InventoryCount ImageURL ProductURL "
           "AvgRating LastSyncedDate",
           defaults={"InStock": "true"}, lengths={"SKU": 40, "ProductName": 200, "Category": 60}),
    _table("identity_bridge", "UnifiedIndividualId BusinessUnitMID SubscriberKey MatchConfidenceScore LastResolvedDate",
           keys=2, required="SubscriberKey"),
    _table("staging_products",
           "SKU ProductName Category SubCategory Brand Price SalePrice InStock InventoryCount ImageURL ProductURL AvgRating",
           lengths={"SKU": 40}),
    _table("staging_codes", "DiscountCode CampaignType DiscountPercent", lengths={"DiscountCode": 30}),
    _table("fallback_queue", "OrderId FallbackEventType SubscriberKey Processed ProcessedDate", keys=2,
           required="SubscriberKey", defaults={"Processed": "false"}),
    _table("birthday_entry", "SubscriberKey EmailAddress FirstName CurrentTier BirthdayYear", required="EmailAddress"),
    _table("birthday_log", "SubscriberKey BirthdayYear EnteredDate", keys=2, required="EnteredDate",
           retention=_after_create(730, "EnteredDate")),
    _table("winback_entry", "SubscriberKey EmailAddress FirstName InactivityTier DaysSinceEngagement DetectedDate",
           required="EmailAddress"),
    _table("winback_log", "SubscriberKey InactivityTier EnteredDate", keys=2, required="EnteredDate"),
    _table("insights",
           "UnifiedIndividualId LifetimeSpend LifetimeOrderCount AvgOrderValue DaysSinceLastOrder ChurnRiskSegment "
           "TopCategory SecondCategory LastRefreshedDate"),
    _table("seg_high_value_at_risk", "SubscriberKey UnifiedIndividualId LifetimeSpend DaysSinceLastOrder"),
    _table("rpt_campaign",
           "JobID EmailName JourneyLabel SentCount OpenCount ClickCount BounceCount UnsubscribeCount ComplaintCount "
           "OpenRatePct ClickRatePct BounceRatePct ComplaintRatePct"),
    _table("rpt_deliverability",
           "SendDate BusinessUnitMID SentCount BounceCount HardBounceCount SoftBounceCount ComplaintCount BounceRatePct "
           "ComplaintRatePct GuardrailStatus", keys=2),
    _table("rpt_engagement", "ScoreBand SubscriberCount AvgScoreInBand"),
    _table("error_log", "ErrorLogId AutomationName ActivityName ErrorMessage Severity OccurredDate Resolved",
           required="AutomationName ActivityName OccurredDate", defaults={"Severity": "Error", "Resolved": "false"},
           lengths={"ErrorMessage": 4000, "Severity": 20}, retention=_after_create(180, "OccurredDate")),
    _table("row_count_history", "MetricName MetricValue RecordedDate"),
    _table("access_tokens", "Token SubscriberKey Purpose CreatedDate ExpirationDate Used",
           required="SubscriberKey CreatedDate ExpirationDate", defaults={"Used": "false"}, lengths={"Token": 64},
           retention=_after_create(7, "CreatedDate")),
    _table("config_env", "Name Value Environment LastModifiedDate", required="Value"),
    # Used by jobs but without a declared definition; the engine defines them.
    _table("welcome_entry", "SubscriberKey EmailAddress FirstName SignupSource SignupDate PromoCodeIssued",
           required="EmailAddress SignupDate"),
    _table("post_purchase_entry", "SubscriberKey OrderId OrderDate", keys=2, required="OrderDate"),
    _table("case_entry", "CaseId SubscriberKey CaseSubject CasePriority EscalatedDate"),
    _table("holiday_calendar", "CalendarDate:day BusinessUnitMID", keys=2),
]

REGISTRY: dict[str, TableDef] = {t.name: t for t in _TABLES}


@dataclass(frozen=True)
class Relationship:
    parent: str
    child: str
    column: str
    cascades: bool


# The parent/child graph.  Orders and consent outlive a deleted subscriber.
RELATIONSHIPS = [
    Relationship("subscribers", "preferences", "SubscriberKey", True),
    Relationship("subscribers", "addresses", "SubscriberKey", True),
    Relationship("subscribers", "orders", "SubscriberKey", False),
    Relationship("orders", "order_lines", "OrderId", True),
    Relationship("subscribers", "loyalty", "SubscriberKey", True),
    Relationship("subscribers", "carts", "SubscriberKey", True),
    Relationship("carts", "cart_lines", "CartId", True),
    Relationship("subscribers", "consent_log", "SubscriberKey", False),
    Relationship("subscribers", "identity_bridge", "SubscriberKey", False),
]

# Closed value sets of enumerated columns.
ENUMS: dict[tuple[str, str], list[str]] = {
    ("subscribers", "SubscriberStatus"): ["Active", "Held", "Bounced", "Unsubscribed", "Sunset"],
    ("carts", "CartStatus"): ["Active", "Abandoned", "Converted", "Expired"],
    ("orders", "OrderStatus"): [
        "Placed", "Confirmed", "Shipped", "OutForDelivery", "Delivered", "Cancelled", "Returned",
    ],
    ("loyalty", "CurrentTier"): ["Bronze", "Silver", "Gold", "Platinum"],
    ("preferences", "FrequencyPreference"): ["Standard", "Reduced", "EssentialOnly"],
    ("suppression", "SuppressionReason"): ["Unsubscribe", "HardBounce", "SpamComplaint", "LegalOptOut", "ManualSuppress"],
    ("discount_codes", "CampaignType"): ["AbandonedCart10", "AbandonedCart15", "WelcomeSeries"],
    ("winback_log", "InactivityTier"): ["Tier1_90Day", "Tier2_180Day", "Sunset"],
    ("consent_log", "ChannelType"): ["Email", "SMS", "Push"],
    ("consent_log", "ConsentAction"): ["OptIn", "OptOut"],
    ("error_log", "Severity"): ["Warning", "Error", "Critical"],
    ("welcome_entry", "SignupSource"): ["Web", "MobileApp", "InStoreKiosk", "SocialLogin", "SmartCapture"],
}

PATTERNS: dict[str, str] = {"email": EMAIL_PATTERN}


def table(name: str) -> TableDef:
    return REGISTRY[name]


def schema(name: str) -> T.StructType:
    return REGISTRY[name].schema()


def load_definitions(folder: str) -> dict[str, TableDef]:
    """Definitions from a folder of JSON documents (deployment metadata, read on the driver)."""
    found = {}
    for path in sorted(Path(folder).glob("*.json")):
        doc = TableDef.from_definition(json.loads(path.read_text()), None)
        found[doc.name] = doc
    return found
