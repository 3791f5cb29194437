"""Table descriptions: every operator takes ``(df, spec)`` instead of hard-coded names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """A flat table with a key, a binary label, numeric columns and categorical columns.

    ``categorical`` maps a column to its fixed vocabulary, ``{lower-case value: feature name}``;
    the vocabulary order is the feature order. ``rename`` maps raw names to clean names in
    output order. ``fills`` holds the value that replaces NULL, per clean column.
    """

    name: str
    keys: tuple[str, ...]
    label: str
    numeric: tuple[str, ...]
    categorical: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    fills: Mapping[str, object] = field(default_factory=dict)
    raw_schema: T.StructType | None = None

    @property
    def one_hot(self) -> tuple[str, ...]:
        return tuple(f for vocabulary in self.categorical.values() for f in vocabulary.values())

    @property
    def features(self) -> tuple[str, ...]:
        """Feature names in model-input order."""
        return self.numeric + self.one_hot

    @property
    def columns(self) -> tuple[str, ...]:
        """Clean columns in output order."""
        if self.rename:
            return tuple(self.rename.values())
        return (*self.keys, *self.numeric, *self.categorical, self.label)


# Raw column names and types, clean names, fill values, vocabularies and feature
# names of the churn table.
CHURN = DatasetSpec(
    name="churn",
    keys=("customer_id",),
    label="churn",
    numeric=(
        "age",
        "tenure",
        "usage_frequency",
        "support_calls",
        "payment_delay",
        "total_spend",
        "last_interaction",
    ),
    categorical={
        "gender": {"male": "gender_male", "female": "gender_female"},
        "subscription_type": {
            "basic": "subscription_basic",
            "standard": "subscription_standard",
            "premium": "subscription_premium",
        },
        "contract_length": {
            "monthly": "contract_monthly",
            "quarterly": "contract_quarterly",
            "annual": "contract_annual",
        },
    },
    rename={
        "CustomerID": "customer_id",
        "Age": "age",
        "Gender": "gender",
        "Tenure": "tenure",
        "Usage Frequency": "usage_frequency",
        "Support Calls": "support_calls",
        "Payment Delay": "payment_delay",
        "Subscription Type": "subscription_type",
        "Contract Length": "contract_length",
        "Total Spend": "total_spend",
        "Last Interaction": "last_interaction",
        "Churn": "churn",
    },
    fills={
        "age": 0,
        "gender": "Unknown",
        "tenure": 0,
        "usage_frequency": 0,
        "support_calls": 0,
        "payment_delay": 0,
        "subscription_type": "Unknown",
        "contract_length": "Unknown",
        "total_spend": 0.0,
        "last_interaction": 0,
    },
    raw_schema=T.StructType()
    .add("CustomerID", T.IntegerType())
    .add("Age", T.IntegerType())
    .add("Gender", T.StringType())
    .add("Tenure", T.IntegerType())
    .add("Usage Frequency", T.IntegerType())
    .add("Support Calls", T.IntegerType())
    .add("Payment Delay", T.IntegerType())
    .add("Subscription Type", T.StringType())
    .add("Contract Length", T.StringType())
    .add("Total Spend", T.DoubleType())
    .add("Last Interaction", T.IntegerType())
    .add("Churn", T.IntegerType()),
)
