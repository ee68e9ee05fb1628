"""Rule catalogues: JSON documents flattened to one row per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shape of a catalogue document and the severities it may use.
CATALOGUE_SCHEMA = (
    "rules array<struct<rule: string, title: string, checks: string, severity: string, "
    "fixable: boolean, observations: array<string>>>"
)
SEVERITIES = ("error", "warning", "fyi", "mixed")


def rules_table(catalogues: DataFrame, content: str = "content") -> DataFrame:
    """``(rule, title, checks, severity, fixable, observations)``; blank texts are NULL."""
    rules = catalogues.select(F.explode(F.from_json(content, CATALOGUE_SCHEMA)["rules"]).alias("r"))

    def text(name: str) -> Column:
        return F.nullif(F.col(f"r.{name}"), F.lit("")).alias(name)

    return rules.select(
        text("rule"), text("title"), text("checks"), text("severity"),
        F.col("r.fixable").alias("fixable"),
        F.nullif(F.array_join("r.observations", ","), F.lit("")).alias("observations"),
    )


def invalid_rules(rules: DataFrame) -> DataFrame:
    """Rules without a title or with a severity that is not in the known set."""
    return rules.where(F.col("title").isNull() | ~F.col("severity").isin(*SEVERITIES))
