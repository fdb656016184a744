"""Model responses: fences, verdicts, closed vocabularies and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The closed vocabularies.
CONFIDENCES = ("high", "medium")
BLANK = " \t\n\r\x0b\x0c"
_FENCE = r"(?s)```(?:json)?\s*(.*?)```"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK))


def strip_fences(text: Column) -> Column:
    """The first fenced block, else the text; trimmed."""
    return F.when(F.regexp_like(text, F.lit(_FENCE)), strip(F.regexp_extract(text, _FENCE, 1))).otherwise(strip(text))


def rejected(verdict: Column) -> Column:
    return F.upper(strip(verdict)).startswith("YES")


def known_labels(scene: Column) -> Column:
    """Distinct lower-cased labels of the numbered lines, in order."""
    found = F.regexp_extract_all(scene, F.lit(r"(?m)^\d+\.\s+([^\[]+)"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.lower(strip(x))), lambda x: x != ""))


def allowed(values: Column, vocabulary: tuple[str, ...]) -> Column:
    """The values that the vocabulary has, repeats kept."""
    return F.coalesce(F.filter(values, lambda x: x.isin(*vocabulary)), F.array().cast("array<string>"))


def confidence(value: Column) -> Column:
    return F.when(value.isin(*CONFIDENCES), value).otherwise("medium")


def json_text(variant: Column, path: str, missing: str) -> Column:
    """A field as text: the default if it is missing, None if it is null, digits for a number."""
    got = F.variant_get(variant, path, "variant")
    return F.when(got.isNull(), missing).when(F.is_variant_null(got), "None").otherwise(F.try_variant_get(variant, path, "string"))


def subject_known(subject: Column, labels: Column) -> Column:
    """Any subject is known where there are no labels."""
    return (F.size(labels) == 0) | F.array_contains(labels, subject)
