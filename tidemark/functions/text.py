"""Text expressions: label clean-up, date and rate texts, masking, hashes, display."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as the publisher writes them.
MONTH_NAMES = [
    "januari", "februari", "maret", "april", "mei", "juni",
    "juli", "agustus", "september", "oktober", "november", "desember",
]

# What a secret looks like in free text, and what stays in front of the mask.
SECRET_PATTERNS = [
    r"(?i)((?:api[_-]?key|authorization|password|secret|token)\s*=\s*)[^\s,;]+",
    r"(?i)(/key/)[^/?\s]+",
    r"(?i)(authorization\s*[:=]\s*)(?:bearer\s+)?[^\s,;]+",
    r"(?i)(://[^:\s/@]+:)[^@\s/]+(?=@)",
]

# Labels that add nothing to a series name.
REDUNDANT_PERIOD_LABELS = ["", "tahun", "tahunan", "annual"]


def normalize_label(text: Column) -> Column:
    visible = F.regexp_replace(text, "[\u200b\u200c\u200d\ufeff]", "")
    return F.lower(F.trim(F.regexp_replace(F.translate(visible, "\u00a0", " "), r"\s+", " ")))


def year_in_label(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?<![0-9])([0-9]{4})(?![0-9])", 1)
    year = F.nullif(found, F.lit("")).cast("int")
    return F.when(year.between(1900, 9999), year)


def named_month_date(text: Column) -> Column:
    """`17 Desember 2025` to a date; NULL if the text is no such date."""
    label = normalize_label(text)
    pattern = r"^([0-9]{1,2}) ([a-z]+) ([0-9]{4})$"
    month = F.array_position(F.lit(MONTH_NAMES), F.regexp_extract(label, pattern, 2))
    parts = [F.regexp_extract(label, pattern, i) for i in (3, 1)]
    iso = F.concat(parts[0], F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(parts[1], 2, "0"))
    return F.when(label.rlike(pattern) & (month > 0), F.try_to_date(iso, "yyyy-MM-dd"))


def rate_text(text: Column) -> Column:
    """`5,75 %` to an exact number; NULL if the text is no such rate."""
    digits = F.regexp_extract(text, r"^\s*([0-9]+(?:[.,][0-9]+)?)\s*%?\s*$", 1)
    return F.replace(F.nullif(digits, F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(24,6)")


def redact(text: Column) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, p, "$1[REDACTED]"), SECRET_PATTERNS, text)


def content_hash(*columns: Column) -> Column:
    """SHA-256 of the JSON text of the fields, in the given order."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def key_hash(*columns: Column) -> Column:
    return F.sha2(F.concat_ws(":", *columns), 256)


def series_code(prefix: Column, variant: Column, period: Column) -> Column:
    return F.concat(prefix, F.lit(".TV"), variant, F.lit(".TP"), period)


def series_name(variable: Column, variant: Column, period: Column) -> Column:
    """Join the labels that say something new."""
    variant_counts = (F.coalesce(variant, F.lit("")) != "") & ~F.lower(variant).isin("-") & (
        F.lower(variant) != F.lower(variable)
    )
    period_counts = ~F.lower(F.coalesce(period, F.lit(""))).isin(REDUNDANT_PERIOD_LABELS)
    parts = F.array(variable, F.when(variant_counts, variant), F.when(period_counts, period))
    return F.array_join(F.array_compact(parts), " — ")


def _local_number(number: Column) -> Column:
    """Two digits at most, dot for thousands and comma for decimals."""
    plain = F.regexp_replace(F.format_number(number, 2), r"\.?0+$", "")
    return F.translate(F.when(F.format_number(number, 2).endswith(".00"), F.format_number(number, 0)).otherwise(plain), ",.", ".,")


def display_value(value: Column, unit: Column) -> Column:
    """Value for a table cell, with the mark its unit calls for; a dash for no value."""
    text, label = _local_number(value.cast("double")), F.lower(F.coalesce(unit, F.lit("")))
    return (
        F.when(value.isNull(), F.lit("—"))
        .when(F.contains(label, F.lit("percent")), F.concat(text, F.lit("%")))
        .when(F.contains(label, F.lit("current usd")), F.concat(F.lit("US$"), text))
        .when(F.contains(label, F.lit("idr per usd")), F.concat(F.lit("Rp"), text, F.lit("/USD")))
        .otherwise(text)
    )


def signed_text(value: Column, suffix: str = "") -> Column:
    text = F.concat(_local_number(value.cast("double")), F.lit(suffix))
    return F.when(value > 0, F.concat(F.lit("+"), text)).otherwise(text)
