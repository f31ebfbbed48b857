"""Scalar helpers: rounding, calendar parts, categories, labels, scaling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyrill.schemas import SEGMENT_WEIGHTS

# Ordered keyword rules, first hit wins.
CATEGORY_RULES = (
    ("Protein", ("protein", "whey", "casein", "isolate")),
    ("Amino Acids", ("creatine", "bcaa", "amino", "glutamine", "eaa")),
    ("Vitamins", ("vitamin", "mineral", "multivitamin", "omega", "fish oil")),
    ("Performance", ("pre-workout", "preworkout", "pre workout", "energy", "caffeine")),
    ("Snacks", ("protein bar", "bar", "snack", "shake")),
)


DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int) -> Column:
    """Half-to-even rounding on doubles."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


# Written date forms besides ISO text that can be read in one way only.
DATE_PATTERNS = ("yyyy/M/d", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy")
MONTH_FIRST, DAY_FIRST = "M/d/yyyy", "d/M/yyyy"


def to_day(c: Column | str, day_first: bool = False) -> Column:
    """Day of a date, timestamp, ISO text or text in one of the written forms, else null.

    Numbers parted by slashes are read month first, or all of them day first: never one value this way and the next
    the other.
    """
    text = F.trim(col(c).cast("string"))
    patterns = (DAY_FIRST if day_first else MONTH_FIRST, *DATE_PATTERNS)
    return F.to_date(F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(p)) for p in patterns]))


def date_reading(c: Column | str) -> dict[str, Column]:
    """Aggregates of a date column: values, and how many of them either order of day and month reads."""
    text = F.trim(col(c).cast("string"))
    return {"values": F.count(text), "month_first": F.count(to_day(text)), "day_first": F.count(to_day(text, True))}


def numbered_id(prefix: str, index: Column | str, width: int = 6) -> Column:
    number = col(index)
    text = number.cast("string")  # padding is far cheaper than a format; the rest keeps that
    return (F.when((number >= 0) & (number < 10 ** width), F.concat(F.lit(prefix), F.lpad(text, width, "0")))
            .when(number > 0, F.concat(F.lit(prefix), text)).otherwise(F.format_string(f"{prefix}%0{width}d", number)))


def category_of(name: Column | str) -> Column:
    text = F.lower(col(name))
    rule = None
    for label, words in CATEGORY_RULES:
        hit = text.contains(words[0])
        for word in words[1:]:
            hit = hit | text.contains(word)
        rule = F.when(hit, label) if rule is None else rule.when(hit, label)
    return rule.otherwise("Other")


def weekday_monday0(day: Column | str) -> Column:
    return F.weekday(col(day))


def weekend_flag(day: Column | str) -> Column:
    return F.weekday(col(day)).isin(5, 6).cast("int")


def calendar_columns(day: Column | str, full: bool) -> dict[str, Column]:
    """Calendar features; ``full`` adds the two that only sales rows carry."""
    d = col(day)
    parts = {"year": F.year(d), "month": F.month(d)}
    if full:
        parts["quarter"] = F.quarter(d)
    parts["day_of_week"] = weekday_monday0(d)
    if full:
        # a lookup is far cheaper than a format
        parts["day_name"] = F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), F.weekday(d) + 1)
    parts["week"] = F.weekofyear(d)
    parts["is_weekend"] = weekend_flag(d)
    return parts


def scale_between(value: Column, low: Column, high: Column, floor: float, ceiling: float,
                  constant: float) -> Column:
    """Min-max scaling into [floor, ceiling]; ``constant`` where all values are equal."""
    span = ceiling - floor
    return F.when(high > low, F.lit(floor) + F.lit(span) * (value - low) / (high - low)).otherwise(
        F.lit(constant))


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def strength_label(r: Column | str) -> Column:
    a = F.abs(col(r))
    return (F.when(a >= 0.7, "fuerte").when(a >= 0.5, "moderada-fuerte").when(a >= 0.3, "moderada")
            .when(a >= 0.1, "debil").when(a.isNotNull(), "muy debil"))


def direction_label(r: Column | str) -> Column:
    return F.when(col(r) > 0, "positiva").when(col(r).isNotNull(), "negativa")


def influence_label(r: Column | str) -> Column:
    a = F.abs(col(r))
    return (F.when(a >= 0.4, "influyen").when(a >= 0.2, "influencia limitada")
            .when(a.isNotNull(), "influencia muy debil o inexistente"))


def horizon_label(lag: Column | str) -> Column:
    k = col(lag)
    return (F.when(k == 0, "inmediato").when(k <= 3, "corto plazo")
            .when(k.isNotNull(), "mediano plazo"))


def sign_band(r: Column | str) -> Column:
    return F.when(col(r) > 0, "green").when(col(r).isNotNull(), "red")


def segment_band(r: Column | str) -> Column:
    return (F.when(col(r) >= 0.5, "strong").when(col(r) >= 0.3, "moderate")
            .when(col(r).isNotNull(), "weak"))


def segment_weight(label: Column | str) -> Column:
    pairs = [F.lit(x) for kv in SEGMENT_WEIGHTS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(label)), F.lit(1.0))


def age_text(seconds: Column) -> Column:
    """Minutes below one hour, hours from there on."""
    return F.when(
        seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m"))
    ).otherwise(F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h")))
