"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MISSING, WIDE

FIELD_MARK = "\x1f"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def parse_scaled(raw: Column, scale: int, sound: Column | None = None) -> Column:
    """Exact decimal text as an integer times ten to the ``scale``; null for blank; ``is_scaled`` says what is valid
    (``sound``, if that is known already).

    A leading point or a lone sign or point counts as zero before or after it; more digits than ``scale`` are invalid."""
    text = F.trim(raw)
    fraction = F.rpad(F.regexp_extract(text, r"\.([0-9]*)$", 1), scale, "0") if scale else F.lit("")
    # Whole numbers, which most are, need no pattern. A sign and no digit is zero.
    whole = F.when(~text.contains("."), text.try_cast("bigint") * F.lit(10**scale))
    number = F.coalesce(whole, F.concat(F.regexp_extract(text, r"^-?[0-9]*", 0), fraction).try_cast("bigint"), F.lit(0))
    return F.when((is_scaled(raw, scale) if sound is None else sound) & (text != ""), number)


def is_scaled(raw: Column, scale: int) -> Column:
    """Decimal text of at most ``scale`` places that fits a bigint once scaled (so at most 18 digits, leading zeros aside)."""
    return F.trim(raw).rlike(rf"^-?0*[0-9]{{0,{18 - scale}}}(\.[0-9]{{0,{scale}}})?$")


def parse_integer(raw: Column, sound: Column | None = None) -> Column:
    """Signed integer text, null for blank and for anything else (``is_integer`` tells them apart; ``sound``, if that is known
    already)."""
    number = F.trim(raw).try_cast("bigint")
    digits = F.trim(raw).rlike(r"^[+-]?[0-9]+$")
    return F.when(digits, number) if sound is None else F.when(sound, number).when(digits, number)


def is_integer(raw: Column) -> Column:
    """Integer text that fits a bigint: at most 18 digits, leading zeros aside."""
    return F.trim(raw).rlike(r"^([+-]?0*[0-9]{1,18})?$")


def is_month(text: Column) -> Column:
    return F.trim(text).rlike(r"^20[0-9]{2}-(0[1-9]|1[0-2])$")


def parse_factor_date(raw: Column) -> Column:
    """MMCCYY as YYYY-MM, null if it isn't one of this century."""
    text = F.trim(raw)
    return F.when(text.rlike(r"^(0[1-9]|1[0-2])20[0-9]{2}$"), F.concat(F.substring(text, 3, 4), F.lit("-"), F.substring(text, 1, 2)))


def publication_date(member: Column) -> Column:
    """``aaYYMMDD.txt`` as 20YY-MM-DD, null for other names."""
    return F.when(member.rlike(r"(?i)^[a-z]{2,}[0-9]{6}\.txt$"), F.regexp_replace(F.lower(member), r"^[a-z]+([0-9]{2})([0-9]{2})([0-9]{2})\.txt$", "20$1-$2-$3"))


def as_of_timestamp(published: Column) -> Column:
    return F.concat(published, F.lit("T23:59:59Z"))


def parse_flag(raw: Column) -> Column:
    """1 for true/1/yes/y, 0 for false/0/no/n/blank, null for anything else; without case."""
    text = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.when(text.isin("true", "1", "yes", "y"), 1).when(text.isin("false", "0", "no", "n", ""), 0)


def month_index(period: Column) -> Column:
    return F.substring(period, 1, 4).cast("int") * 12 + F.substring(period, 6, 2).cast("int")


def adjacent(prior: Column, current: Column, months: int = 1) -> Column:
    return month_index(current) - month_index(prior) == months


def within_months(start: Column, event: Column, months: int) -> Column:
    gap = month_index(event) - month_index(start)
    return (gap > 0) & (gap <= months)


#: Bands of days delinquent, in order.
BANDS = ("Current", "1-29", "30-59", "60-89", "90+")


def delinquency_band(days: Column) -> Column:
    return F.when(days.isNull(), MISSING).when(days <= 0, "Current").when(days < 30, "1-29").when(days < 60, "30-59").when(days < 90, "60-89").otherwise("90+")


def transition_event(prior: Column, current: Column, threshold: int = 30) -> Column:
    """What happened between two states of one loan, from days delinquent; null prior days can't start a transition."""
    rank = lambda d: F.when(d <= 0, 0).when(d < 30, 1).when(d < 60, 2).when(d < 90, 3).otherwise(4)
    return (
        F.when(prior.isNull(), "ineligible").when(current.isNull(), "attrition").when((prior >= threshold) & (current == 0), "cure")
        .when((prior <= 0) & (current >= threshold), "new_delinquency").when(rank(prior) == rank(current), "stable").when(rank(current) > rank(prior), "worsening").otherwise("improvement")
    )


def comparability(failures: Column, warnings: Column) -> Column:
    return F.when(failures > 0, "fail").when(warnings > 0, "warn").otherwise("pass")


def safe_ratio(numerator: Column, denominator: Column, scale: int = 1) -> Column:
    """Quotient as a double, null unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double") / scale)


def smm(unscheduled: Column, surviving: Column) -> Column:
    return F.when((surviving > 0) & (unscheduled >= 0) & (unscheduled <= surviving), unscheduled.cast("double") / surviving.cast("double"))


def cpr(monthly: Column) -> Column:
    return F.when((monthly >= 0) & (monthly <= 1), 1 - F.pow(1 - monthly, F.lit(12.0)))


def ending_residual(beginning, additions, adjustments, scheduled, curtailment, voluntary, involuntary, terminations, ending) -> Column:
    """What the balance bridge leaves unexplained."""
    return beginning + additions + adjustments - scheduled - curtailment - voluntary - involuntary - terminations - ending


def insurance_status(percent: Column, cancelled: Column) -> Column:
    return F.when(percent.isNull(), MISSING).when(percent > 0, "Active coverage").when(cancelled == "Y", "Cancelled or expired").otherwise("No disclosed MI")


def modification_status(program: Column) -> Column:
    return F.when(F.trim(F.coalesce(program, F.lit(""))) != "", "Disclosed program").otherwise("No disclosed program")


def member(c: Column) -> Column:
    """A segment's label: trimmed text, ``Missing`` for blank."""
    return F.coalesce(blank_to_null(c.cast("string")), F.lit(MISSING))


def fixed_label(c: Column, scale: int = 100) -> Column:
    """A scaled integer as text with two decimals."""
    return F.when(c.isNull(), MISSING).otherwise(F.format_string("%.2f", c / F.lit(scale)))


def record_hash(*columns: Column) -> Column:
    """SHA-256 over the values, nulls as empty, with a mark between them."""
    return F.sha2(F.concat_ws(FIELD_MARK, *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256)


def percent_change(current: Column, prior: Column) -> Column:
    return F.when(prior != 0, current.cast("double") / prior.cast("double") - 1)


def money(cents: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(cents / 100, 2))


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def wide(c: Column) -> Column:
    return c.cast(WIDE)
