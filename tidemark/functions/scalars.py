"""Column builders: symbols, spans, dates, flags. All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive day ranges of a period's type; without a start it is an instant.
SPANS = (("monthly", 25, 35), ("quarterly", 70, 100), ("semiannual", 150, 200), ("annual", 330, 400))


def stripped_upper(symbol: Column) -> Column:
    return F.upper(F.regexp_replace(symbol, r"^\s+|\s+$", ""))


def canonical_symbol(symbol: Column) -> Column:
    """Upper case, dots and spaces as dashes, no runs of dashes."""
    return F.regexp_replace(F.regexp_replace(stripped_upper(symbol), "[. ]", "-"), "-{2,}", "-")


def symbol_variants(symbol: Column) -> Column:
    """Spellings to try, in order: as given, with dash, dot, space; distinct and not empty."""
    dash = canonical_symbol(symbol)
    tries = F.array(stripped_upper(symbol), dash, F.regexp_replace(dash, "-", "."), F.regexp_replace(dash, "-", " "))
    return F.array_distinct(F.filter(tries, lambda v: v != ""))


def iso_date(text: Column) -> Column:
    """A full ISO date or null; Spark's own cast is laxer than the archive's contract."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def classify_span(start: Column, end: Column) -> Column:
    days = F.datediff(end, start)
    out = F.when(start.isNull(), F.lit("instant"))
    for name, low, high in SPANS:
        out = out.when(days.between(low, high), F.lit(name))
    return out.otherwise(F.lit("other"))


def interval_start(start: Column, end: Column) -> Column:
    return F.coalesce(start, end)


def overlap_days(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Days that two inclusive periods share."""
    return F.greatest(F.lit(0), F.datediff(F.least(end_a, end_b), F.greatest(start_a, start_b)) + 1)


def padded_cik(cik: Column) -> Column:
    return F.format_string("CIK%010d", cik)


def iso_week(day: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def item_events(items: Column, names: dict[str, str]) -> Column:
    """A comma-separated code list as distinct event names, sorted and joined; null if no code has a name."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    named = F.transform(F.split(items, ","), lambda c: F.try_element_at(table, F.trim(c)))
    found = F.array_sort(F.array_distinct(F.filter(named, lambda n: n.isNotNull())))
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def corrected_ratio(ratio: Column, before: Column, after: Column) -> Column:
    """A split ratio turned round where the share count clearly moved the other way; unchanged where it cannot be told."""
    observed = F.try_divide(after, before)  # the guard below does not hold for subexpressions that are computed once, ahead of it
    turned = F.abs(F.ln(observed * ratio)) < F.abs(F.ln(F.try_divide(observed, ratio))) - F.ln(F.lit(2.0))
    return F.when((before > 0) & (after > 0) & turned, F.try_divide(F.lit(1.0), ratio)).otherwise(ratio)
