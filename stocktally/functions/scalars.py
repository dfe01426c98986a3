"""Column helpers. All return native expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- time -------------------------------------------------------------------
def wall_clock(ts: ColumnLike, target: str, source: str = "UTC") -> Column:
    """Shift a timestamp to the target zone's wall clock, without a zone."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_col(ts).cast("timestamp_ntz"))


def trunc_ntz(unit: str, ts: ColumnLike) -> Column:
    """date_trunc that keeps the zone-less type."""
    return F.date_trunc(unit, as_col(ts)).cast("timestamp_ntz")


def clock_text(ts: ColumnLike) -> Column:
    return F.date_format(as_col(ts), "HH:mm:ss")


def month_number(day: ColumnLike) -> Column:
    return F.year(as_col(day)) * 12 + F.month(as_col(day))


def month_boundaries(start: ColumnLike, end: ColumnLike) -> Column:
    """Calendar-month boundaries crossed, not full months elapsed."""
    return month_number(end) - month_number(start)


def minutes_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Minute boundaries crossed between two timestamps."""
    def minute(c: ColumnLike) -> Column:
        return F.floor(F.unix_seconds(as_col(c).cast("timestamp")) / 60)
    return (minute(end) - minute(start)).cast("bigint")


def week_of_month(day: ColumnLike) -> Column:
    return (F.floor((F.dayofmonth(as_col(day)) - 1) / 7) + 1).cast("int")


def hour_label(hour: ColumnLike) -> Column:
    h = as_col(hour)
    twelve = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    return F.concat(twelve.cast("string"), F.lit(":00 "), F.when(h < 12, "AM").otherwise("PM"))


def within_days(day: ColumnLike, as_of: str, first: int, last: int) -> Column:
    """as_of + first <= day <= as_of + last."""
    anchor = F.lit(as_of).cast("date")
    return as_col(day).cast("date").between(F.date_add(anchor, first), F.date_add(anchor, last))


def since_days(day: ColumnLike, as_of: str, first: int) -> Column:
    """as_of + first <= day."""
    return as_col(day).cast("date") >= F.date_add(F.lit(as_of).cast("date"), first)


# --- numbers ----------------------------------------------------------------
def safe_div(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    return as_col(numerator) / F.nullif(as_col(denominator), F.lit(0))


def pct(part: ColumnLike, whole: ColumnLike, digits: int | None = 2) -> Column:
    value = safe_div(part, whole) * 100
    return value if digits is None else F.round(value, digits)


def pct_delta(current: ColumnLike, previous: ColumnLike) -> Column:
    change = as_col(current) - as_col(previous)
    return F.round(safe_div(change, F.abs(as_col(previous))) * 100, 1)


def uom_convert(
    qty: ColumnLike, unit: ColumnLike, base_unit: ColumnLike, multiply: ColumnLike,
    factor: ColumnLike, *, zero_factor_as_one: bool = False,
) -> Column:
    """Quantity in the part's own unit; unchanged without a conversion row."""
    q, divisor = as_col(qty), as_col(factor)
    guarded = F.when(divisor == 0, 1).otherwise(divisor) if zero_factor_as_one else F.nullif(divisor, F.lit(0))
    differs = (as_col(unit) != as_col(base_unit)) & as_col(multiply).isNotNull()
    return F.when(differs, q * as_col(multiply) / guarded).otherwise(q)


def normal_cdf(z: ColumnLike) -> Column:
    """Standard normal distribution function (rational approximation, error < 1e-7)."""
    x = F.abs(as_col(z))
    t = 1 / (1 + x * 0.2316419)
    # Coefficients of the published approximation.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * F.exp(-x * x / 2) * 0.3989422804014327
    return F.when(as_col(z) >= 0, 1 - tail).otherwise(tail)


# --- text -------------------------------------------------------------------
def json_text(document: ColumnLike, *keys: str) -> Column:
    """Text at a path of keys; NULL for a missing path or a broken document."""
    path = "$" + "".join(f"['{k}']" for k in keys)
    return F.get_json_object(as_col(document), path)


def blank_to_null(text: ColumnLike) -> Column:
    return F.nullif(as_col(text), F.lit(""))


def normalized_email(email: ColumnLike, default: str) -> Column:
    return F.lower(F.coalesce(blank_to_null(email), F.lit(default)))


def ilike_any(text: ColumnLike, words: Iterable[str]) -> Column:
    """Case-insensitive substring test against several words."""
    result = None
    for word in words:
        hit = as_col(text).ilike(f"%{word}%")
        result = hit if result is None else result | hit
    return result


def channel(order_number: ColumnLike, prefix: str, marketplace: str, default: str) -> Column:
    return F.when(as_col(order_number).startswith(prefix), marketplace).otherwise(default)


def in_or_null(column: ColumnLike, values: Sequence) -> Column:
    return as_col(column).isin(list(values)) | as_col(column).isNull()


def id_list(text: ColumnLike, separator: str = ",") -> Column:
    """Array of the whole numbers in a separated list; other tokens become NULL."""
    return F.transform(F.split(as_col(text), separator), lambda tok: F.trim(tok).try_cast("bigint"))


# --- banding ----------------------------------------------------------------
def ladder(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """First matching rule wins."""
    expr = None
    for condition, value in rules:
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    return expr.otherwise(default)


def cdc_order_ts(updated_text: ColumnLike, extracted_ms: ColumnLike) -> Column:
    """Ordering time of a change record: its own update text, else extraction time."""
    return F.coalesce(
        F.try_to_timestamp(as_col(updated_text)),
        F.timestamp_millis(as_col(extracted_ms)),
    )


# State per range of three-digit postcode prefixes.
ZIP3_STATES = (
    (5, 5, "NY"), (10, 27, "MA"), (28, 29, "RI"), (30, 38, "NH"),
    (39, 39, "ME"), (40, 49, "ME"), (50, 54, "VT"), (55, 55, "MA"),
    (56, 59, "VT"), (60, 69, "CT"), (70, 89, "NJ"), (90, 99, "NY"),
    (100, 149, "NY"), (150, 196, "PA"), (197, 199, "DE"),
    (200, 205, "DC"), (206, 219, "MD"), (220, 246, "VA"),
    (247, 268, "WV"), (270, 289, "NC"), (290, 299, "SC"),
    (300, 319, "GA"), (320, 339, "FL"), (340, 349, "FL"),
    (350, 369, "AL"), (370, 385, "TN"), (386, 397, "MS"),
    (398, 399, "GA"), (400, 418, "KY"), (420, 427, "KY"),
    (430, 458, "OH"), (460, 479, "IN"), (480, 499, "MI"),
    (500, 528, "IA"), (530, 549, "WI"), (550, 567, "MN"),
    (570, 577, "SD"), (580, 588, "ND"), (590, 599, "MT"),
    (600, 629, "IL"), (630, 658, "MO"), (660, 679, "KS"),
    (680, 693, "NE"), (700, 714, "LA"), (716, 729, "AR"),
    (730, 749, "OK"), (750, 799, "TX"), (800, 816, "CO"),
    (820, 831, "WY"), (832, 838, "ID"), (840, 847, "UT"),
    (850, 865, "AZ"), (870, 884, "NM"), (889, 898, "NV"),
    (900, 935, "CA"), (936, 966, "CA"), (967, 968, "HI"),
    (970, 979, "OR"), (980, 994, "WA"), (995, 999, "AK"),
)


def zip3_number(postcode: ColumnLike) -> Column:
    """First three digits of a postcode as a number; NULL with fewer digits."""
    digits = F.regexp_replace(as_col(postcode), "[^0-9]", "")
    return F.when(F.length(digits) >= 3, F.substring(digits, 1, 3).try_cast("int"))


def zip_state(postcode: ColumnLike) -> Column:
    """State of a postcode: one lookup in a constant array of the 1000 prefixes."""
    by_prefix = [""] * 1000
    for low, high, state in ZIP3_STATES:
        by_prefix[low:high + 1] = [state] * (high - low + 1)
    states = F.split(F.lit(",".join(by_prefix)), ",")
    return blank_to_null(F.try_element_at(states, zip3_number(postcode) + 1))
