"""Column-level cleansing and scalar projections (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskweave import constants as K

_BLANKS = " \t\r\n\f\v"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Trim every kind of ASCII white space, not only the space character."""
    return F.btrim(_c(col), F.lit(_BLANKS))


# what float parsing takes beyond plain numbers: words, and underscores between digits
_RARE_NUMBER = "(?i)^[-+]?(inf|infinity|nan|[0-9_.]+(e[-+]?[0-9_]+)?)$"


def parse_amount(col: Column | str) -> Column:
    """Text to double: thousands commas dropped, blanks and garbage become NULL.

    Java's parser also takes ``1d``/``1f`` suffixes and hex floats, which are not amounts:
    with a ``d`` of our own appended a second suffix fails, and ``x`` is spoilt.  The
    expression stays small on purpose; filters evaluate it without sharing parts.
    """
    text = F.translate(strip(col), "xX,", "??")
    rare = F.regexp_replace(F.regexp_extract(text, _RARE_NUMBER, 0), "(?<=[0-9])_(?=[0-9])", "")
    return F.coalesce(F.concat(text, F.lit("d")).try_cast("double"), rare.try_cast("double"))


def parse_ts(col: Column | str) -> dict[str, Column]:
    """Columns for the minute-grained source time; unparsable text keeps its row.

    Date and minute fall back to ``''``; the hour is NULL and the status ``fail``.
    """
    ts = F.try_to_timestamp(strip(col), F.lit("yyyy/M/d H:m"))
    return {
        "event_ts": ts,
        "transaction_date": F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("")),
        "transaction_hour": F.hour(ts),
        "transaction_minute": F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit("")),
        "timestamp_parse_status": F.when(ts.isNull(), "fail").otherwise("pass"),
    }


def differs(a: Column | str, b: Column | str) -> Column:
    """1 where two texts differ, else 0."""
    return (_c(a) != _c(b)).cast("int")


def truthy_int(col: Column | str) -> Column:
    """1 only for the texts ``1``, ``true`` and ``True``."""
    return F.coalesce(strip(_c(col).cast("string")).isin("1", "true", "True").cast("int"), F.lit(0))


def log_amount(col: Column | str) -> Column:
    return F.log1p(_c(col).cast("double"))


def hour_angle(col: Column | str) -> Column:
    return F.lit(2.0) * F.pi() * _c(col).cast("double") / F.lit(24.0)


def damped_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / (|den| + 1)`` in double arithmetic."""
    return _c(num).cast("double") / (F.abs(_c(den).cast("double")) + F.lit(1.0))


def rate(num: Column, den: Column, digits: int | None = None) -> Column:
    """``num / den``, 0 where the denominator is 0."""
    value = F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def amount_bin(col: Column | str) -> Column:
    """Left-closed amount band; negatives, infinity and NaN have none."""
    amount = _c(col)
    ladder = None
    for upper, label in K.AMOUNT_BANDS:
        test = amount < F.lit(upper)
        ladder = F.when(test, label) if ladder is None else ladder.when(test, label)
    return F.when(amount >= 0, ladder)


def risk_bucket(score: Column | str) -> Column:
    """CRITICAL / HIGH / MEDIUM / LOW by score; NULL scores count as LOW."""
    score = _c(score)
    ladder = None
    for floor, level in K.RISK_LEVELS:
        ladder = F.when(score >= floor, level) if ladder is None else ladder.when(score >= floor, level)
    return ladder.otherwise(K.RISK_LEVEL_DEFAULT)


SEARCH_TIME_FORMATS = ("yyyy/M/d H:m", "yyyy/M/d H:m:s", "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s")


def normalize_time(col: Column | str, formats: tuple[str, ...] = SEARCH_TIME_FORMATS) -> Column:
    """First matching format, read as UTC and written as ISO-8601 ``...Z``; else the raw text."""
    text = F.coalesce(strip(col), F.lit(""))
    parsed = []
    for fmt in formats:
        if fmt.endswith(".SSSSSS"):
            # a fraction may have one to six digits: pad it before parsing
            padded = F.concat(
                F.substring_index(text, ".", 1), F.lit("."),
                F.rpad(F.substring_index(text, ".", -1), 6, "0"),
            )
            fits = text.rlike(r"\.[0-9]{1,6}$")
            parsed.append(F.when(fits, F.try_to_timestamp(padded, F.lit(fmt))))
        else:
            parsed.append(F.try_to_timestamp(text, F.lit(fmt)))
    ts = F.coalesce(*parsed)
    micros = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.when(micros == "000000", F.concat(seconds, F.lit("Z"))).otherwise(
        F.concat(seconds, F.lit("."), micros, F.lit("Z"))
    )
    return F.coalesce(iso, text)


def salted_row_key(account: Column | str) -> Column:
    """Eight hex digits of the account's CRC-32, ``#``, account."""
    account = _c(account)
    return F.concat(F.lower(F.lpad(F.hex(F.crc32(account)), 8, "0")), F.lit("#"), account)


def doc_id(run_id: Column | str, transaction_id: Column | str) -> Column:
    return F.concat(
        F.coalesce(_c(run_id), F.lit("")), F.lit(":"), F.coalesce(_c(transaction_id), F.lit(""))
    )


def feature_group(name: Column | str) -> Column:
    """Business group of a model feature; the order of the tests matters."""
    name = _c(name)
    crossing = (
        name.isin("is_cross_bank", "is_cross_currency")
        | name.contains("cross_bank")
        | name.contains("cross_currency")
    )
    return (
        F.when(name.startswith("payment_format"), "payment_format")
        .when(name.startswith("payment_currency"), "payment_currency")
        .when(name.isin("amount_paid", "log_amount_paid"), "amount")
        .when(name.isin("transaction_hour", "hour_sin", "hour_cos"), "time")
        .when(crossing, "cross_institution_currency")
        .when(name.endswith("_ratio"), "account_ratio")
        .when(name.startswith("from_"), "account_behavior")
        .otherwise("other")
    )


def tsv_cell(col: Column | str) -> Column:
    """Tabs and line ends become one space (a CR LF pair counts once)."""
    text = F.replace(_c(col).cast("string"), F.lit("\r\n"), F.lit(" "))
    return F.coalesce(F.translate(text, "\t\r\n", "   "), F.lit(""))


def lossless_int(col: Column | str) -> Column:
    """Text such as ``1`` or ``1.0`` to int (truncating)."""
    return strip(_c(col).cast("string")).cast("double").cast("int")


_EXACT_LIMIT = 9.0e18  # whole units below this fit a BIGINT
_LIMB = 20  # bits


def _limb_sums(x: Column) -> Column:
    """Exact DECIMAL(38,6) sum of finite doubles below the limit, to six decimals each.

    Whole units are cut in three limbs of 20 bits (the highest keeps the sign) and summed as
    BIGINT next to the millionths: no sum overflows below 2^43 rows, whatever the amounts.
    """
    whole = x.cast("long")
    mask = F.lit((1 << _LIMB) - 1).cast("long")
    limbs = [
        F.shiftright(whole, 2 * _LIMB),
        F.shiftright(whole, _LIMB).bitwiseAND(mask),
        whole.bitwiseAND(mask),
    ]
    high, middle, low = [F.sum(limb).cast("decimal(20,0)") for limb in limbs]
    micro = F.sum(F.rint((x - whole) * F.lit(1e6)).cast("long")).cast("decimal(20,0)")
    return (
        high * F.lit(1 << 2 * _LIMB).cast("decimal(13,0)") + middle * F.lit(1 << _LIMB).cast("decimal(7,0)")
        + low + micro * F.lit("0.000001").cast("decimal(6,6)")
    ).cast("decimal(38,6)")


def money_sum(col: Column | str) -> Column:
    """Order-independent sum of amounts with up to six decimals, as a double.

    Adding doubles gives last digits that depend on task order, so a retried task could
    change a total.  Integer limbs are summed instead (:func:`_limb_sums`), which is exact for
    totals of any size and stays in generated code.  Single values from 9e18 on have no
    decimals left; they, infinities and NaN take the plain double sum.
    """
    x = _c(col).cast("double")
    plain = F.abs(x) < F.lit(_EXACT_LIMIT)
    exact = _limb_sums(F.when(plain, x)).cast("double")
    rest = F.sum(F.when(~plain, x))
    return F.when(
        exact.isNotNull() | rest.isNotNull(),
        F.coalesce(exact, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)),
    )


def money_sum_decimal(col: Column | str) -> Column:
    """Exact sum of amounts with up to six decimals as DECIMAL(20,2), rounded half-even.

    Null where a decimal cannot hold the total: with an infinite, NaN or 9e18 and larger value
    among the rows, or a total of more than 18 whole digits.
    """
    x = _c(col).cast("double")
    plain = F.abs(x) < F.lit(_EXACT_LIMIT)
    total = F.bround(_limb_sums(F.when(plain, x)), 2).try_cast("decimal(20,2)")
    return F.when(F.count_if(~plain) == 0, total)
