"""Money and ratio expressions whose sums do not depend on row order."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: Digits after the point that amounts and rates keep unless a caller says otherwise.
AMOUNT_DIGITS = 2
RATE_DIGITS = 4
#: Key of a whole-number column's digits in its metadata.
SCALE = "scale"


def money(value: Column | str, digits: int = AMOUNT_DIGITS) -> Column:
    """Amount with ``digits`` after the point. Decimals add up exactly, doubles do not; NaN or an
    amount that does not fit is NULL, which ``clean_standardise`` can flag."""
    return _col(value).try_cast(f"decimal({10 + digits},{digits})")


def code(value: Column | str) -> Column:
    """Code in upper case without surrounding space; blank is NULL."""
    return F.nullif(F.upper(F.trim(_col(value))), F.lit(""))


def _number(value: Column | str) -> Column:
    return F.nanvl(_col(value).cast("double"), F.lit(None).cast("double"))


def fits(value: Column | str, digits: int) -> Column:
    """Whether a number needs no more than ``digits`` after the point. k / 10^digits is the double
    nearest to that decimal, so the test is exact for numbers read from decimal text."""
    number, unit = _number(value), F.lit(float(10**digits))
    return F.rint(number * unit) / unit == number


def whole(value: Column | str, digits: int) -> Column:
    """Number of 10^-digits units in a recorded number. NaN, or a number beyond a BIGINT, is NULL.

    A number with more digits rounds as ``money`` does, half away from zero in its shortest
    decimal form; only such a number takes the slower way through a decimal.
    """
    times = F.rint(_number(value) * F.lit(float(10**digits))).try_cast("bigint")
    rounded = _number(value).try_cast(f"decimal(18,{digits})") * F.lit(10**digits)
    return F.when(fits(value, digits), times).otherwise(rounded.try_cast("bigint"))


@dataclass(frozen=True)
class Scaled:
    """Column of whole numbers that counts units of 10^-digits.

    Line amounts are multiplied as integers and become DECIMAL once, at the end: several
    times cheaper per line than decimal products, and just as exact. A product that does
    not fit a BIGINT is an error in ANSI mode, never a wrong number.
    """

    whole: Column
    digits: int

    @classmethod
    def of(cls, df: DataFrame, name: str) -> Scaled:
        """A DECIMAL column, or a whole-number column that ``named`` has made."""
        field = df.schema[name]
        if isinstance(field.dataType, T.DecimalType):
            return cls((F.col(name) * F.lit(10**field.dataType.scale)).cast("bigint"), field.dataType.scale)
        return cls(F.col(name), field.metadata[SCALE])

    def named(self, name: str) -> Column:
        """The whole numbers as a column whose metadata carries the digits through joins and selects."""
        return self.whole.alias(name, metadata={SCALE: self.digits})

    def __mul__(self, other: Scaled) -> Scaled:
        return Scaled(self.whole * other.whole, self.digits + other.digits)

    def __sub__(self, other: Scaled) -> Scaled:
        digits = max(self.digits, other.digits)
        return Scaled(self._at(digits) - other._at(digits), digits)

    def _at(self, digits: int) -> Column:
        return self.whole if digits == self.digits else self.whole * F.lit(10 ** (digits - self.digits)).cast("bigint")

    def complement(self) -> Scaled:
        """One minus the number."""
        return Scaled(F.lit(10**self.digits).cast("bigint") - self.whole, self.digits)

    def where(self, condition: Column) -> Scaled:
        """The number where the condition holds, else zero."""
        return Scaled(F.when(condition, self.whole).otherwise(F.lit(0).cast("bigint")), self.digits)

    def or_zero(self) -> Scaled:
        return Scaled(F.coalesce(self.whole, F.lit(0).cast("bigint")), self.digits)

    def decimal(self) -> Column:
        """As DECIMAL: 18 digits still fit a long in Tungsten rows."""
        unit = F.lit(Decimal(1).scaleb(-self.digits))
        return (self.whole.cast("decimal(18,0)") * unit).cast(f"decimal(18,{self.digits})")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as DOUBLE; NULL for a zero or missing denominator. Exact sums make it exact
    too: one division of the same two numbers gives the same bits everywhere."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def or_zero(df: DataFrame, name: str) -> Column:
    """Zero for a missing amount, without a change of its type."""
    return F.coalesce(name, F.lit(0)).cast(df.schema[name].dataType)


def count_if(condition: Column) -> Column:
    return F.sum(condition.cast("int"))


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, for results that leave the warehouse."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
