"""What an 18-digit certificate number says about its holder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last day of the earlier star sign for each month, and the sign id of the earlier sign.
SIGN_CUTOFF = [20, 19, 21, 20, 21, 22, 23, 23, 23, 24, 23, 22]
SIGN_BEFORE = [10, 11, 12, 1, 2, 3, 4, 5, 6, 7, 8, 9]


def is_full(cert: Column) -> Column:
    """17 digits and a digit or X; null is not."""
    return F.coalesce(cert.rlike("^\\d{17}[\\dxX]$"), F.lit(False))


def has_no_star(cert: Column) -> Column:
    """No masked digit; null passes."""
    return F.coalesce(F.instr(cert, "*"), F.lit(0)) == 0


def _number(cert: Column, start: int, length: int) -> Column:
    return F.substring(cert, start, length).try_cast("int")


def age_at(cert: Column, when: Column) -> Column:
    """Nominal age: the year of birth counts as 1, later years as the difference plus one once the birthday is reached.

    Anything but 18 characters with a sane birthday, a birthday later in the same year, or a null time gives 0.
    """
    born = _number(cert, 7, 8)  # yyyyMMdd, read once
    month, day = F.pmod(F.floor(born / 100), F.lit(100)), F.pmod(born, F.lit(100))
    sane = (F.length(cert) == 18) & (born >= 19190000) & month.between(1, 12) & day.between(1, 31)
    years = F.year(when) - F.floor(born / 10000)
    reached = F.month(when) * 100 + F.dayofmonth(when) >= F.pmod(born, F.lit(10000))
    age = F.when(years < 0, 0).otherwise(years + F.when(reached, 1).otherwise(0))
    return F.when(sane & when.isNotNull(), age).otherwise(0).cast("int")


def birthday(cert: Column) -> Column:
    return F.when(F.length(cert) == 18, F.try_to_date(F.substring(cert, 7, 8), "yyyyMMdd"))


def gender(cert: Column) -> Column:
    """1 if digit 17 is odd, 0 if even, null if it is no digit."""
    return F.when(F.length(cert) == 18, F.pmod(_number(cert, 17, 1), F.lit(2)))


def profile_gender(cert: Column) -> Column:
    """Gender code of person profiles: 1 if digit 17 is odd, 2 if even."""
    return F.when(gender(cert) == 1, "1").when(gender(cert) == 0, "2")


def home_code(cert: Column) -> Column:
    return F.concat(F.substring(cert, 1, 4), F.lit("00"))


def decade(cert: Column) -> Column:
    """Decade of birth, ``80后`` for 1980-1989."""
    return F.when(_number(cert, 9, 2).isNotNull(), F.concat(F.substring(cert, 9, 1), F.lit("0后")))


def age_band(age: Column) -> Column:
    return (
        F.when(age < 12, "儿童")
        .when(age < 18, "少年")
        .when(age < 28, "青年")
        .when(age < 45, "壮年")
        .when(age < 60, "中年")
        .when(age >= 60, "老年")
    )


def retired(age: Column) -> Column:
    return F.when(age > 60, "退休").when(age <= 60, "未退休")


def star_sign(month: Column, day: Column) -> Column:
    """Star sign id 1..12 of a birthday."""
    cutoffs = F.array(*[F.lit(d) for d in SIGN_CUTOFF])
    before = F.array(*[F.lit(s) for s in SIGN_BEFORE])
    sign = F.element_at(before, month)
    return F.when(day < F.element_at(cutoffs, month), sign).otherwise(F.pmod(sign, F.lit(12)) + 1)
