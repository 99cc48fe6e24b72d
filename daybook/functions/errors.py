"""Forecast error expressions. Three MAPE definitions coexist and keep separate names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def percentage_error(actual: Column, abs_error: Column) -> Column:
    """Percent of actual; 0 where actual is not positive."""
    return F.when(actual > 0, abs_error / actual * 100).otherwise(F.lit(0.0))


def signed_pct_error(actual: Column, predicted: Column) -> Column:
    """Signed percent of actual; NULL where actual is not positive."""
    return F.when(actual > 0, (actual - predicted) / actual * 100)


def mape_floor_one(actual: Column, predicted: Column) -> Column:
    """Aggregate: model-evaluation MAPE, denominator max(actual, 1)."""
    return F.avg(F.abs((actual - predicted) / F.greatest(actual, F.lit(1.0)))) * 100


def mape_positive_only(actual: Column, predicted: Column) -> Column:
    """Aggregate: dashboard MAPE over actual > 0, and 0 when there is none."""
    return F.coalesce(F.avg(F.when(actual > 0, F.abs(actual - predicted) / actual * 100)), F.lit(0.0))


def mape_zero_filled(actual: Column, predicted: Column) -> Column:
    """Aggregate: batch-report MAPE, rows with actual <= 0 count as 0 percent."""
    return F.avg(percentage_error(actual, absolute_error(actual, predicted)))


def quality_band(mape: Column, excellent: float = 10.0, good: float = 15.0) -> Column:
    return F.when(mape < excellent, "excellent").when(mape < good, "good").otherwise("poor")


def normal_ppf(p: Column) -> Column:
    """Inverse standard normal CDF (Wichura 1988, AS 241, about 16 digits), kept JVM-side."""

    def poly(coefficients: tuple[float, ...], x: Column) -> Column:
        acc = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            acc = acc * x + F.lit(c)
        return acc

    q = p - F.lit(0.5)
    central = F.lit(0.180625) - q * q
    tail = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    inner = q * poly(_AS241_A, central) / poly(_AS241_B, central)
    near = poly(_AS241_C, tail - F.lit(1.6)) / poly(_AS241_D, tail - F.lit(1.6))
    far = poly(_AS241_E, tail - F.lit(5.0)) / poly(_AS241_F, tail - F.lit(5.0))
    outer = F.when(tail <= 5.0, near).otherwise(far) * F.when(q < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(F.abs(q) <= 0.425, inner).otherwise(outer)


# Published AS 241 (PPND16) coefficients, lowest power first.
_AS241_A = (
    3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
    45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727,
)
_AS241_B = (
    1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
    21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610,
)
_AS241_C = (
    1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
    1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640,
)
_AS241_D = (
    1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
    0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 0.00000000105075007164441684324,
)
_AS241_E = (
    6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
    0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 0.000000201033439929228813265,
)
_AS241_F = (
    1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
    0.000786869131145613259100, 0.0000184631831751005468180, 0.000000142151175831644588870, 0.00000000000000204426310338993978564,
)
