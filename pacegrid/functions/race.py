"""Race-time formulas as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIEGEL_EXPONENT = 1.06
# Fixed value: seconds per km for each metre of climb per km.
CLIMB_SEC_PER_KM = 2.0
# Oxygen cost of a speed in m/min, as a quadratic.
COST = (-4.60, 0.182258, 0.000104)
# Share of VO2max held for t minutes, 0.8 plus two decays (size, rate).
SHARE_FLOOR = 0.8
SHARE_DECAYS = ((0.1894393, 0.012778), (0.2989558, 0.1932605))
# A finish time is searched for between these minutes.
MIN_MINUTES, MAX_MINUTES = 1.0, 600.0

# Four steps already reach the last digits at every standard distance.
NEWTON_STEPS = 5


def riegel(sec: Column, from_m: Column, to_m: Column, exponent=RIEGEL_EXPONENT) -> Column:
    return sec * F.pow(to_m / from_m, F.lit(exponent) if isinstance(exponent, float) else exponent)


def climb_adjusted(
    sec: Column, from_m: Column, from_climb: Column, to_m: Column, to_climb: Column
) -> Column:
    """Riegel between flat equivalents of the source effort and the target course."""
    flat_sec = sec - CLIMB_SEC_PER_KM * from_climb * from_m / 1000
    return riegel(flat_sec, from_m, to_m) + CLIMB_SEC_PER_KM * to_climb * to_m / 1000


# The VDOT formulas are SQL text: one parsed expression per step instead of one call into
# the JVM per operator, which dominates the cost of building a plan of this shape.


def _cost(speed: str) -> str:
    c0, c1, c2 = COST
    return f"({c0}D + {c1}D * {speed} + {c2}D * {speed} * {speed})"


def _share(minutes: str) -> str:
    decays = [f"{size}D * exp(-{rate}D * ({minutes}))" for size, rate in SHARE_DECAYS]
    return f"({SHARE_FLOOR}D + {' + '.join(decays)})"


def with_vdot(df: DataFrame, distance: str, sec: str, out: str) -> DataFrame:
    """Add the VDOT of running ``distance`` metres in ``sec`` seconds, NULL unless positive."""
    cost, share = _cost(f"({distance} * 60 / {sec})"), _share(f"{sec} / 60")
    return df.selectExpr("*", f"CASE WHEN {sec} > 0 THEN {cost} / {share} END AS `{out}`")


def with_vdot_time(df: DataFrame, level: str, distance: str, out: str) -> DataFrame:
    """Add the seconds in which ``distance`` metres take VDOT ``level``.

    Written in speed, cost(v) - vdot * share(d / v) is close to linear, so a few Newton
    steps settle it to the last digits. Each step refers to the one before by its alias in
    the same select, which Spark plans as projections in generated code; no UDF is needed.
    Speeds are held just outside the searched range, so a root beyond that range shows as an
    out-of-range time: NULL.
    """
    c0, c1, c2 = COST
    slowest = f"({distance} / {MAX_MINUTES * 1.25}D)"
    fastest = f"({distance} / {MIN_MINUTES * 0.8}D)"

    def held(guess: str) -> str:
        # CASE, not least/greatest: those would turn a NULL guess into a bound.
        return (
            f"CASE WHEN {guess} < {slowest} THEN {slowest} "
            f"WHEN {guess} > {fastest} THEN {fastest} ELSE {guess} END"
        )

    room = f"greatest(0D, {c1}D * {c1}D - 4 * {c2}D * ({c0}D - 0.9D * {level}))"
    first = f"CASE WHEN {level} IS NOT NULL THEN (sqrt({room}) - {c1}D) / (2 * {c2}D) END"
    helpers = {"_guess0": first, "_speed0": held("_guess0")}
    for i in range(NEWTON_STEPS):
        speed = f"_speed{i}"
        minutes = f"({distance} / {speed})"
        decays = [f"{size}D * {rate}D * exp(-{rate}D * {minutes})" for size, rate in SHARE_DECAYS]
        slope = (
            f"({c1}D + 2 * {c2}D * {speed} "
            f"- {level} * ({' + '.join(decays)}) * {minutes} / {speed})"
        )
        miss = f"({_cost(speed)} - {level} * {_share(minutes)})"
        helpers[f"_guess{i + 1}"] = f"{speed} - {miss} / {slope}"
        helpers[f"_speed{i + 1}"] = held(f"_guess{i + 1}")
    minutes = f"({distance} / _speed{NEWTON_STEPS})"
    in_range = f"{minutes} BETWEEN {MIN_MINUTES}D AND {MAX_MINUTES}D"
    steps = [f"{expression} AS {name}" for name, expression in helpers.items()]
    solved = df.selectExpr("*", *steps, f"CASE WHEN {in_range} THEN {minutes} * 60 END AS `{out}`")
    return solved.select(*df.columns, out)
