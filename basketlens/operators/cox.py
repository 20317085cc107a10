"""Cox proportional hazards with Efron's handling of ties, fitted by Newton steps over Spark aggregates.

A step needs, at every duration with a death, the sums of w, w x and w x x' over the customers still
at risk, with w = exp(x beta). Customers are summed per duration (partial sums on the map side), a
running sum from the longest duration down gives the risk sets, and one aggregate returns the log
likelihood, its gradient and the information. The running sum has one row per distinct duration in
whole days: bounded by the days of history. The driver holds p + p(p+1)/2 + 1 numbers per step.

Efron's inner sum runs over the deaths tied at one duration. Lapsed one-time buyers all die on day
0, so that sum is cut into pieces of bounded length; the pieces are dealt out by duration and piece
before they are summed, since the running sum itself leaves all its rows in one partition.

A fit that does not converge, or whose likelihood is not finite, is an error that names the
covariates whose coefficients ran away.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from basketlens.functions.special import Z_95, two_sided_p
from basketlens.operators.segmentation import CHAMPIONS
from basketlens.operators.survival import GROUP

COVARIATES = ["log_frequency", "avg_order_value_signed_log", "is_uk"]
TIED_PIECE = 4096
RUNAWAY = 25.0  # a coefficient or error of this size per standard deviation is a separated covariate, no estimate
PIECE_PARTITIONS = 64  # an explicit number: adaptive execution would merge so few bytes into one task again

# The columns of the summary file.
SUMMARY_SCHEMA = (
    "`covariate` string, `coef` double, `exp(coef)` double, `se(coef)` double, `coef lower 95%` double, "
    "`coef upper 95%` double, `exp(coef) lower 95%` double, `exp(coef) upper 95%` double, `cmp to` double, "
    "`z` double, `p` double, `-log2(p)` double"
)
CHECKED_SCHEMA = f"{SUMMARY_SCHEMA}, `converged` boolean, `steps` int"


def dummy_name(label: str) -> str:
    return f"segment_{label}".replace(" ", "_").replace("/", "")


def cox_design(survival: DataFrame, reference: str = CHAMPIONS, levels: Sequence[str] | None = None,
               covariates: Sequence[str] = COVARIATES) -> DataFrame:
    """Duration, event, covariates, and one indicator per segment other than the reference.

    ``levels`` are looked up when not given; the reference must be among them. Each level is a column, so
    the names of the segments, not the customers, come to the driver.
    """
    if levels is None:
        levels = [r[0] for r in survival.select(GROUP).distinct().orderBy(GROUP).collect()]
    if reference not in levels:
        raise ValueError(f"no customer is in the reference segment {reference!r}; segments are {list(levels)}")
    others = sorted(level for level in levels if level != reference)
    return survival.select(
        "duration", "event", *[F.col(c).cast("double").alias(c) for c in covariates],
        *[(F.col(GROUP) == level).cast("double").alias(dummy_name(level)) for level in others],
    )


def covariates_of(design: DataFrame) -> list[str]:
    return [c for c in design.columns if c not in ("duration", "event")]


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def step_sums(design: DataFrame, columns: Sequence[str], beta: Sequence[float]) -> DataFrame:
    """One row: ``log_likelihood``, ``gradient`` (p values), ``information`` (upper triangle by rows), at ``beta``.

    The expressions are SQL text: there are some hundred sums, and text reaches the JVM in one call.
    """
    p = len(columns)
    pairs = _pairs(p)
    # The coefficients enter as one array, which generated code refers to and does not spell out:
    # every step then runs the code compiled for the first one.
    score = (f"aggregate(zip_with(array({', '.join(f'`{c}`' for c in columns)}), "
             f"array({', '.join(f'{float(b)!r}D' for b in beta)}), (x, b) -> x * b), 0D, (z, x) -> z + x)")
    rows = design.selectExpr(
        "duration", "cast(event as double) as e", f"{score} as s",
        *[f"`{c}` as x{i}" for i, c in enumerate(columns)]).selectExpr("*", "exp(s) as w")

    weighted = {"r": "w", **{f"r_{i}": f"w * x{i}" for i in range(p)},
                **{f"r_{i}_{j}": f"w * x{i} * x{j}" for i, j in pairs}}
    dying = {name.replace("r", "t", 1): f"e * {term}" for name, term in weighted.items()}
    plain = {"d": "e", "s": "e * s", **{f"x_{i}": f"e * x{i}" for i in range(p)}}
    per_time = rows.groupBy("duration").agg(
        *[F.expr(f"sum({term})").alias(name) for name, term in {**weighted, **dying, **plain}.items()])

    at_risk = "over (order by duration desc rows between unbounded preceding and current row)"
    deaths = per_time.selectExpr(
        *[f"sum({name}) {at_risk} as {name}" for name in weighted], *dying, *plain).filter("d > 0")

    # Efron: the l-th of d tied deaths sees the risk set less l/d of the dying, phi = r - (l/d) t.
    # Everything a step needs follows from six sums over l that do not depend on the covariates.
    pieces = deaths.selectExpr(
        "*", f"explode(sequence(0L, cast(floor((d - 1) / {TIED_PIECE}) as bigint))) as piece"
    ).repartition(PIECE_PARTITIONS, "duration", "piece")
    ties = pieces.selectExpr("*", f"""
        aggregate(
          sequence(piece * {TIED_PIECE}, least(piece * {TIED_PIECE} + {TIED_PIECE} - 1, cast(d as bigint) - 1)),
          named_struct('ln', 0D, 'a', 0D, 'ac', 0D, 'b', 0D, 'bc', 0D, 'bcc', 0D),
          (z, l) -> named_struct(
            'ln', z.ln + ln(r - l / d * t),
            'a', z.a + 1 / (r - l / d * t),
            'ac', z.ac + l / d / (r - l / d * t),
            'b', z.b + 1 / pow(r - l / d * t, 2),
            'bc', z.bc + l / d / pow(r - l / d * t, 2),
            'bcc', z.bcc + pow(l / d, 2) / pow(r - l / d * t, 2))) as z""")
    once = lambda term: f"(case when piece = 0 then {term} else 0D end)"
    likelihood = f"sum({once('s')} - z.ln)"
    gradient = [f"sum({once(f'x_{i}')} - (r_{i} * z.a - t_{i} * z.ac))" for i in range(p)]
    information = [
        f"sum(r_{i}_{j} * z.a - t_{i}_{j} * z.ac - "
        f"(r_{i} * r_{j} * z.b - (r_{i} * t_{j} + t_{i} * r_{j}) * z.bc + t_{i} * t_{j} * z.bcc))"
        for i, j in pairs
    ]
    return ties.selectExpr(
        f"{likelihood} as log_likelihood", f"array({', '.join(gradient)}) as gradient",
        f"array({', '.join(information)}) as information")


def cox_newton_step(design: DataFrame) -> DataFrame:
    """Log likelihood, gradient and information of the raw covariates at zero."""
    columns = covariates_of(design)
    return step_sums(design, columns, [0.0] * len(columns))


def _unpack(row, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    information = np.zeros((p, p))
    for (i, j), value in zip(_pairs(p), row["information"]):
        information[i, j] = information[j, i] = value
    return row["log_likelihood"], np.array(row["gradient"]), information


def finite(*values) -> bool:
    return all(value is not None and np.isfinite(value).all() for value in values)


def diverged(columns: Sequence[str], beta: np.ndarray, steps: int) -> str:
    worst = [c for c, b in zip(columns, beta) if abs(b) >= max(1.0, np.abs(beta).max() / 2)]
    return (f"the Cox model does not converge: after {steps} steps the coefficients of {worst or list(columns)} still run "
            "away. A covariate that separates the events, or repeats another, has no finite estimate")


def cox_fit(design: DataFrame, tolerance: float = 1e-9, max_steps: int = 50) -> dict:
    """Coefficients and covariance by Newton's method, on covariates standardised for stability.

    Raises ``ArithmeticError`` where the likelihood has no finite maximum, as when a covariate separates
    the events, or where ``max_steps`` do not reach it. Pass a stored design; it is cached while the steps run.
    """
    columns = covariates_of(design)
    stats = design.agg(
        F.sum("event").alias("events"),
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_sd") for c in columns]).first()
    flat = [c for c in columns if not stats[f"{c}_sd"]]
    if flat:
        raise ValueError(f"covariates without variation: {flat}")
    if not stats["events"]:
        raise ValueError("no churn event: nothing to fit")
    scale = np.array([stats[f"{c}_sd"] for c in columns])
    standard = design.select("duration", "event", *[
        ((F.col(c) - F.lit(stats[f"{c}_mean"])) / F.lit(stats[f"{c}_sd"])).alias(c) for c in columns
    ]).persist(StorageLevel.MEMORY_AND_DISK)
    p = len(columns)
    try:
        at = lambda beta: _unpack(step_sums(standard, columns, beta).first(), p)
        beta = np.zeros(p)
        likelihood, gradient, information = at(beta)
        if not finite(likelihood, gradient, information):
            raise ArithmeticError("the likelihood is not finite at zero; a covariate holds NaN or infinity")
        steps = 0
        converged = False
        while steps < max_steps and not converged:
            try:
                move = np.linalg.solve(information, gradient)
            except np.linalg.LinAlgError:
                raise ArithmeticError(diverged(columns, beta, steps)) from None
            after = at(beta + move)
            while not (finite(*after) and after[0] >= likelihood - 1e-9 * abs(likelihood)):
                move = move / 2
                if np.abs(move).max() <= tolerance:
                    raise ArithmeticError(diverged(columns, beta, steps))
                after = at(beta + move)
            beta = beta + move
            likelihood, gradient, information = after
            steps += 1
            converged = np.abs(move).max() < tolerance
    finally:
        standard.unpersist()
    try:
        errors = np.sqrt(np.diag(np.linalg.inv(information)))
    except np.linalg.LinAlgError:
        errors = np.full(p, np.inf)
    # Per standard deviation of a covariate, neither may be this large unless the likelihood is flat out there.
    if not converged or np.abs(beta).max() > RUNAWAY or not (errors < RUNAWAY).all():
        raise ArithmeticError(diverged(columns, beta, steps))
    return {
        "columns": columns,
        "coef": beta / scale,
        "covariance": np.linalg.inv(information) / np.outer(scale, scale),
        "log_likelihood": likelihood,
        "gradient": gradient,
        "steps": steps,
        "converged": converged,
    }


def cox_ph(design: DataFrame, **options) -> DataFrame:
    """The fit as a frame: one row per covariate with coefficient and standard error."""
    fit = cox_fit(design, **options)
    errors = np.sqrt(np.diag(fit["covariance"]))
    rows = [(c, float(b), float(se), float(fit["log_likelihood"]), fit["steps"], bool(fit["converged"]))
            for c, b, se in zip(fit["columns"], fit["coef"], errors)]
    return design.sparkSession.createDataFrame(
        rows, "covariate string, coef double, se double, log_likelihood double, steps int, converged boolean")


def cox_summary(fitted: DataFrame) -> DataFrame:
    """Coefficients, hazard ratios, 95 % bounds and Wald tests, one row per covariate of ``cox_ph``.

    ``converged`` and ``steps`` of the fit follow; a value beyond the doubles is an infinity.
    """
    def exp(x: float) -> float:
        return float(np.exp(np.float64(min(x, 1000.0))))

    def line(covariate: str, coef: float, se: float, converged: bool, steps: int) -> tuple:
        low, high, z = coef - Z_95 * se, coef + Z_95 * se, coef / se if se else math.nan
        p = two_sided_p(z)
        bits = -math.log2(p) if p > 0 else math.inf
        return covariate, coef, exp(coef), se, low, high, exp(low), exp(high), 0.0, z, p, bits, converged, steps
    rows = [line(*r) for r in fitted.select("covariate", "coef", "se", "converged", "steps").collect()]
    return fitted.sparkSession.createDataFrame(rows, CHECKED_SCHEMA)


def cox_hazard_ratios(summary: DataFrame) -> DataFrame:
    """Covariate, hazard ratio and p-value to four places, from the summary or its stored CSV."""
    return summary.select(
        "covariate", F.bround("`exp(coef)`", 4).alias("hazard_ratio"), F.bround("p", 4).alias("p"))
