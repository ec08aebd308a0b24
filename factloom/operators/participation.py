"""Whether a dated performance counts: 21 reasons against it, as one mask of bits, and the outcome they give.

Facts come as columns of the row; a reason is a column expression, so a table is judged in one pass without a
shuffle. Defined cases: null arrays count as empty; without a usable date, rules that need one don't speak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The reasons in the order of their bits; fixed values.
REASONS = (
    "missing_performance_date",
    "unsupported_date_precision",
    "invalid_performance_date",
    "after_effective_cutoff",
    "before_performance_window",
    "after_performance_window",
    "result_ownership_unresolved",
    "result_ownership_conflict",
    "cohort_unresolved",
    "cohort_conflict",
    "cohort_outside_selection",
    "participation_context_unresolved",
    "participation_evidence_conflict",
    "high_school_status_missing",
    "status_not_established_on_performance_date",
    "summer_boundary_unresolved",
    "outside_participation_window",
    "collegiate_participation",
    "middle_school_participation",
    "post_graduation_participation",
    "participation_window_conflict",
)
#: Reasons that exclude; the others leave a case open. Fixed values.
DEFINITE = ("after_effective_cutoff", "before_performance_window", "after_performance_window", "cohort_outside_selection", "outside_participation_window", "collegiate_participation", "middle_school_participation", "post_graduation_participation")


def conditions(first: str, last: str, cutoff: str, years: list[int]) -> dict[str, Column]:
    """Each reason's condition over the columns of a row.

    date (text), ownership and cohort (bound or resolved, missing, conflicting), year, contexts (array of text),
    statuses (array of status, first, last) and windows (array of cohort, first, last), all days as ISO text.
    """
    date = F.try_to_date("date", "yyyy-MM-dd").cast("string")
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    usable = F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$") & date.isNotNull()
    holds = lambda f: (f["first"] <= date) & (date <= f["last"])
    now = F.filter("statuses", holds)
    are = lambda array, kind: F.exists(array, lambda f: f["status"] == kind)
    other = F.exists(now, lambda f: f["status"] != "high_school")
    mine = F.filter("windows", lambda f: f["cohort"].isin(*years) & ((F.col("cohort") != "resolved") | (f["cohort"] == F.col("year"))))
    classes = F.size(F.array_distinct(F.transform("contexts", lambda c: c == "scholastic")))
    found = {
        "missing_performance_date": F.col("date").isNull(),
        "unsupported_date_precision": F.col("date").rlike(r"^\d{4}(-\d{2})?$"),
        "invalid_performance_date": ~F.col("date").rlike(r"^\d{4}(-\d{2})?$") & ~usable,
        "after_effective_cutoff": usable & (date > cutoff),
        "before_performance_window": usable & (date < first),
        "after_performance_window": usable & (date > last),
        "result_ownership_unresolved": F.col("ownership") == "missing",
        "result_ownership_conflict": F.col("ownership") == "conflicting",
        "cohort_unresolved": F.col("cohort") == "missing",
        "cohort_conflict": F.col("cohort") == "conflicting",
        "cohort_outside_selection": (F.col("cohort") == "resolved") & ~F.col("year").isin(*years),
        "participation_context_unresolved": empty("contexts"),
        "participation_evidence_conflict": (classes > 1) | usable & are(now, "high_school") & other,
        "high_school_status_missing": empty("statuses") | ~are("statuses", "high_school"),
        "status_not_established_on_performance_date": usable & are("statuses", "high_school") & ~are(now, "high_school"),
        "summer_boundary_unresolved": usable & empty(mine),
        "outside_participation_window": usable & ~empty(mine) & ~F.exists(mine, holds),
        "collegiate_participation": usable & are(now, "collegiate"),
        "middle_school_participation": usable & are(now, "middle_school"),
        "post_graduation_participation": usable & are(now, "post_graduation"),
        "participation_window_conflict": usable & F.exists(mine, holds) & F.exists(mine, lambda f: ~holds(f)),
    }
    return {name: F.coalesce(found[name], F.lit(False)) for name in REASONS}


def assess(df: DataFrame, first: str, last: str, cutoff: str, years: list[int]) -> DataFrame:
    """df with reasons (the mask), names (the reasons' names, joined) and outcome: eligible, excluded or unresolved."""
    found = conditions(first, last, cutoff, years)
    mask = F.lit(0)
    for bit, name in enumerate(REASONS):
        mask = mask + F.when(found[name], 1 << bit).otherwise(0)
    out = df.withColumn("reasons", mask)
    has = lambda name: F.col("reasons").bitwiseAND(F.lit(1 << REASONS.index(name))) != 0
    definite = F.col("reasons").bitwiseAND(F.lit(sum(1 << REASONS.index(name) for name in DEFINITE))) != 0
    names = F.concat_ws(",", *[F.when(has(name), F.lit(name)) for name in REASONS])
    return out.withColumns({"names": names, "outcome": F.when(F.col("reasons") == 0, "eligible").when(definite, "excluded").otherwise("unresolved")})
