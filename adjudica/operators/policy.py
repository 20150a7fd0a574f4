"""Policies of checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER = ("auto", "review", "informational")


def match_rank(check_id: str, selectors: list[str]) -> int:
    """2 for a selector that is the check itself, 1 for one that names its module, or a check of it, 0 for none; case does not count."""
    module = lambda x: x.partition("_")[0]
    named = {s.strip().upper() for s in selectors} - {""}
    if check_id.upper() in named:
        return 2
    return int(module(check_id.upper()) in map(module, named))


def policy_for(check_id: str, policy: dict[str, list[str]]) -> str:
    """The policy with the best match; ties go to auto, then review; no match is review."""
    ranks = [(match_rank(check_id, policy.get(p, [])), -i) for i, p in enumerate(ORDER)]
    best = max(ranks)
    return ORDER[-best[1]] if best[0] else "review"


def selected(checks: list[str], only: list[str] = (), skip: list[str] = ()) -> list[str]:
    """Checks by module or id, in their own order."""
    return [c for c in checks if (not only or match_rank(c, list(only))) and not match_rank(c, list(skip))]


def policy_column(check_id: Column, checks: list[str], policy: dict[str, list[str]]) -> Column:
    out = F.lit("review")
    for c in checks:
        out = F.when(check_id == c, policy_for(c, policy)).otherwise(out)
    return out


def review_required(policy: Column, status: Column, cannot_determine: bool) -> Column:
    """Whether an issue asks for review: never if it doesn't apply, by a setting if it could not be determined."""
    return F.when(status == "not_applicable", False).when(status == "cannot_determine", cannot_determine).otherwise(policy == "review")
