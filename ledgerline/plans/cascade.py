"""Matching of announcements to establishments: declared company, then linkage, then unresolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import folded
from ledgerline.operators import linkage
from ledgerline.operators.keys import lookup
from ledgerline.operators.match import head_offices
from ledgerline.operators.model import LinkageModel
from ledgerline.schemas import ANNOUNCEMENT_LINK, EXACT, FUZZY, UNRESOLVED
from ledgerline.session import settle

#: What announcements are matched by.
MATCHED_BY = ["id", "siren_declared", "commercant", "code_postal", "ville"]


def run_cascade(
    announcements: DataFrame,
    candidates: DataFrame,
    model: LinkageModel | None = None,
    max_pairs: int = linkage.MAX_PAIRS,
) -> DataFrame:
    """One match record per announcement.

    Every announcement passes through two lookups, so none is lost or doubled: the head office of its
    declared company, and for the rest the best match of its name and address. Without ``model`` the
    linkage is trained on the announcements that have no exact match.
    """
    offices = head_offices(candidates).withColumnRenamed("siret", "exact_siret")
    declared = lookup(
        announcements.select(MATCHED_BY),
        offices,
        {"siren_declared": "siren"},
        spread_by="id",
    )
    is_open = F.col("exact_siret").isNull()
    # Text of matched announcements is not needed any more; NULL keeps it out of the second lookup.
    declared = settle(
        declared.select(
            "id",
            "siren_declared",
            "exact_siret",
            F.when(is_open, folded(F.col("commercant"))).alias("denomination_clean"),
            F.when(is_open, folded(F.col("code_postal"), F.col("ville"))).alias("adresse_clean"),
        )
    )
    left = declared.filter(is_open).withColumnRenamed("id", "uid")
    right = linkage.prepare_candidates(candidates)
    left_values, right_values = settle(linkage.values(left)), settle(linkage.values(right))
    near = settle(linkage.near_addresses(left_values, right_values, model or LinkageModel()))
    if model is None:
        model = linkage.fit(
            left,
            right,
            max_pairs=max_pairs,
            left_values=left_values,
            right_values=right_values,
            near=near,
        )
    best = linkage.best_matches(left_values, right_values, model, near).withColumnRenamed(
        "uid", "fuzzy_siret"
    )
    resolved = lookup(
        declared, best, {"denomination_clean": "name", "adresse_clean": "address"}, spread_by="id"
    )
    exact = F.col("exact_siret").isNotNull()
    fuzzy = F.col("fuzzy_siret").isNotNull()
    values = [
        F.col("id"),
        F.when(exact, F.col("siren_declared")),
        F.coalesce("exact_siret", "fuzzy_siret"),
        F.when(exact, EXACT).when(fuzzy, FUZZY).otherwise(UNRESOLVED),
        F.when(exact, 1.0).otherwise(F.col("match_probability")),
    ]
    return resolved.select(
        [v.alias(f.name) for v, f in zip(values, ANNOUNCEMENT_LINK.fields, strict=True)]
    )
