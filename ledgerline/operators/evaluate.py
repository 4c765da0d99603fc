"""Precision and recall of fuzzy matching on announcements whose true match is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import linkage
from ledgerline.operators.match import ID, exact_matches, fuzzy_records
from ledgerline.operators.model import LinkageModel
from ledgerline.operators.resolve import share
from ledgerline.session import settle


def hold_out(announcements: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Announcements whose declared company is a candidate, blind, and the truth about them.

    The blind ones lack ``siren_declared``; the truth is ``id`` and ``true_siret_siege``.
    """
    told = exact_matches(announcements, candidates)
    truth = told.select(F.col(ID).alias("id"), F.col("siret_siege").alias("true_siret_siege"))
    blind = announcements.join(truth.select("id"), "id", "left_semi").drop("siren_declared")
    return blind, truth


def predict(
    blind: DataFrame, candidates: DataFrame, model: LinkageModel | None = None
) -> DataFrame:
    """Match records that linkage alone makes for blind announcements; trained on them by default."""
    left = settle(linkage.prepare_announcements(blind))
    right = settle(linkage.prepare_candidates(candidates))
    lefts, rights = settle(linkage.values(left)), settle(linkage.values(right))
    near = settle(linkage.near_addresses(lefts, rights, model or LinkageModel()))
    if model is None:
        model = linkage.fit(left, right, left_values=lefts, right_values=rights, near=near)
    best = linkage.best_matches(lefts, rights, model, near).select(
        F.col("name").alias("denomination_clean"),
        F.col("address").alias("adresse_clean"),
        F.col("uid").alias("uid_r"),
        "match_probability",
    )
    found = left.withColumnRenamed("uid", "uid_l").join(
        best, ["denomination_clean", "adresse_clean"]
    )
    return fuzzy_records(found)


def evaluate_linkage(
    announcements: DataFrame, candidates: DataFrame, model: LinkageModel | None = None
) -> DataFrame:
    """Precision and recall of linkage on the announcements whose match is declared."""
    blind, truth = hold_out(announcements, candidates)
    truth = settle(truth)
    return precision_recall(truth, predict(blind, candidates, model))


def precision_recall(evaluation: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row: total, predicted, correct, precision and recall, 0 where nothing can be divided.

    ``total`` counts the evaluation rows, also where several predictions meet one of them.
    """
    # Predictions are reduced to counts per announcement, so each evaluation row meets one of them.
    guesses = predicted.select(ID, "siret_siege").groupBy(ID, "siret_siege").count()
    truth = evaluation.groupBy(F.col("id").alias(ID), "true_siret_siege").count()
    per_truth = (
        truth.withColumnRenamed("count", "truths")
        .join(guesses.withColumnRenamed("count", "guesses"), ID, "left")
        .groupBy(ID, "true_siret_siege", "truths")
        .agg(
            F.sum(F.when(F.col("siret_siege").isNotNull(), F.col("guesses"))).alias("made"),
            F.sum(
                F.when(F.col("siret_siege") == F.col("true_siret_siege"), F.col("guesses"))
            ).alias("right"),
        )
    )

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    counts = per_truth.agg(
        total(F.col("truths")).alias("total"),
        total(F.col("truths") * F.col("made")).alias("predicted"),
        total(F.col("truths") * F.col("right")).alias("correct"),
    )
    return counts.select(
        "*",
        share(F.col("correct"), F.col("predicted")).alias("precision"),
        share(F.col("correct"), F.col("total")).alias("recall"),
    )
