"""Probabilistic linkage of two sets of names and addresses, without listing all pairs of a block.

The rule that pairs records is "same first four characters of the name", and one block may hold a
third of all rows. What the linkage needs from those pairs is obtained as follows.

* Equal (name, address) values are counted once, whatever their number of rows.
* Pair *counts* per address level come from products of counts per address: equal addresses by an
  equality join, near ones through shared segments, the rest by subtraction.
* The probability of a pair depends only on its two levels, so the levels that reach the threshold
  are known before any pair is formed. Each of them is looked for by the equality it implies: same
  name, or same block and same or near address. Whole blocks meet only for a model that accepts
  unequal names at unrelated addresses.
* A best match at the level "unrelated" is the smallest identifier of its group, an aggregate.
* Where names do have to be compared one by one, a bound from character masks removes most pairs
  inside the join, and groups above a size are cut into tiles on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.similarity import jaro_winkler, may_reach, reaching
from ledgerline.functions.text import folded, segment_keys, segment_probes, with_character_masks
from ledgerline.operators.keys import first_by, lookup
from ledgerline.operators.model import (
    MAX_PAIRS,
    RECALL,
    SEED,
    LinkageModel,
    prior_from_rule,
    with_training,
)
from ledgerline.session import settle

# Fixed value: length of the name prefix that pairs records.
BLOCK_PREFIX = 4
# Scores that land on a threshold count as reaching it, whatever the last bits of the division say:
# they are read as if rounded to nine digits.
HALF_DIGIT = 5e-10
# A group of values to compare is cut into tiles of about this many rows a side, and one task gets
# about as many pairs as some tiles have, or this many rows where groups are small.
TILE_ROWS = 1_000
TILES_A_TASK = 4
ROWS_A_TASK = 250_000
MOST_TASKS = 100_000
# Names that are compared as arrays meet in tiles so many times as long on each side: numbering a tile's names and
# repeating them in other tiles costs more than comparing them, and a task does eight times as many pairs.
ARRAY_SIDE = 4
ARRAY_TILES_A_TASK = 2
# Large groups up to this number are broadcast; each has more than a tile's rows.
FEW_GROUPS = 50_000
# Segments of an address beyond those that are looked up.
SPARE_SEGMENTS = 2
# Right names that every left one is compared with first, and how much more it is from round to round: a name whose
# first partner is the r-th is compared with at most about five times r.
FIRST_ROUND = 256
ROUND_GROWTH = 4
# Tiles that are worth no further rounds.
FEW_TILES = 64
# Parts the sampled pairs are spread over.
SAMPLE_PARTS = 64


def prepare(df: DataFrame, uid: str, name: str, postal: str, city: str) -> DataFrame:
    """Linkage input: identifier, folded name, folded postal code and town."""
    return df.select(
        F.col(uid).alias("uid"),
        folded(F.col(name)).alias("denomination_clean"),
        folded(F.col(postal), F.col(city)).alias("adresse_clean"),
    )


def prepare_announcements(announcements: DataFrame) -> DataFrame:
    return prepare(announcements, "id", "commercant", "code_postal", "ville")


def prepare_candidates(candidates: DataFrame) -> DataFrame:
    return prepare(candidates, "siret", "denomination", "code_postal", "libelle_commune")


def block_of(name: Column) -> Column:
    return F.substring(name, 1, BLOCK_PREFIX)


def values(prepared: DataFrame) -> DataFrame:
    """Distinct (name, address) values with their number of rows and smallest identifier."""
    return (
        prepared.groupBy(
            F.col("denomination_clean").alias("name"), F.col("adresse_clean").alias("address")
        )
        .agg(F.count("*").alias("n"), F.min("uid").alias("uid"))
        .withColumn("block", block_of(F.col("name")))
    )


# --- levels ----------------------------------------------------------------------------------------


def name_level(left: Column, right: Column, similarity: Column, model: LinkageModel) -> Column:
    level = F.when(left == right, model.same_name)
    for step, threshold in enumerate(model.name_thresholds):
        level = level.when(similarity >= threshold - HALF_DIGIT, model.same_name - 1 - step)
    return level.otherwise(0)


def address_level(left: Column, right: Column, model: LinkageModel) -> Column:
    furthest = max(model.address_thresholds)
    distance = F.levenshtein(left, right, furthest)  # -1 beyond the furthest
    level = F.when(left == right, model.same_address)
    for step, threshold in enumerate(model.address_thresholds):
        level = level.when(distance.between(0, threshold), model.same_address - 1 - step)
    return level.otherwise(0)


def probability(name: Column, address: Column, model: LinkageModel) -> Column:
    """Match probability looked up by the pair's two levels."""
    width = len(model.address_levels)
    table = F.array(
        *[F.lit(model.probability(n, a)) for n in model.name_levels for a in model.address_levels]
    )
    return F.get(table, name * width + address)


# --- addresses -------------------------------------------------------------------------------------


def address_candidates(left: DataFrame, right: DataFrame, model: LinkageModel) -> DataFrame:
    """Pairs of a left and a right address that may be near, each once or more.

    An address is cut into more segments than the ``d + 1`` of which ``d`` edits leave one unchanged; any ``d + 1``
    of them will do, so the ones are taken that the fewest right addresses may have. A postal code that all
    share is then not among them.
    """
    depth = max(model.address_thresholds)
    parts = depth + 1 + SPARE_SEGMENTS

    def distinct(side: DataFrame, name: str) -> DataFrame:
        return side.select(F.col("address").alias(name)).distinct()

    probes = segment_probes(F.col("address_r"), depth, parts)
    probed = settle(distinct(right, "address_r").withColumn("segment", F.explode(probes)))
    common = probed.groupBy("segment").agg(F.count("*").alias("rows"))
    cut = distinct(left, "address_l").withColumn(
        "segment", F.explode(segment_keys(F.col("address_l"), depth, parts))
    )
    rarest = Window.partitionBy("address_l").orderBy("rows", "segment")
    counted = cut.join(common, "segment", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    chosen = counted.withColumn("place", F.row_number().over(rarest)).filter(
        (F.col("place") <= depth + 1) & (F.col("rows") > 0)
    )
    return chosen.select("address_l", "segment").join(probed, "segment").drop("segment")


def near_addresses(left: DataFrame, right: DataFrame, model: LinkageModel) -> DataFrame:
    """Pairs of a left and a right address that are equal or near, with their level (above 0).

    Near ones are found by equality of segments and confirmed by their distance. The number of segments does
    not depend on the length of an address.
    """
    pairs = address_candidates(left, right, model)
    level = address_level(F.col("address_l"), F.col("address_r"), model)
    return (
        pairs.select("address_l", "address_r", level.alias("address_level"))
        .filter("address_level > 0")
        .distinct()
    )


def pair_count(left: str, right: str) -> Column:
    """Product of two row counts, wide enough for any two of them."""
    return F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(19,0)")


def block_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on either side and number of pairs of each block, from counts alone."""

    def per_block(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("block").agg(F.sum("n").alias(name))

    sizes = per_block(left, "n_left").join(per_block(right, "n_right"), "block")
    return sizes.withColumn("pairs", pair_count("n_left", "n_right"))


def block_address_counts(
    left: DataFrame, right: DataFrame, near: DataFrame, model: LinkageModel
) -> DataFrame:
    """Pairs of the blocking rule per address level: ``address_level``, ``pairs``."""

    def per_address(side: DataFrame, suffix: str) -> DataFrame:
        return side.groupBy("block", F.col("address").alias(f"address_{suffix}")).agg(
            F.sum("n").alias(f"n_{suffix}")
        )

    met = (
        per_address(left, "l")
        .join(near, "address_l")
        .join(per_address(right, "r"), ["block", "address_r"])
        .groupBy("address_level")
        .agg(F.sum(pair_count("n_l", "n_r")).alias("pairs"))
    )
    everything = block_counts(left, right).agg(F.sum("pairs").alias("pairs"))
    rest = everything.select(F.lit(0).alias("address_level"), "pairs").unionByName(
        met.select(F.lit(0).alias("address_level"), (-F.col("pairs")).alias("pairs"))
    )
    return met.unionByName(rest).groupBy("address_level").agg(F.sum("pairs").alias("pairs"))


# --- training --------------------------------------------------------------------------------------


def random_pair_counts(
    left: DataFrame,
    right: DataFrame,
    n_left: int,
    n_right: int,
    model: LinkageModel,
    max_pairs: int = MAX_PAIRS,
    seed: int = SEED,
) -> DataFrame:
    """Level counts over about ``max_pairs`` random pairs; over all pairs when there are no more.

    Rows are drawn by a seeded hash of their identifier, so a rerun draws the same. The drawn rows of
    the left side fall into parts and meet the right rows of their part, which pairs far more
    different rows than the product of two samples of the same size would.
    """
    wanted = min(max_pairs, n_left * n_right) * SAMPLE_PARTS
    side = int(sqrt(wanted)) + 1
    take_left = min(n_left, side)
    take_right = min(n_right, ceil(wanted / take_left))
    take_left = min(n_left, ceil(wanted / take_right))
    repeats = min(SAMPLE_PARTS, max(1, round(wanted / (take_left * take_right))))

    def ticket(salt: int) -> Column:
        # The first 40 bits of a hash that other engines have as well.
        digest = F.md5(F.concat(F.lit(f"{seed + salt}:"), "uid").cast("binary"))
        return F.conv(F.substring(digest, 1, 10), 16, 10).cast("long")

    def draw(df: DataFrame, take: int, of: int, salt: int) -> DataFrame:
        drawn = df if take >= of else df.filter(ticket(salt) < (1 << 40) * take // of)
        part = F.pmod(ticket(salt + 1), F.lit(SAMPLE_PARTS))
        return drawn.select(
            F.col("denomination_clean").alias("name"),
            F.col("adresse_clean").alias("address"),
            part.alias("part"),
        )

    def weigh(df: DataFrame, suffix: str) -> DataFrame:
        # As many tasks as parts: comparing takes far longer than the few bytes suggest.
        return df.repartition(SAMPLE_PARTS, "part").groupBy(
            "part", F.col("name").alias(f"name_{suffix}"), F.col("address").alias(f"address_{suffix}")
        ).agg(F.count("*").alias(f"n_{suffix}"))

    shifts = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    spread = draw(right, take_right, n_right, 10).withColumn("_shift", shifts)
    spread = spread.withColumn("part", F.pmod(F.col("part") + F.col("_shift"), F.lit(SAMPLE_PARTS)))
    pairs = weigh(draw(left, take_left, n_left, 0), "l").join(weigh(spread, "r"), "part")
    names = [F.col("name_l"), F.col("name_r")]
    return (
        pairs.select(
            name_level(*names, jaro_winkler(*names), model).alias("name_level"),
            address_level(F.col("address_l"), F.col("address_r"), model).alias("address_level"),
            (F.col("n_l") * F.col("n_r")).alias("pairs"),
        )
        .groupBy("name_level", "address_level")
        .agg(F.sum("pairs").alias("pairs"))
    )


def fit(
    left: DataFrame,
    right: DataFrame,
    base: LinkageModel | None = None,
    *,
    max_pairs: int = MAX_PAIRS,
    seed: int = SEED,
    recall: float = RECALL,
    left_values: DataFrame | None = None,
    right_values: DataFrame | None = None,
    near: DataFrame | None = None,
) -> LinkageModel:
    """Train a model on two prepared sides. What reaches the driver is one count per level.

    Values and near addresses that the caller has computed already can be passed in.
    """
    model = base or LinkageModel()
    vl = values(left) if left_values is None else left_values
    vr = values(right) if right_values is None else right_values
    near = near_addresses(vl, vr, model) if near is None else near
    rows = vl.select(F.lit(0).alias("side"), "n").unionByName(vr.select(F.lit(1).alias("side"), "n"))
    size = {r["side"]: r["n"] for r in rows.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    if len(size) < 2:  # one side is empty
        return model
    by_level = {
        row["address_level"]: float(row["pairs"] or 0)
        for row in block_address_counts(vl, vr, near, model).collect()
    }
    in_block = [by_level.get(level, 0.0) for level in model.address_levels]
    names = [0.0 for _ in model.name_levels]
    addresses = [0.0 for _ in model.address_levels]
    for row in random_pair_counts(left, right, size[0], size[1], model, max_pairs, seed).collect():
        names[row["name_level"]] += row["pairs"]
        addresses[row["address_level"]] += row["pairs"]
    prior = prior_from_rule(sum(in_block), float(size[0]) * float(size[1]), recall)
    return with_training(model, prior, names, addresses, in_block)


# --- best match ------------------------------------------------------------------------------------


def _scored(found: DataFrame, name: Column, address: Column, model: LinkageModel) -> DataFrame:
    """Found pairs as (left name, left address, identifier, probability), accepted ones only."""
    scored = found.select(
        "name", "address", "uid", probability(name, address, model).alias("match_probability")
    )
    return scored.filter(F.col("match_probability") >= model.threshold)


def _best(found: DataFrame) -> DataFrame:
    order = [F.col("match_probability").desc(), F.col("uid").asc()]
    return first_by(found, ["name", "address"], order)


def _offered(left: DataFrame, smallest: DataFrame, keys: list[str]) -> DataFrame:
    """Left values with the one identifier offered under their key, which may be a hot one."""
    found = lookup(left, smallest, {k: k for k in keys}, spread_by="address")
    return found.filter("uid IS NOT NULL")


def _with_near(left: DataFrame, near: DataFrame) -> DataFrame:
    """Left values with every right address near theirs."""
    return left.join(near.withColumnRenamed("address_l", "address"), "address")


def _same_name(
    left: DataFrame, right: DataFrame, near: DataFrame, model: LinkageModel
) -> list[DataFrame]:
    """Best pairs of equal names, in parts to be united."""
    level = model.same_name
    accepted = [a for a in model.address_levels if model.accepts(level, a)]
    parts = []
    offered = right.select("name", F.col("address").alias("address_r"), "uid")
    if any(a > 0 for a in accepted):
        wanted = _with_near(left.select("name", "address"), near)
        met = wanted.join(offered.hint("merge"), ["name", "address_r"])
        parts.append(_scored(met, F.lit(level), F.col("address_level"), model))
    if 0 not in accepted:
        return parts
    unrelated = model.probability(level, 0)
    if all(model.probability(level, a) >= unrelated for a in model.address_levels):
        # The smallest identifier of the name: if its address is near, it is found above with at
        # least this probability.
        smallest = right.groupBy("name").agg(F.min("uid").alias("uid"))
        met = _offered(left.select("name", "address"), smallest, ["name"])
    else:
        # Near addresses score lower here, so they must not stand in: among the first d + 1
        # identifiers of the name at least one is not among the d near ones.
        degree = near.groupBy(F.col("address_l").alias("address")).agg(F.count("*").alias("degree"))
        most = degree.agg(F.max("degree")).first()[0] or 0
        place = F.row_number().over(Window.partitionBy("name").orderBy("uid"))
        first = offered.withColumn("place", place).filter(F.col("place") <= most + 1)
        met = (
            left.select("name", "address")
            .join(degree, "address", "left")
            .join(first, "name")
            .filter(F.col("place") <= F.coalesce("degree", F.lit(0)) + 1)
            .filter(address_level(F.col("address"), F.col("address_r"), model) == 0)
        )
    parts.append(_scored(met, F.lit(level), F.lit(0), model))
    return parts


def _compared(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    model: LinkageModel,
    lowest: float | None,
    tile_rows: int,
) -> DataFrame:
    """Pairs of unequal names that agree on ``keys``, with their name level.

    ``lowest`` is the similarity below which a pair is of no interest, None when all are.
    """

    left = with_character_masks(left, "name", "l")
    right = with_character_masks(right, "name_r", "r")
    spread = [c for c in ("name", "address") if c in left.columns]
    left, right, keys = tiles(left, right, keys, spread, ["name_r"], tile_rows)
    pairs = left.join(right, keys).filter(F.col("name") != F.col("name_r"))
    if lowest is not None:
        # Unequal names of one block share its whole prefix: a shorter block is the name itself.
        pairs = pairs.filter(may_reach(lowest - HALF_DIGIT, BLOCK_PREFIX, "l", "r"))
    names = [F.col("name"), F.col("name_r")]
    return pairs.withColumn("name_level", name_level(*names, jaro_winkler(*names), model))


def tiles(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_spread: list[str],
    right_spread: list[str],
    tile_rows: int,
    tiles_a_task: int = TILES_A_TASK,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides, and the columns to join them on, so that no key brings more than a tile together.

    A key with more than ``tile_rows`` rows on a side is cut into parts on that side, and the other
    side is repeated once per part.
    """

    def count(side: DataFrame, suffix: str) -> DataFrame:
        rows = F.count("*")
        return side.groupBy(*keys).agg(
            rows.alias(f"rows_{suffix}"),
            F.ceil(rows / tile_rows).cast("int").alias(f"parts_{suffix}"),
        )

    # The same equality join, on counts instead of rows.
    groups = settle(count(left, "l").join(count(right, "r").hint("merge"), keys))
    is_large = F.expr("parts_l > 1 OR parts_r > 1")
    work = groups.agg(
        F.sum(pair_count("rows_l", "rows_r")).alias("pairs"),
        F.sum(F.col("rows_l") + F.col("rows_r")).alias("rows"),
        F.count_if(is_large).alias("large"),
    ).first()
    # The bytes of the two sides say nothing about the work their pairs make, so the number of tasks
    # follows the number of pairs.
    pairs, rows = int(work["pairs"] or 0), int(work["rows"] or 0)
    tasks = min(MOST_TASKS, 1 + pairs // (tiles_a_task * tile_rows**2) + rows // ROWS_A_TASK)
    if work["large"]:
        large = groups.filter(is_large).select(*keys, "parts_l", "parts_r")

        def cut(side: DataFrame, own: str, other: str, spread: list[str]) -> DataFrame:
            sized = lookup(
                side, large, {k: k for k in keys}, spread_by=spread[0], few=FEW_GROUPS
            ).withColumns({c: F.coalesce(c, F.lit(1)) for c in ("parts_l", "parts_r")})
            mine = F.pmod(F.xxhash64(*spread), F.col(f"parts_{own}")).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1))
            return (
                sized.withColumn(f"part_{own}", mine)
                .withColumn(f"part_{other}", every)
                .drop("parts_l", "parts_r")
            )

        left, right = cut(left, "l", "r", left_spread), cut(right, "r", "l", right_spread)
        keys = [*keys, "part_l", "part_r"]
    return left.repartition(tasks, *keys), right.repartition(tasks, *keys), keys


def _other_name(
    left: DataFrame,
    right: DataFrame,
    near: DataFrame,
    model: LinkageModel,
    tile_rows: int,
    known: DataFrame | None,
) -> list[DataFrame]:
    """Pairs of unequal names, in parts to be united, with the best of every value that has none as good in ``known``."""
    parts = []
    similar = [n for n in model.name_levels if 0 < n < model.same_name]
    address_known = [a for a in model.address_levels if a > 0]
    offered = right.select(
        "block", F.col("name").alias("name_r"), F.col("address").alias("address_r"), "uid"
    )

    # Names unlike each other: the smallest identifier of the group stands for all of them, as long
    # as every better name level scores at least as much and is looked for as well.
    exhaustive = []
    for a in model.address_levels:
        if not model.accepts(0, a):
            continue
        floor = model.probability(0, a)
        better = [model.probability(n, a) for n in model.name_levels]
        if a == 0:
            better = [model.probability(n, b) for n in model.name_levels for b in model.address_levels]
        if min(better) < floor:
            exhaustive.append(a)
            continue
        if a == 0:
            smallest = right.groupBy("block").agg(F.min("uid").alias("uid"))
            met = _offered(left.select("name", "address", "block"), smallest, ["block"])
        else:
            smallest = offered.groupBy("block", "address_r").agg(F.min("uid").alias("uid"))
            wanted = _with_near(left.select("name", "address", "block"), near)
            met = _offered(
                wanted.filter(F.col("address_level") == a), smallest, ["block", "address_r"]
            )
        parts.append(_scored(met, F.lit(0), F.lit(a), model))

    compared = [(n, a) for n in similar for a in model.address_levels if model.accepts(n, a)]
    mine = left.select("name", "address", "block")
    # Levels that no pair of addresses has need not be served, nor be in order.
    present = {0, *(r[0] for r in near.select("address_level").distinct().collect())}
    compared = [(n, a) for n, a in compared if a in present]
    if compared and not exhaustive and all(_names_in_order(model, n, a) for n, a in compared):
        return parts + _nearest_names(
            mine, offered, near, model, compared, present, tile_rows, known
        )
    compared += [(0, a) for a in exhaustive]
    if not compared:
        return parts
    if any(a == 0 for _, a in compared):
        parts.append(_all_names(mine, offered, model, compared, tile_rows))
        return parts
    levels = min(n for n, _ in compared)
    lowest = None if levels == 0 else _name_threshold(model, levels)
    wanted = {a for _, a in compared}
    level_wanted = F.col("address_level").isin([a for a in address_known if a in wanted])
    mine = _with_near(mine, near).filter(level_wanted)
    met = _compared(mine, offered, ["block", "address_r"], model, lowest, tile_rows)
    parts.append(_scored(met, F.col("name_level"), F.col("address_level"), model))
    return parts


def _all_names(
    mine: DataFrame,
    offered: DataFrame,
    model: LinkageModel,
    compared: list[tuple[int, int]],
    tile_rows: int,
) -> DataFrame:
    """Accepted pairs of unequal names at any addresses, by comparing each pair of distinct names of a block once."""
    levels = min(n for n, _ in compared)
    lowest = None if levels == 0 else _name_threshold(model, levels)
    names = mine.select("block", "name").distinct()
    other_names = offered.select("block", "name_r").distinct()
    if lowest is None:
        pairs = _compared(names, other_names, ["block"], model, lowest, tile_rows)
    else:
        pairs = _similar_names(names, other_names, ["block"], lowest - HALF_DIGIT, tile_rows)
        both = [F.col("name"), F.col("name_r")]
        level = name_level(*both, jaro_winkler(*both), model)
        pairs = settle(pairs).withColumn("name_level", level)
    pairs = pairs.filter(F.col("name_level") >= levels).select(
        "block", "name", "name_r", "name_level"
    )
    met = (
        pairs.join(mine, ["block", "name"])
        .join(offered, ["block", "name_r"])
        .withColumn("address_level", address_level(F.col("address"), F.col("address_r"), model))
    )
    return _scored(met, F.col("name_level"), F.col("address_level"), model)


def _name_threshold(model: LinkageModel, level: int) -> float:
    return model.name_thresholds[model.same_name - 1 - level]


def _better_names(model: LinkageModel, name: int, address: int) -> list[float]:
    return [model.probability(n, address) for n in range(name, model.same_name + 1)]


def _names_in_order(model: LinkageModel, name: int, address: int) -> bool:
    """Whether names that are more alike never score less at this address level."""
    return min(_better_names(model, name, address)) >= model.probability(name, address)


def _nearest_names(
    mine: DataFrame,
    offered: DataFrame,
    near: DataFrame,
    model: LinkageModel,
    compared: list[tuple[int, int]],
    present: set[int],
    tile_rows: int,
    known: DataFrame | None,
) -> list[DataFrame]:
    """Best pairs of unequal names where names more alike never score less, in parts to be united.

    Then the smallest identifier whose name reaches a level stands for all of them: if it agrees even better, it
    is found at that level as well, with at least this probability. So a name needs one partner per level
    and group, not the list of all. Only where that partner's address is near, at a level that scores less than an
    unrelated one would, it may not stand in; such values are compared with all names of their block.

    Levels are searched from the most probable on, and a value that has a match (``known`` ones included) is not looked
    for where it could only find a less probable one.
    """
    parts = []
    by_address = [(n, a) for n, a in compared if a > 0]
    anywhere = [(n, a) for n, a in compared if a == 0]
    if by_address:
        wanted = sorted({a for _, a in by_address})
        seekers = _with_near(mine, near).filter(F.col("address_level").isin(wanted))
        keys = ["block", "address_r"]
        # A few pairs are scored as they are; the search for partners is worth its jobs beyond that.
        if _pairs(seekers, offered, keys)[0] <= FEW_TILES * tile_rows**2:
            lowest = _name_threshold(model, min(n for n, _ in by_address))
            met = _compared(seekers, offered, keys, model, lowest, tile_rows)
            scored = _scored(met, F.col("name_level"), F.col("address_level"), model)
            parts.append(settle(_best(scored)))
            by_address = []
    others: dict[bool, DataFrame] = {}
    chances = {pair: model.probability(*pair) for pair in by_address + anywhere}
    for chance in sorted(set(chances.values()), reverse=True):
        matched = [*parts, known] if known is not None else parts
        better = [p.filter(F.col("match_probability") > chance).select("name", "address") for p in matched]
        if better:
            served = reduce(DataFrame.unionByName, better).hint("merge")
            mine = settle(mine.join(served, ["name", "address"], "left_anti"))
        for level, a in [pair for pair, p in chances.items() if p == chance]:
            keys = ["block", "address_r"] if a else ["block"]
            if bool(a) not in others:
                smallest = offered.groupBy(*keys, "name_r").agg(F.min("uid").alias("uid"))
                others[bool(a)] = settle(smallest)
            here = _with_near(mine, near).filter(F.col("address_level") == a) if a else mine
            names = here.select(*keys, "name").distinct()
            hits = first_partners(names, others[bool(a)], keys, model, level, tile_rows)
            met = here.join(hits.hint("merge"), [*keys, "name"])
            worse = [b for b in present if b and min(_better_names(model, level, b)) < chance]
            if worse and not a:
                places = offered.select("uid", "address_r")
                met = lookup(met, places, {"uid": "uid"}, spread_by="name")
                reached = address_level(F.col("address"), F.col("address_r"), model)
                met = settle(met.withColumn("_odd", reached.isin(worse)))
                odd = met.filter("_odd").select("name", "address", "block")
                if not odd.isEmpty():
                    parts.append(settle(_best(_all_names(odd, offered, model, anywhere, tile_rows))))
                met = met.filter("NOT _odd")
            parts.append(settle(_scored(met, F.lit(level), F.lit(a), model)))
    return parts


def _pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Pairs that agree on ``keys``, and the most rows of the left side that do so with any of the right."""

    def per_group(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*keys).agg(F.count("*").alias(name))

    groups = per_group(left, "n_left").join(per_group(right, "n_right"), keys)
    pairs = F.sum(pair_count("n_left", "n_right")).alias("pairs")
    found = groups.agg(pairs, F.max("n_left").alias("most")).first()
    return int(found["pairs"] or 0), found["most"] or 0


def _tiled(
    left: DataFrame, right: DataFrame, keys: list[str], own: list[str], tile_rows: int
) -> DataFrame:
    """Tiles of left (keys, name) and right (keys, *own) as one row each: keys, names, and an array per column of ``own``."""
    side = ARRAY_SIDE * tile_rows
    left, right, tile = tiles(left, right, keys, ["name"], ["name_r"], side, ARRAY_TILES_A_TASK)
    # At most about ``side`` names are collected; both sides lie by tile already.
    lefts = left.groupBy(*tile).agg(F.collect_list("name").alias("names"))
    rights = right.groupBy(*tile).agg(F.sort_array(F.collect_list(F.struct(*own))).alias("others"))
    met = lefts.join(rights.hint("merge"), tile)
    return met.select(*keys, "names", *[F.col(f"others.{c}") for c in own])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the batches, of which only one at a time is turned into Python values."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _reached(row: dict, threshold: float) -> np.ndarray:
    """Pairs of unequal names of a tile that reach the threshold."""
    similar = reaching(row["names"], row["name_r"], threshold)
    place = {name: j for j, name in enumerate(row["name_r"])}
    for i, name in enumerate(row["names"]):
        if name in place:
            similar[i, place[name]] = False
    return similar


def _similar_names(
    left: DataFrame, right: DataFrame, keys: list[str], threshold: float, tile_rows: int
) -> DataFrame:
    """All pairs (keys, name, name_r) of unequal names that agree on ``keys`` and reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            i, j = np.nonzero(_reached(row, threshold))
            columns = [pa.array([row[k]] * len(i), pa.string()) for k in keys]
            columns += [pa.array([row["names"][x] for x in i], pa.string())]
            columns += [pa.array([row["name_r"][x] for x in j], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "name", "name_r"])

    layout = ", ".join(f"{c} string" for c in (*keys, "name", "name_r"))
    return _tiled(left, right, keys, ["name_r"], tile_rows).mapInArrow(compare, layout)


def _tile_partners(
    left: DataFrame, right: DataFrame, keys: list[str], threshold: float, tile_rows: int
) -> DataFrame:
    """The smallest ``uid`` that each left (keys, name) finds among right (keys, name_r, uid) of unequal, similar names."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            similar = _reached(row, threshold)
            hit = np.flatnonzero(similar.any(axis=1))
            first = similar[hit].argmax(axis=1)  # the others are in the order of their uid
            columns = [pa.array([row[k]] * len(hit), pa.string()) for k in keys]
            columns += [pa.array([row["names"][i] for i in hit], pa.string())]
            columns += [pa.array([row["uid"][j] for j in first], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "name", "uid"])

    layout = ", ".join(f"{c} string" for c in (*keys, "name", "uid"))
    met = _tiled(left, right, keys, ["uid", "name_r"], tile_rows)
    return met.mapInArrow(compare, layout).groupBy(*keys, "name").agg(F.min("uid").alias("uid"))


def first_partners(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    model: LinkageModel,
    level: int,
    tile_rows: int,
    first: int = FIRST_ROUND,
) -> DataFrame:
    """For each left (keys, name) the smallest ``uid`` among right (keys, name_r, uid) whose unequal name reaches ``level``.

    Right names are taken in the order of their identifiers, in rounds of growing size, and who has found a
    partner leaves: where many names are alike, all are served within the first round or two. Names meet tile by
    tile, each of which is one row. A round never makes more than MOST_TASKS tasks.
    """
    threshold = _name_threshold(model, level) - HALF_DIGIT
    left, rest, size = settle(left), right, first
    found: list[DataFrame] = []

    while True:
        pairs, seekers = _pairs(left, rest, keys)
        if not pairs:
            break
        if pairs <= FEW_TILES * (ARRAY_SIDE * tile_rows) ** 2:
            found.append(settle(_tile_partners(left, rest, keys, threshold, tile_rows)))
            break
        size = min(size, max(first, MOST_TASKS * tile_rows**2 // seekers))
        # Only the first rows of a group leave each task, so a large group is no task's work.
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("uid"))
        turn = settle(rest.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place"))
        hits = settle(_tile_partners(left, turn, keys, threshold, tile_rows))
        found.append(hits)
        left = settle(left.join(hits.hint("merge"), [*keys, "name"], "left_anti"))
        rest = settle(rest.join(turn.hint("merge"), [*keys, "name_r"], "left_anti"))
        size *= ROUND_GROWTH
    if not found:
        return left.filter(F.lit(False)).withColumn("uid", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, found)


def best_matches(
    left: DataFrame,
    right: DataFrame,
    model: LinkageModel,
    near: DataFrame | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Best accepted match of each left value: ``name``, ``address``, ``uid``, ``match_probability``.

    ``left`` and ``right`` come from ``values``. The result is what scoring every pair of the blocking
    rule, keeping those at or above the threshold and taking the best per value would give; equal
    probabilities go to the smallest identifier. The two steps are one operator, because listing the
    accepted pairs alone would be quadratic in a group of copies.
    """
    near = near_addresses(left, right, model) if near is None else near
    same = _same_name(left, right, near, model)
    others = [
        model.probability(n, a)
        for n in model.name_levels
        for a in model.address_levels
        if n != model.same_name and model.accepts(n, a)
    ]
    if not same and not others:
        return _scored(left.filter(F.lit(False)), F.lit(0), F.lit(0), model)
    settled = settle(_best(reduce(DataFrame.unionByName, same))) if same else None
    if not others:
        return settled
    open_left = left
    if settled is not None:
        # A value whose match by name beats whatever an unequal name could reach is done.
        done = settled.filter(F.col("match_probability") > max(others)).select("name", "address")
        open_left = left.join(done.hint("merge"), ["name", "address"], "left_anti")
    parts = _other_name(open_left, right, near, model, tile_rows, settled)
    if settled is not None:
        parts.append(settled)
    return _best(reduce(DataFrame.unionByName, parts))


def score_pairs(pairs: DataFrame, model: LinkageModel) -> DataFrame:
    """Levels and match probability of given pairs.

    Reads ``name_l``, ``address_l``, ``name_r``, ``address_r``; adds ``name_level``,
    ``address_level`` and ``match_probability``.
    """
    names = [F.col("name_l"), F.col("name_r")]
    return (
        pairs.withColumn("name_level", name_level(*names, jaro_winkler(*names), model))
        .withColumn("address_level", address_level(F.col("address_l"), F.col("address_r"), model))
        .withColumn(
            "match_probability", probability(F.col("name_level"), F.col("address_level"), model)
        )
    )
