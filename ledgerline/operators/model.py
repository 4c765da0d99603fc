"""Parameters of the probabilistic linkage, and their estimation from pattern counts.

Published basis: Fellegi and Sunter (1969) for the model, Dempster, Laird and Rubin (1977) for EM. A
pair of records is reduced to one agreement level per compared field; the highest level is equality,
level 0 is "none of the others". Only counts per level reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from math import prod

# Thresholds and defaults of the linkage.
NAME_THRESHOLDS = (0.9, 0.7)
ADDRESS_THRESHOLDS = (1, 2)
EQUALITY_SHARE = 0.95
NEVER_SEEN = 1e-6
RECALL = 0.7
MAX_PAIRS = 1_000_000
SEED = 42
EM_ROUNDS = 25
EM_TOLERANCE = 1e-4


def default_m(levels: int) -> tuple[float, ...]:
    """Level shares among true matches before training: equality dominates, the rest is even."""
    rest = (1.0 - EQUALITY_SHARE) / (levels - 1)
    return (*[rest] * (levels - 1), EQUALITY_SHARE)


def shares(counts: Sequence[float]) -> tuple[float, ...]:
    """Counts as shares; a level that was never seen gets a tiny one."""
    total = sum(counts)
    return tuple(c / total if total and c else NEVER_SEEN for c in counts)


@dataclass(frozen=True)
class LinkageModel:
    """Level shares among matches (``m``) and among random pairs (``u``), lowest level first."""

    prior: float = 1e-4
    threshold: float = 0.5
    name_thresholds: tuple[float, ...] = NAME_THRESHOLDS
    address_thresholds: tuple[int, ...] = ADDRESS_THRESHOLDS
    m_name: tuple[float, ...] = field(default_factory=lambda: default_m(4))
    u_name: tuple[float, ...] = (0.9, 0.0999, 0.00009, 0.00001)
    m_address: tuple[float, ...] = field(default_factory=lambda: default_m(4))
    u_address: tuple[float, ...] = (0.99, 0.004, 0.003, 0.003)

    def __post_init__(self) -> None:
        fields = (
            (self.name_thresholds, self.m_name, self.u_name),
            (self.address_thresholds, self.m_address, self.u_address),
        )
        if any(len(m) != len(t) + 2 or len(u) != len(t) + 2 for t, m, u in fields):
            raise ValueError("one share per level is needed: the thresholds, equality and the rest")

    @property
    def name_levels(self) -> range:
        return range(len(self.m_name))

    @property
    def address_levels(self) -> range:
        return range(len(self.m_address))

    @property
    def same_name(self) -> int:
        return self.name_levels[-1]

    @property
    def same_address(self) -> int:
        return self.address_levels[-1]

    def probability(self, name: int, address: int) -> float:
        """Probability that a pair with these levels is a match."""
        factor = prod(
            m[level] / u[level]
            for m, u, level in (
                (self.m_name, self.u_name, name),
                (self.m_address, self.u_address, address),
            )
        )
        odds = self.prior / (1.0 - self.prior) * factor
        return odds / (1.0 + odds)

    def accepts(self, name: int, address: int) -> bool:
        return self.probability(name, address) >= self.threshold

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> LinkageModel:
        values = json.loads(text)
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def prior_from_rule(rule_pairs: float, all_pairs: float, recall: float = RECALL) -> float:
    """Chance that two random records match, if the rule finds ``recall`` of the matches."""
    if not all_pairs:
        return 0.0
    return min(rule_pairs / recall / all_pairs, 1.0 - 1e-9)


def train_m(
    counts: Sequence[float], u: Sequence[float], prior: float, m: Sequence[float]
) -> tuple[float, ...]:
    """EM for the match shares of one field from its pair counts per level, ``u`` held fixed."""
    total = sum(counts)
    if not total or not 0.0 < prior < 1.0:
        return tuple(m)
    m = tuple(m)
    for _ in range(EM_ROUNDS):
        weight = []
        for mk, uk in zip(m, u, strict=True):
            odds = prior / (1.0 - prior) * mk / uk
            weight.append(odds / (1.0 + odds))
        matched = [c * w for c, w in zip(counts, weight, strict=True)]
        if not sum(matched):
            break
        before, m = (prior, *m), shares(matched)
        prior = min(sum(matched) / total, 1.0 - 1e-9)
        if max(abs(a - b) for a, b in zip(before, (prior, *m), strict=True)) < EM_TOLERANCE:
            break
    return m


def with_training(
    model: LinkageModel,
    prior: float,
    name_counts: Sequence[float],
    address_counts: Sequence[float],
    block_address_counts: Sequence[float],
) -> LinkageModel:
    """Model trained on random pairs (``u``) and on the pairs of the blocking rule (``m``).

    The rule compares names, so the pairs it selects say nothing about how names of matches agree:
    only the address is trained on them, and the name keeps its ``m``.
    """
    u_address = shares(address_counts)
    return replace(
        model,
        prior=prior,
        u_name=shares(name_counts),
        u_address=u_address,
        m_address=train_m(block_address_counts, u_address, prior, model.m_address),
    )
