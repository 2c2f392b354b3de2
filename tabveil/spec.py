"""Table description and run settings. All of this is metadata, never rows."""

from __future__ import annotations

import secrets
from dataclasses import dataclass, field

UNKNOWN = "<UNK>"


@dataclass(frozen=True)
class MicrodataSpec:
    """Column roles of a flat table of mixed numeric and categorical columns."""

    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    positive_label: str
    missing_marker: str = "?"
    label_aliases: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        roles = [*self.numeric, *self.categorical, self.target]
        if len(set(roles)) != len(roles):
            raise ValueError("a column has more than one role")
        unknown = set(roles) - set(self.columns)
        if unknown:
            raise ValueError(f"role given to columns that do not exist: {sorted(unknown)}")

    @property
    def vocabulary_columns(self) -> tuple[str, ...]:
        return (*self.categorical, self.target)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)

    @property
    def coded_order(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical, self.target)


@dataclass(frozen=True)
class Marginal:
    """One entry of a workload: an ordered tuple of attributes to be counted together."""

    marginal_id: int
    attrs: tuple[str, ...]
    kind: str = "given"
    score: float | None = None


@dataclass(frozen=True)
class PrivacyBudget:
    budget_id: int
    epsilon: float
    delta: float

    def __post_init__(self) -> None:
        if not self.epsilon > 0:
            raise ValueError("epsilon has to be positive")
        if not 0 < self.delta < 1:
            raise ValueError("delta has to lie strictly between 0 and 1")


def budgets_for(epsilons, delta: float) -> list[PrivacyBudget]:
    return [PrivacyBudget(i, float(e), float(delta)) for i, e in enumerate(epsilons)]


@dataclass(frozen=True)
class SynthesisSettings:
    """Settings of the two synthesis jobs.

    ``seed`` keys every random draw. Whoever knows it can subtract the noise, so the default is a
    fresh secret; fix it only in tests.
    """

    epsilons: tuple[float, ...] = (0.1, 0.5, 1.0, 2.0, 5.0)
    delta: float = 1e-5
    test_share: float = 0.2
    n_bins: int = 8
    top_pairs: int = 25
    top_triples: int = 10
    random_pairs: int = 15
    random_triples: int = 8
    consistency_rounds: int = 8
    repair_passes: int = 6
    max_moves: int | None = None
    n_records: int = 0
    # The model's fit ends when no marginal is further from its target (a share of the records), or after so many rounds.
    fit_bound: float = 0.02
    fit_rounds: int = 500
    step_size: float = 1.0
    # This share of the smallest budget pays for the ranking of columns; 0 leaves it unpaid, as the ledger then says.
    selection_share: float = 0.0
    # A shared folder in which finished rounds and passes are kept, for a run that has to start again with the same seed.
    journal: str | None = None
    seed: str = field(default_factory=lambda: secrets.token_hex(16))

    @property
    def budgets(self) -> list[PrivacyBudget]:
        return budgets_for(self.epsilons, self.delta)

    @classmethod
    def for_model(cls, **changes) -> SynthesisSettings:
        """Workload sizes of the model-based job: fewer marginals, no random ones."""
        sizes = {"top_pairs": 20, "top_triples": 8, "random_pairs": 0, "random_triples": 0}
        return cls(**(sizes | changes))


# The public census extract's column names in file order, their roles and its labels.
CENSUS = MicrodataSpec(
    columns=(
        "age", "workclass", "fnlwgt", "education", "education-num", "marital-status", "occupation",
        "relationship", "race", "sex", "capital-gain", "capital-loss", "hours-per-week",
        "native-country", "income",
    ),
    numeric=("age", "fnlwgt", "education-num", "capital-gain", "capital-loss", "hours-per-week"),
    categorical=(
        "workclass", "education", "marital-status", "occupation", "relationship", "race", "sex",
        "native-country",
    ),
    target="income",
    positive_label=">50K",
    label_aliases=(("<=50K.", "<=50K"), (">50K.", ">50K")),
)
