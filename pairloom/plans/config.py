"""Settings of a run."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass
class Config:
    data_dir: str = "dataset"
    out_dir: str = "output"
    work_dir: str = "work"
    seed: int = 42
    #: keys on more targets make no pairs; None keeps every key
    key_df_cap: int | None = 1000
    k_wide: int = 80
    k_max: int = 20
    #: "auto" is the smallest K within k_recall_tolerance of the recall at k_max
    k_final: str | int = "auto"
    k_recall_tolerance: float = 0.002
    #: a candidate this much below the best rerank of its group is dropped; None drops none
    rerank_margin: float | None = None
    use_pruner: bool = True
    prune_tolerance: float = 0.004
    prune_max_threshold: float = 0.5
    pruner_rounds: int = 10
    max_rows: int = 3_000_000
    train_seed_entities: int = 200_000
    train_max_entities: int = 700_000
    n_folds: int = 3
    rounds: int = 20
    depth: int = 5
    step: float = 0.2
    enforce_exclusivity: str = "auto"
    exclusivity_max_violation: float = 0.01

    def as_dict(self) -> dict:
        return asdict(self)
