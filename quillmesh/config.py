"""Parameters of a pipeline run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineConfig:
    """Defaults of all stages; every one can be overridden."""

    chunk_size: int = 50
    max_context: int = 6144
    max_completion: int = 2048
    chars_per_token: int = 6
    validation_batch: int = 30
    search_limit: int = 5
    lookup_cap: int = 20
    description_cap: int = 512
    merge_similarity: float = 0.85
    cache_similarity: float = 0.9
    accept_score: int = 90
    single_score: int = 70
    single_gap: int = 15
    retries: int = 3

    def __post_init__(self) -> None:
        if self.max_context <= 0 or self.max_completion <= 0:
            raise ValueError("context and completion budgets must be positive")
        if self.max_context <= self.max_completion:
            raise ValueError("the context budget must exceed the completion budget")
