"""Settings shared by the corpus jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ColumnMap:
    """Physical column behind each logical one; None gives a null column."""

    text: str = "complete_text"
    file_id: str | None = "file_id"
    title: str | None = "title"
    author: str | None = "author"
    date: str | None = "date"


@dataclass(frozen=True)
class CorpusConfig:
    """Thresholds of a corpus build. The defaults of the job we match."""

    target_chars: int = 500_000_000
    val_ratio: float = 0.01
    min_chars: int = 2000
    min_alpha_ratio: float = 0.55
    max_weird_ratio: float = 0.08
    min_score: float = 1.25
    columns: ColumnMap = field(default_factory=ColumnMap)

    @classmethod
    def production(cls, **overrides) -> "CorpusConfig":
        """The stricter settings used for a full-size corpus. Fixed values."""
        values = dict(
            target_chars=5_000_000_000,
            val_ratio=0.01,
            min_chars=2500,
            min_alpha_ratio=0.58,
            max_weird_ratio=0.06,
            min_score=1.5,
        )
        values.update(overrides)
        return cls(**values)
