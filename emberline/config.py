"""Every tunable of the pipeline in one immutable record."""

from dataclasses import dataclass, replace

# --- Fixed values: label names in report order ----------------------------------------
LABELS = ("ALREADY_VIRAL", "HIGH", "MEDIUM", "LOW")


@dataclass(frozen=True)
class Criteria:
    """Lower bounds a post must meet to count as viral (text length is exclusive)."""

    min_score: int
    min_comments: int
    longer_than: int


@dataclass(frozen=True)
class Settings:
    # Defaults that decide results.
    top_n: int = 40
    lookback_hours: int = 24
    widened_hours: int = 48
    tiers: tuple[Criteria, ...] = (Criteria(50, 5, 10), Criteria(10, 1, 5))
    gone_authors: tuple[str, ...] = ("[deleted]", "[removed]")
    engagement_weights: tuple[float, float, float] = (0.5, 0.3, 0.2)
    viral_weights: tuple[float, float, float, float] = (0.4, 0.3, 0.2, 0.1)
    similarity_weights: tuple[float, float, float, float, float] = (0.30, 0.20, 0.25, 0.15, 0.10)
    high: float = 0.70
    medium: float = 0.40
    viral_cutoff: int = 100
    tfidf_dims: int = 100
    listing_limit: int = 50
    title_limit: int | None = 500
    body_limit: int | None = 2000
    remember_days: int = 2
    # A listing writes a missing author as the text "None"; fold it into the deleted marker on demand.
    fold_missing_author: bool = False

    def but(self, **changes) -> "Settings":
        return replace(self, **changes)
