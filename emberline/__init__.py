"""emberline: find and score viral posts with Spark DataFrames."""

from emberline.config import Settings

__all__ = ["Settings"]
