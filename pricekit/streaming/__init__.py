"""Incremental loading by high-water mark (the source has no stream of its own)."""

from pricekit.streaming.incremental import (
    high_water_mark,
    since_watermark,
    stamp_max,
    watermark_literal,
)

__all__ = ["high_water_mark", "since_watermark", "stamp_max", "watermark_literal"]
