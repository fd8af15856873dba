"""When micro-batches run."""

from __future__ import annotations

from monsoon import schemas as S

POLL_WEATHER = {"processingTime": f"{S.POLL_WEATHER_SECONDS} seconds"}
POLL_NEWS = {"processingTime": f"{S.POLL_NEWS_SECONDS} seconds"}
FLUSH = {"processingTime": f"{S.FLUSH_SECONDS} seconds"}

# Everything that has arrived, then stop.
DRAIN = {"availableNow": True}
