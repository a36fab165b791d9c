"""Numbers that a plot's axes need; plain Python on a few values."""

from __future__ import annotations

import math


#: The steps that an axis may have.
STEPS = (0.1, 0.2, 0.25, 0.5, 1, 2, 5, 10)


#: Fixed values, in inches: the width of a sample's slot, of the narrowest chart, and a chart's height.
SLOT, NARROWEST, HEIGHT = 0.7, 12, 4


def figure_size(slots: int) -> tuple[float, float]:
    """Width and height of a chart with so many slots side by side."""
    asked = slots * SLOT
    return (asked if asked > NARROWEST else NARROWEST), HEIGHT


def nice_step(raw: float) -> float:
    """The least step that isn't below a raw one; 1 beyond the largest."""
    return next((s for s in STEPS if raw <= s), 1)


def log_ticks(low: float, high: float) -> list[float]:
    """Whole numbers: both ends, the powers of ten between them, and five times each of those where that is between too.

    Without a range above zero just the ends.
    """
    if not 0 < low < high:
        return [low] if low == high else [low, high]
    tens = [10.0**k for k in range(math.floor(math.log10(low)), math.ceil(math.log10(high)) + 1) if low < 10.0**k < high]
    return sorted({int(round(t)) for t in [low, high, *tens, *(5 * t for t in tens if 5 * t < high)]})


def dark(red: float, green: float, blue: float) -> bool:
    """Whether a label on this colour (0 to 1 each) should be white: relative luminance under 0.408."""
    linear = [c / 12.92 if c <= 0.03928 else ((c + 0.055) / 1.055) ** 2.4 for c in (red, green, blue)]
    return 0.2126 * linear[0] + 0.7152 * linear[1] + 0.0722 * linear[2] < 0.408
