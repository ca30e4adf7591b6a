"""Event-window notation: ``(-5, 5)`` and its column suffix ``m5_p5``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Window = tuple[int, int]

# Fixed values of the study design.
DEFAULT_WINDOWS: tuple[Window, ...] = ((-30, 30), (-5, 5), (-1, 1), (0, 3))
HEADLINE_WINDOW: Window = (-5, 5)
TIMELINE_WINDOW: Window = (-30, 30)
ESTIMATION_WINDOW: Window = (-250, -31)
MIN_ESTIMATION_DAYS = 150
MIN_COVERAGE = 0.90


def window_key(window: Window) -> str:
    """Column-safe name of a window: m for minus, p for plus."""
    return "_".join(("m" if edge < 0 else "p") + str(abs(edge)) for edge in window)


def window_key_column(start: Column, end: Column) -> Column:
    """``window_key`` over columns."""
    def edge(c: Column) -> Column:
        return F.concat(F.when(c < 0, "m").otherwise("p"), F.abs(c).cast("string"))

    return F.concat_ws("_", edge(start), edge(end))


def check_windows(windows: Sequence[Window]) -> list[Window]:
    """Keep the order, drop repeats, refuse windows that do not run forward."""
    kept = list(dict.fromkeys((int(s), int(e)) for s, e in windows))
    for start, end in kept:
        if start >= end:
            raise ValueError(f"window ({start},{end}) must start before it ends")
    return kept


def parse_windows(spec: str | None, headline: Window = HEADLINE_WINDOW) -> list[Window]:
    """``"-30,+30;-5,+5"`` to pairs; the headline window is always part of the result."""
    if not spec:
        pairs: list[Window] = list(DEFAULT_WINDOWS)
    else:
        pairs = []
        for piece in filter(None, (p.strip() for p in spec.split(";"))):
            start, end = piece.split(",")
            pairs.append((int(start), int(end)))
    return check_windows([*pairs, headline])
