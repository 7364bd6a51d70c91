"""Key grids and the neighbours of a key, as plan-time constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.text import as_column

# The two letter orders; ``_`` is the space key.
QWERTY_ORDER = "QWERTYUIOPASDFGHJKLZXCVBNM_"
ABC_ORDER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ_"

# English letter frequencies, space included.
ENGLISH_FREQUENCIES = {
    "e": 0.1202,
    "t": 0.0910,
    "a": 0.0812,
    "o": 0.0768,
    "i": 0.0731,
    "n": 0.0695,
    "s": 0.0628,
    "r": 0.0602,
    "h": 0.0592,
    "d": 0.0432,
    "l": 0.0398,
    "u": 0.0288,
    "c": 0.0271,
    "m": 0.0261,
    "f": 0.0230,
    "y": 0.0211,
    "w": 0.0209,
    "g": 0.0203,
    "p": 0.0182,
    "b": 0.0149,
    "v": 0.0111,
    "k": 0.0069,
    "x": 0.0017,
    "q": 0.0011,
    "j": 0.0010,
    "z": 0.0007,
    " ": 0.1800,
}

Grid = list[list[str]]


def key_grid(
    layout: str | Mapping[str, float] | Sequence[str], rows: int = 3, cols: int = 10
) -> Grid:
    """A grid filled row by row and padded with empty cells.

    ``layout`` is ``"qwerty"``, ``"abc"``, ``"frequency"``, an own key order, or a
    letter → frequency mapping (for instance from ``char_frequency`` over the user's
    own corpus). Keys of a frequency layout are upper-cased, so that its letters have
    neighbours like those of the other layouts.
    """
    if layout == "frequency":
        layout = ENGLISH_FREQUENCIES
    if isinstance(layout, Mapping):
        by_weight = sorted(layout.items(), key=lambda kv: -kv[1])
        keys = ["_" if k == " " else k.upper() for k, _ in by_weight]
    else:
        keys = list({"qwerty": QWERTY_ORDER, "abc": ABC_ORDER}.get(layout, layout)
                    if isinstance(layout, str) else layout)
    if len(keys) > rows * cols:
        raise ValueError(f"{len(keys)} keys do not fit a {rows}x{cols} grid")
    keys += [""] * (rows * cols - len(keys))
    return [keys[r * cols : (r + 1) * cols] for r in range(rows)]


def grid_keys(grid: Grid) -> list[str]:
    return [key for row in grid for key in row if key]


def adjacency(grid: Grid) -> dict[str, list[str]]:
    """Every key with the non-empty cells around it, row by row."""
    around = {}
    for r, row in enumerate(grid):
        for c, key in enumerate(row):
            if key and key not in around:
                around[key] = [
                    grid[i][j]
                    for i in range(max(0, r - 1), min(len(grid), r + 2))
                    for j in range(max(0, c - 1), min(len(row), c + 2))
                    if (i, j) != (r, c) and grid[i][j]
                ]
    return around


def adjacency_map(grid: Grid) -> Column:
    """``adjacency`` as a constant ``MAP<STRING, ARRAY<STRING>>``."""
    pairs = []
    for key, keys in adjacency(grid).items():
        pairs += [F.lit(key), F.array(*[F.lit(k) for k in keys])]
    return F.create_map(*pairs)


def key_of(char: Column) -> Column:
    """The key that types a character: letters upper-cased, space as ``_``."""
    return F.when(char == " ", F.lit("_")).otherwise(F.upper(char))


def neighbours(char: Column | str, grid: Grid) -> Column:
    """Neighbouring keys of a character; an empty array when it is not on the grid."""
    found = F.try_element_at(adjacency_map(grid), key_of(as_column(char)))
    return F.coalesce(found, F.array().cast("array<string>"))
