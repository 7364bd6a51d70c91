"""Reproducible typing noise for a keyboard layout, as one native column expression.

``k`` characters of the text get an edit: a neighbouring key, a deletion or an
insertion. Edits run right to left on distinct positions, so each one touches only its
own character and the result is the untouched runs joined with the edited characters.

Every draw comes from a hash of (row key, layout tag, seed, character index): one md5
per row and variant gives four 28-bit numbers, and an integer mix modulo a prime does
the rest. Two runs agree under any partitioning.

Where this differs from a literal reading of the original behaviour:

* a frequency layout has upper-case keys, so its letters have neighbours;
* a text that came out unchanged gets one edit that is sure to change it; for a
  one-character text that is an insertion;
* ``_`` stands for space when a neighbour is looked up, and is inserted literally.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.keyboard import Grid, adjacency_map, grid_keys, key_of
from turnloom.functions.text import as_column, let

PRIME = 2147483647
INDEX_RANGE = 4294967296
PIPELINE_KINDS = ("adjacent", "deletion", "insertion")


def edit_count(n: Column, rate: float) -> Column:
    """How many characters of a text of length ``n`` get an edit."""
    wanted = F.greatest(F.lit(1), F.rint(F.lit(rate) * n).cast("int"))
    capped = F.least(wanted, F.floor(n * F.lit(0.75)).cast("int"))
    return F.when(n <= 2, F.lit(1)).otherwise(capped)


def draw_numbers(key: Sequence[Column | str], tag: str, seed: int) -> Column:
    """Four 28-bit numbers from the row key, the variant's tag and the seed."""
    parts = [as_column(k).cast("string") for k in key]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(tag), F.lit(str(seed))))

    def number(i: int) -> Column:
        return F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("long")

    return F.struct(*[number(i).alias(name) for i, name in enumerate("abcd")])


def mix(a: Column, b: Column, c: Column, i: Column) -> Column:
    """A number below ``PRIME`` from three row numbers and a character index.

    A cubic in ``i`` with random coefficients. Lambda bodies are interpreted node by
    node, so the formula uses each operand once; it stays within a BIGINT.
    """
    return ((a + i) * (b + i) % F.lit(PRIME)) * (c + i) % F.lit(PRIME)


def edit_positions(n: Column, k: Column, a: Column, b: Column, c: Column) -> Column:
    """The 0-based positions of the ``k`` smallest mixes, ascending."""
    ranked = F.sort_array(
        F.transform(
            F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
            lambda i: mix(a, b, c, i) * F.lit(INDEX_RANGE) + i,
        )
    )
    return F.sort_array(F.transform(F.slice(ranked, 1, k), lambda v: v % F.lit(INDEX_RANGE)))


class _Keys:
    """The grid's constants and the three ways to draw a key from it."""

    def __init__(self, grid: Grid, preserve_case: bool):
        keys = grid_keys(grid)
        self.around = adjacency_map(grid)
        self.all = F.array(*[F.lit(k) for k in keys])
        self.size = len(keys)
        self.preserve_case = preserve_case

    def cased(self, key: Column, original: Column) -> Column:
        if not self.preserve_case:
            return F.lower(key)
        is_upper = (original == F.upper(original)) & (original != F.lower(original))
        return F.when(is_upper, key).otherwise(F.lower(key))

    def neighbour(self, char: Column, draw: Column, otherwise: Column) -> Column:
        return let(
            F.try_element_at(self.around, key_of(char)),
            lambda keys: F.when(keys.isNull(), otherwise).otherwise(
                self.cased(F.get(keys, (draw % F.size(keys)).cast("int")), char)
            ),
        )

    def inserted(self, char: Column, draw: Column) -> Column:
        return self.cased(F.get(self.all, (draw % F.lit(self.size)).cast("int")), char)


def _edited(char: Column, n: Column, draw: Column, keys: _Keys, kinds: Sequence[str]) -> Column:
    """What stands in the place of one picked character."""
    kind, rest = draw % F.lit(len(kinds)), F.floor(draw / F.lit(len(kinds)))
    result = char
    for i, name in enumerate(kinds):
        if name == "adjacent":
            edit = keys.neighbour(char, rest, char)
        elif name == "deletion":
            edit = F.when(n > 1, F.lit("")).otherwise(char)
        elif name == "insertion":
            edit = F.concat(keys.inserted(char, rest), char)
        else:
            continue
        result = F.when(kind == i, edit).otherwise(result)
    return result


def _apply(chars: Column, n: Column, picks: Column, edit: Callable) -> Column:
    """Untouched runs and edited characters, joined."""
    pieces = F.transform(
        picks,
        lambda p, j: let(
            F.when(j == 0, F.lit(-1).cast("long")).otherwise(F.get(picks, j - 1)),
            lambda before: F.concat(
                F.array_join(
                    F.slice(chars, (before + 2).cast("int"), (p - before - 1).cast("int")), ""
                ),
                edit(p),
            ),
        ),
    )
    tail = F.slice(chars, (F.element_at(picks, -1) + 2).cast("int"), n)
    return F.concat(F.array_join(pieces, ""), F.array_join(tail, ""))


def _apply_with_swaps(
    chars: Column, n: Column, picks: Column, edit: Callable, kind_is_swap: Callable
) -> Column:
    """Like ``_apply`` for callers who ask for transpositions.

    A swap at ``p`` moves the previous character into ``p`` and what stood in ``p`` one
    place to the left, where the next edit to the left finds it. Going right to left,
    ``carried`` is what stands in the current place when it is not its own character.
    """
    start = F.struct(
        F.lit("").alias("done"),
        F.lit(None).cast("string").alias("carried"),
        n.cast("long").alias("below"),
    )

    def run(after: Column, until: Column, carried: Column) -> Column:
        # places after+1 .. until-1, the last of which may hold a carried character
        whole = F.slice(chars, (after + 2).cast("int"), (until - after - 1).cast("int"))
        but_last = F.slice(
            chars, (after + 2).cast("int"), F.greatest(until - after - 2, F.lit(0)).cast("int")
        )
        return F.when(carried.isNull(), F.array_join(whole, "")).otherwise(
            F.concat(F.array_join(but_last, ""), carried)
        )

    def step(state: Column, p: Column) -> Column:
        adjoining = state["below"] == p + 1
        here = F.coalesce(
            F.when(adjoining, state["carried"]), F.get(chars, p.cast("int"))
        )
        between = F.when(adjoining, F.lit("")).otherwise(run(p, state["below"], state["carried"]))
        swaps = kind_is_swap(p) & (p > 0)
        place = F.when(swaps, F.get(chars, (p - 1).cast("int"))).otherwise(edit(p, here))
        return F.struct(
            F.concat(place, between, state["done"]).alias("done"),
            F.when(swaps, here).alias("carried"),
            p.alias("below"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["below"] == 0, state["done"]).otherwise(
            F.concat(run(F.lit(-1).cast("long"), state["below"], state["carried"]), state["done"])
        )

    return F.aggregate(F.reverse(picks), start, step, finish)


def _forced(chars: Column, n: Column, d: Column, keys: _Keys, kinds: Sequence[str]) -> Column:
    """One edit that is sure to change the text."""
    draw = mix(d["c"], d["d"], d["a"], n.cast("long"))
    kind, rest = draw % F.lit(len(kinds)), F.floor(draw / F.lit(len(kinds)))

    def at(p: Column) -> Column:
        char = F.get(chars, p)
        before = F.array_join(F.slice(chars, F.lit(1), p), "")
        after = F.array_join(F.slice(chars, p + 2, n), "")
        insert = F.concat(before, F.get(keys.all, (rest % F.lit(keys.size)).cast("int")), char, after)
        shorter = F.when(n > 1, F.concat(before, after)).otherwise(insert)
        result = insert
        for i, name in enumerate(kinds):
            if name == "adjacent":
                found = F.try_element_at(keys.around, key_of(char))
                edit = F.when(found.isNull(), shorter).otherwise(
                    F.concat(before, F.get(found, (rest % F.size(found)).cast("int")), after)
                )
            elif name == "deletion":
                edit = shorter
            elif name == "transposition":
                following = F.get(chars, p + 1)
                edit = F.when(
                    (p < n - 1) & (following != char),
                    F.concat(
                        before, following, char, F.array_join(F.slice(chars, p + 3, n), "")
                    ),
                ).otherwise(shorter)
            else:
                continue
            result = F.when(kind == i, edit).otherwise(result)
        return result

    return let((F.floor(rest / F.lit(64)) % n).cast("int"), at)


def noisy(
    text: Column | str,
    grid: Grid,
    rate: float,
    key: Sequence[Column | str],
    tag: str,
    seed: int = 0,
    kinds: Sequence[str] = PIPELINE_KINDS,
    preserve_case: bool = False,
) -> Column:
    """``text`` with typing errors of the given layout and rate.

    ``key`` names the columns that identify the row; ``tag`` tells variants of one row
    apart. ``kinds`` may also hold ``"transposition"``. Null and empty text is unchanged.
    """
    text = as_column(text)
    keys = _Keys(grid, preserve_case)

    def variant(n: Column, chars: Column, d: Column) -> Column:
        picks = edit_positions(n, edit_count(n, rate), d["a"], d["b"], d["c"])

        def draw(p: Column) -> Column:
            return mix(d["b"], d["c"], d["d"], p)

        def with_picks(picks: Column) -> Column:
            if "transposition" not in kinds:
                return _apply(
                    chars,
                    n,
                    picks,
                    lambda p: let(
                        draw(p),
                        lambda r: _edited(F.get(chars, p.cast("int")), n, r, keys, kinds),
                    ),
                )
            swap = list(kinds).index("transposition")
            return _apply_with_swaps(
                chars,
                n,
                picks,
                lambda p, here: let(
                    draw(p), lambda r: _edit_in_place(chars, p, here, n, r, keys, kinds)
                ),
                lambda p: draw(p) % F.lit(len(kinds)) == swap,
            )

        edited = let(picks, with_picks)
        return let(
            edited,
            lambda out: F.when(out != text, out).otherwise(_forced(chars, n, d, keys, kinds)),
        )

    result = let(
        F.struct(F.split(text, "").alias("chars"), draw_numbers(key, tag, seed).alias("d")),
        lambda row: let(
            F.size(row["chars"]), lambda n: variant(n, row["chars"], row["d"])
        ),
    )
    return F.when(F.length(text) > 0, result).otherwise(text)


def _edit_in_place(
    chars: Column, p: Column, here: Column, n: Column, draw: Column, keys: _Keys, kinds: Sequence[str]
) -> Column:
    """``_edited`` when ``here`` may be a character that a swap moved to ``p``.

    The neighbour is that of the text's own character at ``p``; without one, what
    stands there stays.
    """
    own = F.get(chars, p.cast("int"))
    kind, rest = draw % F.lit(len(kinds)), F.floor(draw / F.lit(len(kinds)))
    result = here
    for i, name in enumerate(kinds):
        if name == "adjacent":
            edit = keys.neighbour(own, rest, here)
        elif name == "deletion":
            edit = F.when(n > 1, F.lit("")).otherwise(here)
        elif name == "insertion":
            edit = F.concat(keys.inserted(own, rest), here)
        else:
            continue
        result = F.when(kind == i, edit).otherwise(result)
    return result
