"""What the word operators share: fixed word patterns and small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: a word is a run of anything but ASCII white space
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, gap: str = SPACE) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def pairwise(items: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of each item with the next one; one result less than there are items."""
    return let(
        items,
        lambda a: F.zip_with(
            F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
            F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0))),
            join,
        ),
    )


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """Names for working columns that no column of the input has (names ignore case in Spark)."""
    taken, names = {c.lower() for c in columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names
