"""Numbers drawn from values: the same for equal values in every engine, version, task and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest that make a draw: as many as a double holds exactly.
_DIGITS = 13


def _digest(values: Sequence[Column | str], seed: int) -> Column:
    """MD5 over the seed and the values as text; a null is told apart from every text."""
    texts = [F.col(v).cast("string") if isinstance(v, str) else v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.lit("|"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(F.lit(str(int(seed))), *parts))


def uniform_draw(values: Sequence[Column | str], seed: int) -> Column:
    """A number from 0 to below 1, spread evenly over different values."""
    head = F.conv(F.substring(_digest(values, seed), 1, _DIGITS), 16, 10)
    return head.cast("double") / F.lit(float(16**_DIGITS))


def fold_of(entity: Column | str, folds: int, seed: int = 45) -> Column:
    """The fold, 0 to ``folds - 1``, of an entity: all its rows are in one. Rows without an entity share one."""
    head = F.conv(F.substring(_digest([entity], seed), 1, 8), 16, 10).cast("bigint")
    return (head % folds).cast("int")
