"""Values worked out once a row, and patterns that look at a letter before they test a word's edge."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPENING = re.compile(r"(?:^|\|)\\b([A-Za-z])")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once a row, however often it stands in the result, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def opened(pattern: str, letters: str = "") -> str:
    r"""A pattern ``\bword...|\bword...`` behind a look at its first letters, which spares most places the test for a word's edge.

    Every alternative has to begin with an edge and a letter, or ``letters`` has to name all letters a match can begin with.
    """
    letters = letters or "".join(sorted(set(_OPENING.findall(pattern))))
    return f"(?=[{letters}])(?:{pattern})"
