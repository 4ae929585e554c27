"""Expressions over the meal catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in a meal name that mark a long or a short preparation,
# the minutes they add, and the estimate for a meal without a name.
SLOW_WORDS = ("soup", "stew", "roast", "casserole")
QUICK_WORDS = ("salad", "sandwich", "pancake")
SLOW_EXTRA, SLOW_CEILING = 60, 120
QUICK_EXTRA, QUICK_FLOOR = -10, 10
PLAIN_EXTRA = 15
BASE_MINUTES, NAME_CYCLE = 20, 20
UNNAMED_MINUTES = 30

# The characters trimmed from the ends of a step (Unicode white
# space and the separators U+001C..U+001F), the step limit and the joiner.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MAX_STEPS = 10
JOINER = "; "


def prep_time(name: Column) -> Column:
    """Estimated minutes from the length of a meal's name and the words in it."""
    lowered = F.lower(name)

    def mentions(words):
        return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])

    base = F.length(name) % NAME_CYCLE + BASE_MINUTES
    # the word checks come first so that the lowered name is computed once
    return (
        F.when(mentions(SLOW_WORDS), F.least(base + SLOW_EXTRA, F.lit(SLOW_CEILING)))
        .when(mentions(QUICK_WORDS), F.greatest(base + QUICK_EXTRA, F.lit(QUICK_FLOOR)))
        .when(name != "", base + PLAIN_EXTRA)
        .otherwise(UNNAMED_MINUTES)
    )


def clean_steps(text: Column, max_steps: int = MAX_STEPS) -> Column:
    """The first non-blank lines of a text, trimmed and joined into one line.

    A carriage return before a line feed is trimmed like any white space.
    """
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)))
    steps = F.slice(F.filter(lines, lambda line: line != ""), 1, max_steps)
    return F.coalesce(F.array_join(steps, JOINER), F.lit(""))


def wide_pairs(names: list[Column], amounts: list[Column]) -> Column:
    """One text from parallel name and amount columns; unnamed pairs are left out.

    A null amount leaves the bare name, an empty amount keeps the colon.
    """
    empty, colon = F.lit(""), F.lit(": ")
    pairs = [
        F.concat(F.nullif(n, empty), F.coalesce(F.concat(colon, a), empty))
        for n, a in zip(names, amounts, strict=True)
    ]
    return F.concat_ws(JOINER, *pairs)


def minutes_text(minutes: Column) -> Column:
    return F.concat(F.coalesce(minutes, F.lit(UNNAMED_MINUTES)).cast("string"), F.lit(" minutes"))
