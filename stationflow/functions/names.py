"""Name matching."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Unicode lists as white space.
WHITESPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def normalise_name(name: Column, blanks_only: bool = False) -> Column:
    """Lower-cased name without surrounding white space.

    Spark's plain ``trim`` strips blanks only, which ``blanks_only`` keeps.
    """
    return F.lower(F.trim(name) if blanks_only else F.trim(name, F.lit(WHITESPACE)))
