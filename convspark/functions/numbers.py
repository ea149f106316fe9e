"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int) -> Column:
    """A double with so many decimals (up to 9): its exact binary value, ties to even, as printf and Python format it.

    Spark's own formatting and its casts to decimals round the double's shortest digits, and ties up. The fraction is cut
    into three pieces of 30 bits, which products of whole numbers take times ``10 ** digits`` without a loss; a double with
    bits beyond them is nowhere near a tie. Null stays null.
    """
    scale, bits = 10**digits, 2**30
    size = F.abs(x.cast("double"))
    whole = F.floor(size)
    high = (size - whole) * bits
    low = (high - F.floor(high)) * bits
    top = F.floor(high) * scale
    third = F.floor((low - F.floor(low)) * bits) * scale
    rest = top.bitwiseAND(F.lit(bits - 1).cast("long")) * bits + F.floor(low) * scale + F.shiftright(third, 30)
    q, r = F.shiftright(top, 30) + F.shiftright(rest, 60), rest.bitwiseAND(F.lit(2**60 - 1))
    odd = (q if digits else q + whole) % 2 == 1
    up = (r > 2**59) | ((r == 2**59) & ((third % bits != 0) | odd))
    units = q + up.cast("long")
    text = F.concat(F.when(x < 0, "-").otherwise(""), (whole + F.floor(units / scale)).cast("string"))
    return F.concat(text, F.lit("."), F.lpad((units % scale).cast("string"), digits, "0")) if digits else text
