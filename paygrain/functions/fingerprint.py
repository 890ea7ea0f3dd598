"""The public 64-bit FarmHash fingerprint of short strings, as column expressions.

Samples and splits that were drawn elsewhere by this fingerprint are drawn again here, row by row.
Everything is a 64-bit whole number in two's complement. A product modulo 2^64 is put together from
products of 32 and 16 bits, which no setting for overflows can make fail. Every step is a projection
of its own, so that a figure used twice is computed once and all of it is generated code; texts of all
lengths share their multiplications and no figure can be null, which shortens that code. It still
makes a method of 12 KB, and where ``spark.sql.codegen.hugeMethodLimit`` is set to 8000, the most
that the virtual machine compiles, it takes half the time. The last step is a generator of one row:
Spark would move a filter on the fingerprint below projections, each time putting the whole
expression in place of a name, but not below a generator.

Defined cases: null gives null; the empty string gives the fingerprint of no bytes. Texts of more
than ``LONGEST`` bytes raise: a whole number has 20 characters at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multipliers, shifts and lengths of the published function.
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F
LONGEST = 32

LOW32, LOW16 = (1 << 32) - 1, (1 << 16) - 1


def signed(value: int) -> int:
    """The 64-bit two's complement of a number from 0 to 2^64 - 1."""
    return value - (1 << 64) if value >> 63 else value


def whole(value: int) -> Column:
    return F.lit(signed(value)).cast("bigint")


def _low(value: Column, mask: int = LOW32) -> Column:
    return value.bitwiseAND(whole(mask))


def _right(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, bits)


def _join(high: Column, low: Column) -> Column:
    return F.shiftleft(high, 32).bitwiseOR(_low(low))


def plus(a: Column, b: Column) -> Column:
    """``a + b`` modulo 2^64."""
    low = _low(a) + _low(b)
    return _join(_right(a, 32) + _right(b, 32) + _right(low, 32), low)


def _partial(a: Column, b: Column) -> tuple[Column, Column]:
    """The products of the lower half of ``a`` with the two lowest quarters of ``b``."""
    return _low(a) * _low(b, LOW16), _low(a) * _low(_right(b, 16), LOW16)


def _crossed(a: Column, b: Column) -> Column:
    """What the upper halves add to the upper half of a product, modulo 2^32."""

    def low_product(x: Column, y: Column) -> Column:
        return x * _low(y, LOW16) + F.shiftleft(_low(x * _right(y, 16), LOW16), 16)

    return low_product(_right(a, 32), _low(b)) + low_product(_low(a), _right(b, 32))


def rotated(value: Column, bits: int) -> Column:
    return _right(value, bits).bitwiseOR(F.shiftleft(value, 64 - bits))


def folded(value: Column) -> Column:
    return value.bitwiseXOR(_right(value, 47))


def times_small(small: Column, constant: int) -> Column:
    """``small * constant`` modulo 2^64 for a number of at most 31 bits."""
    low = small * whole(constant & LOW32)
    return _join(_right(low, 32) + small * whole(constant >> 32), low)


def _bytes_at(turned: Column, n: Column, start: Column, count: Column) -> Column:
    """``count`` of ``n`` bytes from byte ``start`` (0-based) as a little-endian number.

    ``turned`` is the hexadecimal text backwards: bytes in the wanted order, their halves exchanged.
    """
    value = F.conv(F.substr(turned, 2 * (n - start - count) + 1, 2 * count), 16, -10).cast("bigint")
    value = F.coalesce(value, whole(0))
    halves = whole(0x0F0F0F0F0F0F0F0F)
    return F.shiftleft(value.bitwiseAND(halves), 4).bitwiseOR(_right(value, 4).bitwiseAND(halves))


def with_fingerprint(rows: DataFrame, text: str | Column, name: str) -> DataFrame:
    """Add the fingerprint of a column's value as a string, a signed 64-bit number."""
    prefix = "step"
    while any(column.lower().startswith(prefix) for column in rows.columns):
        prefix += "_"

    def at(step: str) -> Column:
        return F.col(prefix + step)

    def stepped(table: DataFrame, **steps: Column) -> DataFrame:
        return table.withColumns({prefix + step: value for step, value in steps.items()})

    def multiplied(table: DataFrame, **factors: tuple[Column, Column]) -> DataFrame:
        """Put the product modulo 2^64 of two columns in the place of each name."""
        parts = {}
        for step, (x, y) in factors.items():
            parts[f"p{step}"], parts[f"q{step}"] = _partial(x, y)
        table = stepped(table, **parts)
        low = {f"low{s}": _low(at(f"p{s}")) + F.shiftleft(_low(at(f"q{s}"), LOW16), 16) for s in factors}
        high = {
            f"high{s}": _right(at(f"p{s}"), 32) + _right(at(f"q{s}"), 16) + _crossed(x, y) for s, (x, y) in factors.items()
        }
        table = stepped(table, **low, **high)
        return stepped(table, **{s: _join(at(f"high{s}") + _right(at(f"low{s}"), 32), at(f"low{s}")) for s in factors})

    def choose(longest: Column, middle: Column, shorter: Column) -> Column:
        """By the number of bytes: 17 to 32, 8 to 16, or fewer."""
        return F.when(n >= 17, longest).when(n >= 8, middle).otherwise(shorter)

    a, b, c, d, u, v, n, mul, turned, length = map(at, ["a", "b", "c", "d", "u", "v", "n", "mul", "turned", "length"])
    column = (F.col(text) if isinstance(text, str) else text).cast("string")
    given = F.coalesce(column, F.lit(""))
    table = stepped(rows, turned=F.reverse(F.hex(given.cast("binary"))), n=F.octet_length(given), length=F.octet_length(column))
    count = F.when(n >= 8, 8).when(n >= 4, 4).otherwise(1)
    table = stepped(
        table,
        mul=whole(K2) + 2 * n.cast("bigint"),
        a=_bytes_at(turned, n, F.lit(0), count),
        b=_bytes_at(turned, n, F.when(n >= 17, 8).otherwise(F.shiftright(n, 1)), count),
        c=_bytes_at(turned, n, n - count, count),
        d=_bytes_at(turned, n, n - 16, F.lit(8)),
    )
    # What is multiplied first: u by v, and c by mul; b stays what is added later.
    table = stepped(
        table,
        u=F.when(n >= 17, a).otherwise(rotated(c, 37)),
        v=F.when(n >= 17, whole(K1)).otherwise(mul),
        a=F.when((n >= 8) & (n < 17), plus(a, whole(K2))).otherwise(a),
    )
    table = stepped(table, c=F.when((n >= 8) & (n < 17), plus(rotated(a, 25), c)).otherwise(c), e=c)
    table = multiplied(table, u=(u, v), c=(c, mul), d=(d, whole(K2)))
    # From here on u and v are the two numbers that are mixed into one.
    table = stepped(
        table,
        u=choose(plus(rotated(plus(u, b), 43), rotated(c, 30)), plus(u, a), n.cast("bigint") + F.shiftleft(a, 3)),
        v=choose(plus(rotated(plus(b, whole(K2)), 18), u), c, at("e")),
    )
    table = stepped(table, u=F.when(n >= 17, plus(u, d)).otherwise(u), v=F.when(n >= 17, plus(v, c)).otherwise(v))
    table = multiplied(stepped(table, u=u.bitwiseXOR(v)), u=(u, mul))
    table = multiplied(stepped(table, u=folded(u).bitwiseXOR(v)), u=(u, mul))
    few = times_small(a + F.shiftleft(b, 8), K2).bitwiseXOR(times_small(n.cast("bigint") + F.shiftleft(at("e"), 2), K0))
    table = stepped(table, u=F.when(n <= 3, few).otherwise(u), mul=F.when(n <= 3, whole(K2)).otherwise(mul))
    table = multiplied(stepped(table, u=folded(u)), u=(u, mul))
    too_long = F.raise_error(F.lit(f"a fingerprint takes texts of at most {LONGEST} bytes")).cast("bigint")
    value = F.when(length == 0, whole(K2)).when(length <= LONGEST, u).when(length.isNotNull(), too_long)
    kept = [F.col(f"`{column}`") for column in rows.columns if column.lower() != name.lower()]
    return table.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))
