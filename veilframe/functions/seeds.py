"""Seeded, deterministic choices as column expressions.

Every random-looking choice in the library comes from SHA-256 over a salt and
the value, so results do not depend on partitioning, order or retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Character classes of an identifier: hex letters stay hex so that a UUID
# column still accepts the result, other letters stay outside the hex range.
ID_CLASSES = (DIGITS, "abcdef", "ABCDEF", LOWER[6:], LOWER[6:].upper())
# Character classes of an acronym or phone number: any letter may become any other.
PLAIN_CLASSES = (DIGITS, LOWER, LOWER.upper())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digest(*parts) -> Column:
    """SHA-256 hex digest over parts joined by ``|``."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat_ws("|", *cols), 256)


def seed(*parts) -> Column:
    """52-bit non-negative integer from the leading 13 hex digits of the digest."""
    return F.conv(F.substring(digest(*parts), 1, 13), 16, 10).cast("bigint")


def literal_array(options: Sequence[str]) -> Column:
    """A word list as one folded literal, however long it is."""
    return F.split(F.lit("\u0001".join(options)), "\u0001")


def pick(index: Column, options: Sequence[str]) -> Column:
    """``options[index mod n]`` for a non-negative integer column."""
    return F.element_at(literal_array(options), (F.pmod(index, F.lit(len(options))) + 1).cast("int"))


def _byte(stream: Column, position: Column) -> Column:
    """The ``position``-th byte (0-based) of a hex stream."""
    return F.conv(F.substr(stream, position * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _stream(prefix: Column, count: Column) -> Column:
    """Hex stream holding at least ``count`` bytes: one digest per 32 of them."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(count, F.lit(1)) - 1) / 32).cast("int")),
        lambda b: F.sha2(F.concat_ws("|", prefix, b.cast("string")), 256),
    )
    return F.array_join(blocks, "")


def _moves(classes: Sequence[str], letters: bool) -> Column:
    """Flat table ``byte * (members + 1) + position -> position after the shift``.

    Positions count from 1 over all classes in order, 0 stands for characters
    outside every class. Digits may stay where they are, letters never do.
    """
    flat = []
    for byte in range(256):
        flat.append(0)
        base = 1
        for alphabet in classes:
            size = len(alphabet)
            if alphabet == DIGITS:
                step = byte % size
            else:
                step = byte % (size - 1) + 1 if letters else 0
            flat.extend(base + (at + step) % size for at in range(size))
            base += size
    return F.from_json(F.lit("[" + ",".join(map(str, flat)) + "]"), "array<int>")


def permute_chars(value: Column, salt: str, classes: Sequence[str] = ID_CLASSES) -> Column:
    """Class- and length-preserving bijection on strings.

    A three-round Feistel walk: the characters at even and odd positions are
    the two halves, and each round shifts one half by a stream keyed with the
    salt, the value's class mask and the other half. Every round can be undone,
    so two different inputs of one mask never meet in one output, and no ledger
    or shuffle is needed to keep the mapping injective. Letters take part in
    one round only, with a shift that is never zero, so no letter maps to
    itself. Letter case follows the input.
    """
    members = "".join(classes)
    masks = "".join(a[0] * len(a) for a in classes)
    width = len(members) + 1
    digits_only, all_classes = _moves(classes, False), _moves(classes, True)

    def one_round(number: int, mask: Column, half: Column, other: Column, table: Column) -> Column:
        key = F.concat_ws("|", F.lit(salt), F.lit(str(number)), mask, F.array_join(other.cast("array<string>"), ","))
        return let(
            _stream(key, F.size(half)),
            lambda s: F.transform(half, lambda p, i: F.element_at(table, _byte(s, i) * width + p + 1)),
        )

    def walk(v: Column) -> Column:
        mask, even, odd = v["mask"], v["even"], v["odd"]
        return let(
            one_round(1, mask, even, odd, digits_only),
            lambda even1: let(
                one_round(2, mask, odd, even1, all_classes),
                lambda odd2: F.zip_with(
                    one_round(3, mask, even1, odd2, all_classes), odd2, lambda e, o: F.array(e, o)
                ),
            ),
        )

    def halves(places: Column) -> Column:
        return F.struct(
            F.translate(value, members, masks).alias("mask"),
            F.filter(places, lambda p, i: F.pmod(i, F.lit(2)) == 0).alias("even"),
            F.filter(places, lambda p, i: F.pmod(i, F.lit(2)) == 1).alias("odd"),
        )

    def spell(chars: Column) -> Column:
        places = F.transform(chars, lambda c: F.instr(F.lit(members), c))
        moved = F.flatten(let(let(places, halves), walk))
        return F.array_join(
            F.zip_with(chars, moved, lambda c, p: F.when(p > 0, F.substr(F.lit(members), p, F.lit(1))).otherwise(c)),
            "",
        )

    return F.when(F.length(value) == 0, value).otherwise(let(characters(value), spell))


def characters(value: Column) -> Column:
    """Array of single characters."""
    return F.filter(F.split(value, ""), lambda c: c != "")
