"""Parsing of text cells."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\x0b"


def strip(cell: Column) -> Column:
    return F.btrim(cell, F.lit(_BLANKS))


def text_cell(cell: Column) -> Column:
    """Stripped text; a blank or absent cell is the empty string."""
    return F.coalesce(strip(cell), F.lit(""))


def filled(cell: Column) -> Column:
    """Stripped text; a blank or absent cell is NULL."""
    return F.nullif(strip(cell), F.lit(""))


def long_cell(cell: Column) -> Column:
    """Integer value of a cell: NULL when blank, NULL when it is not an integer."""
    text = filled(cell)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def double_cell(cell: Column) -> Column:
    return filled(cell).try_cast("double")


def is_bad_cell(cell: Column, parsed: Column) -> Column:
    """True when a cell holds text that its declared type cannot represent."""
    return filled(cell).isNotNull() & parsed.isNull()


def int_set(cell: Column) -> Column:
    """Distinct integers of a comma-joined cell, ascending; other tokens are dropped."""
    tokens = F.transform(F.split(F.coalesce(cell, F.lit("")), ","), strip)
    numbers = F.transform(F.filter(tokens, lambda t: t.rlike("^-?[0-9]+$")), lambda t: t.try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.array_compact(numbers)))


#: A set of small numbers is this many words of 64 bits.
_WORD_BITS = 64


def bit_words(ids: Column, size: int = 256) -> list[Column]:
    """A set of integers from 0 to below `size` as 64-bit words; sets are united by bit_or, in buffers of fixed width."""

    def word(k: int) -> Column:
        def add(bits: Column, i: Column) -> Column:
            return F.when(F.shiftright(i, 6) == k, bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i.bitwiseAND(F.lit(63)))))\
                .otherwise(bits)

        return F.coalesce(F.aggregate(ids, F.lit(0).cast("bigint"), add), F.lit(0).cast("bigint"))

    return [word(k) for k in range(size // _WORD_BITS)]


def bit_text(words: list[Column]) -> Column:
    """The integers of a set held as words, ascending and comma-joined. The text of each byte of a word is looked up."""

    def texts(first: int) -> Column:
        # A constant, which is split once per query.
        return F.split(F.lit(";".join("".join(f"{first + bit}," for bit in range(8) if n >> bit & 1) for n in range(256))), ";")

    def text(word: Column, first: int) -> Column:
        parts = [F.get(texts(first + at), F.shiftright(word, at).bitwiseAND(F.lit(255)).cast("int")) for at in range(0, _WORD_BITS, 8)]
        # Most words have no bit at all.
        return F.when(word == 0, "").otherwise(F.concat(*parts))

    return F.rtrim(F.concat(*[text(word, k * _WORD_BITS) for k, word in enumerate(words)]), F.lit(","))


def bits_overlap(words: list[Column], ids: Iterable[int]) -> Column:
    """Whether a set held as words holds any of the ids."""
    masks: dict[int, int] = {}
    for i in ids:
        masks[i // _WORD_BITS] = masks.get(i // _WORD_BITS, 0) | 1 << i % _WORD_BITS
    # The highest bit of a word is its sign.
    signed = {k: m - (1 << _WORD_BITS) if m >> (_WORD_BITS - 1) else m for k, m in masks.items()}
    return reduce(Column.__or__, [words[k].bitwiseAND(F.lit(m).cast("bigint")) != 0 for k, m in signed.items()])


def joined(values: Column) -> Column:
    """Comma-joined verbatim cell; an empty or NULL array is NULL."""
    return F.nullif(F.array_join(values, ","), F.lit(""))


def first_of(values: Column) -> Column:
    """First occurrence of a repeated cell, blank as NULL."""
    return filled(F.get(values, F.lit(0)))


def set_names(flags: list[tuple[Column, str]]) -> Column:
    """Names whose flag holds, in the given order."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for flag, name in flags]))
