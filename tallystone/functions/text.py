"""Name and category expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tallystone.functions.rules import CATEGORY_KEYWORDS, OTHER_CATEGORY


def normalize_vendor(name: Column) -> Column:
    return F.upper(F.trim(name))


def normalize_agency(name: Column) -> Column:
    """Trimmed; case is kept."""
    return F.trim(name)


def vendor_key(name: Column) -> Column:
    """Natural key of a vendor: lower-case hex md5 of its normalised name."""
    return F.md5(normalize_vendor(name))


def is_blank(name: Column) -> Column:
    return name.isNull() | (F.trim(name) == "")


# Between the texts of a packed one, and in front of each that is not NULL.
_END, _THERE = "\x00", "\x01"


def pack(names: Sequence[str]) -> Column:
    """Several text columns as one, which sorts as a struct of them does (NULL first, then by bytes).

    A row with many texts takes a word for each of them, and their padding, in every shuffle.
    """
    # The two signs themselves are spelled with two characters, both above the end of a text.
    texts = [F.replace(F.replace(F.col(x), F.lit(_THERE), F.lit("\x01\x02")), F.lit(_END), F.lit("\x01\x01")) for x in names]
    return F.concat_ws(_END, *[F.coalesce(F.concat(F.lit(_THERE), x), F.lit("")) for x in texts])


def unpack(df: DataFrame, packed: str, names: Sequence[str]) -> DataFrame:
    """The columns that ``pack`` was given, behind the others and instead of the packed one."""
    found = []
    for at, name in enumerate(names):
        spelled = F.get(packed, F.lit(at))
        text = F.substring(spelled, 2, 2**31 - 1)
        plain = F.replace(F.replace(text, F.lit("\x01\x01"), F.lit(_END)), F.lit("\x01\x02"), F.lit(_THERE))
        found.append(F.when(spelled != "", F.when(text.contains(_THERE), plain).otherwise(text)).alias(name))
    # Taken apart first, once for all of them.
    return df.withColumn(packed, F.split(packed, _END)).select(*[name for name in df.columns if name != packed], *found)


def category_group(
    category: Column,
    keywords: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS,
    other: str = OTHER_CATEGORY,
) -> Column:
    """First group one of whose keywords occurs anywhere in the category.

    Plain substrings, so "Furniture" is IT and "Greeting Cards" is Travel. NULL falls to ``other``.
    """
    lowered = F.lower(category)
    group = F
    for name, words in keywords.items():
        group = group.when(reduce(or_, (lowered.contains(word) for word in words)), name)
    return group.otherwise(other)
