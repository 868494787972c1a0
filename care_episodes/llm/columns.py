"""Column helpers shared by the operators: word counts, seeded order, safe handling of extra columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words (null text: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32(doc_id as text) leaves `fold` by `folds`; a null doc_id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def seeded_order(key: Column, seed: int) -> Column:
    """A long in [0, 2**60) that depends on the seed and the key alone (null key: '')."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The whole row as one struct `row`, beside the named columns: no input column can clash with ours."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[v.alias(k) for k, v in named.items()])


def unpacked(df: DataFrame, *added: str) -> DataFrame:
    """The packed row's columns, then the added ones; an added column replaces an input column of its name."""
    taken = {a.lower() for a in added}
    names = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row")[n].alias(n) for n in names], *added)
