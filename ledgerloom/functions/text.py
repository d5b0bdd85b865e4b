"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The characters that Python's str.strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends; ``trim`` removes blanks only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def title_case(c: Column) -> Column:
    """Upper-case each letter that follows a non-letter: ``o'neil`` gives ``O'Neil``, as ``str.title`` does."""
    words = F.split(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})")

    def capitalised_word(w: Column) -> Column:
        # The upper case of one letter may be two, of which the second is written small.
        first = F.upper(w.substr(1, 1))
        return F.concat(first.substr(1, 1), F.lower(first.substr(2, 2)), w.substr(F.lit(2), F.length(w)))

    capitalised = F.transform(words, capitalised_word)
    return F.array_join(capitalised, "")


def replace_exact(c: Column, mapping: dict[str, str]) -> Column:
    """Replace whole values; values that are not in the mapping stay."""
    if not mapping:
        return c
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), c)


def snake_case(name: str) -> str:
    """Column header to column name. A hyphen stays."""
    return name.strip().lower().replace(" ", "_")


def with_snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])
