"""Text expressions: normal forms of names, tokens, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY"


def normalize_text(text: Column, lower: bool = True, strip_accents: bool = True, separator: str | None = "_", first_word: bool = False) -> Column:
    """Lower case, without Latin accents, runs of other characters than letters, digits and ``_`` as one separator and
    none at the ends; or only the first word. Null if no word is left."""
    out = F.lower(text) if lower else text
    if strip_accents:
        out = F.translate(out, _ACCENTED, _PLAIN)
    if first_word:
        out = F.regexp_extract(out, r"(?U)\w+", 0)
    elif separator is not None:
        out = F.regexp_replace(F.regexp_replace(out, r"^(?U)\W+|(?U)\W+$", ""), r"(?U)\W+", separator)
    return F.nullif(out, F.lit(""))


def split_tokens(text: Column) -> Column:
    """Runs of a-z, of digits and of symbols, with one blank between them; other characters are dropped."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z]+|\d+|[^\p{L}\p{M}\p{N}_\s]+)"), F.lit(1)), " ")


def distinct_tokens(text: Column, stop: tuple[str, ...] = ()) -> Column:
    """Blank-separated tokens, each once in order of appearance, without stop tokens."""
    tokens = F.array_distinct(F.split(text, " "))
    return F.array_join(F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens, " ")


def word_tokens(text: Column) -> Column:
    """Lower-case tokens of two word characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\b\w\w+\b"), F.lit(0))


def sku_key(sku: Column, unit: Column) -> Column:
    """Product number padded to 18 digits, a hyphen, and the unit."""
    return F.concat(F.lpad(sku.cast("string"), 18, "0"), F.lit("-"), unit)


def without_leading_zeros(text: Column) -> Column:
    return F.regexp_replace(text, "^0+", "")


def to_number(text: Column) -> Column:
    """A dirty number (decimal comma, blanks) as a double, null where it isn't one."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def flatten(df: DataFrame, separator: str = "_", rename: dict[str, str] | None = None) -> DataFrame:
    """Nested structs as top-level columns, names joined by the separator, then renamed."""

    def leaves(schema: T.StructType, path: list[str]) -> list[list[str]]:
        out = []
        for f in schema.fields:
            out += leaves(f.dataType, [*path, f.name]) if isinstance(f.dataType, T.StructType) else [[*path, f.name]]
        return out

    columns = []
    for path in leaves(df.schema, []):
        name = separator.join(path)
        columns.append(F.col(".".join(f"`{p}`" for p in path)).alias((rename or {}).get(name, name)))
    return df.select(columns)
