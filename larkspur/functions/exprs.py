"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Votes that the common mean counts for when a group's rating is shrunk towards it.
PRIOR_VOTES = 500.0
UNKNOWN_KEY = "-1"

# The three labels that spellings of gender are brought to.
GENDERS = {
    "men": "Nam",
    "man": "Nam",
    "male": "Nam",
    "nam": "Nam",
    "women": "Nữ",
    "woman": "Nữ",
    "female": "Nữ",
    "nu": "Nữ",
    "nữ": "Nữ",
    "women and men": "Unisex",
    "men and women": "Unisex",
    "unisex": "Unisex",
}


def url_key(url: Column) -> Column:
    """Natural key of a URL: trimmed, without fragment and trailing slashes, lower case; null is ''."""
    bare = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    return F.lower(F.regexp_replace(bare, "/+$", ""))


def lookup(column: Column, table: dict[str, object]) -> Column:
    """The literal table's value of a key; null for others."""
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[column]


def gender_label(value: Column) -> Column:
    """One of three labels; unknown spellings stay as they are, blanks become null."""
    key = F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))
    own = F.trim(value)
    return F.coalesce(lookup(key, GENDERS), F.when(own != "", own))


def to_int(value: Column) -> Column:
    """Integer of a whole number's text, else null."""
    return value.try_cast("int")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero on the scaled double, as most SQL engines round."""
    return F.round(value * F.lit(10.0**digits), 0) / F.lit(10.0**digits)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, null where the whole is zero."""
    return part / F.nullif(whole, F.lit(0))


def shrunk(mean: Column, votes: Column, common: Column, prior: float = PRIOR_VOTES) -> Column:
    """A mean drawn to the common one the more, the fewer votes it has; without votes the common one."""
    share = votes / (votes + F.lit(prior))
    return F.when(F.coalesce(votes, F.lit(0)) == 0, common).otherwise(share * mean + (1 - share) * common)


def surrogate_key(natural: Column) -> Column:
    """md5 of the natural key; a null one is the unknown member."""
    return F.coalesce(F.md5(natural.cast("string").cast("binary")), F.lit(UNKNOWN_KEY))


def season(day: Column) -> Column:
    m = F.month(day)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").otherwise("fall")


def sequential_bin(value: Column, low: Column, high: Column, steps: int) -> Column:
    """The step, 0 to steps - 1, nearest to a value's place between low and high, halves to the even one;
    0 for an empty range, null for a null value."""
    share = (value - low).cast("double") / (high - low).cast("double")
    at = F.bround(share * (steps - 1), 0).cast("int")
    near = F.least(F.greatest(at, F.lit(0)), F.lit(steps - 1))
    return F.when(value.isNotNull(), F.when(high > low, near).otherwise(0))


def divergence_bin(z: Column) -> Column:
    """-2 to 2: cuts at a third and at one deviation on either side."""
    return F.when(z <= -1, -2).when(z <= -0.33, -1).when(z < 0.33, 0).when(z < 1, 1).otherwise(2)
