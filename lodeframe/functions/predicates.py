"""Predicates that many readers share. Parameters are folded on the driver, so they reach the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def live(c: Column) -> Column:
    return c.isNull()


def visible_to(owner: Column, user, read_all: bool) -> Column:
    return F.lit(True) if read_all else owner == F.lit(user)


def optional_equal(filters: dict[str, object]) -> Column:
    """A conjunction of the filters that have a value."""
    given = [F.col(k) == F.lit(v) for k, v in filters.items() if v not in (None, "")]
    return reduce(lambda a, b: a & b, given, F.lit(True))


def in_status(status: Column, wanted: str | None = None, hidden: str = "deleted") -> Column:
    """The wanted status; where none is wanted, any but the hidden one."""
    return status == wanted if wanted else status != hidden


def keyword(c: Column, kw: str) -> Column:
    """Case-insensitive match; % and _ of the keyword are wildcards."""
    return c.ilike(f"%{kw}%") if kw else F.lit(True)


def has_tags(tags: Column, wanted: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(t) for t in wanted]), tags)) == 0 if wanted else F.lit(True)


def has_metadata(meta: Column, wanted: dict[str, object]) -> Column:
    tests = [F.trim(F.try_element_at(meta, F.lit(k)).cast("string")) == str(v).strip() for k, v in wanted.items() if k.strip() and str(v).strip()]
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def accepts_type(types: Column, content_type: Column) -> Column:
    """Exact member, or the member 'major/*'."""
    return F.array_contains(types, content_type) | F.array_contains(types, F.concat(F.split_part(content_type, F.lit("/"), F.lit(1)), F.lit("/*")))


def not_expired(expires: Column, as_of: Column, null_is_never: bool = True) -> Column:
    return F.coalesce(expires > as_of, F.lit(null_is_never))


def mentions(kw: str, *texts: Column, tags: Column | None = None) -> Column:
    """Whether a text or a tag contains the keyword, whatever its case; no wildcards, a blank keyword is none."""
    word = kw.strip().lower()
    if not word:
        return F.lit(True)
    found = reduce(lambda a, b: a | b, [F.coalesce(F.lower(t).contains(word), F.lit(False)) for t in texts], F.lit(False))
    return found if tags is None else found | F.coalesce(F.exists(tags, lambda t: F.lower(t).contains(word)), F.lit(False))
