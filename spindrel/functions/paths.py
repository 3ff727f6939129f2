"""Path text as column expressions: either slash separates, ``.`` and ``..`` are resolved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spindrel.runtime import strip


def resolve(path: Column) -> Column:
    """``a\\\\b/./c/../d`` as ``a/b/d``. Empty parts and ``.`` vanish; ``..`` above the start stays, as ``../x``."""
    parts = F.split(F.regexp_replace(path, r"\\", "/"), "/")
    step = lambda acc, x: (
        F.when(x.isin("", "."), acc)
        .when((x == "..") & (F.size(acc) > 0) & (F.element_at(acc, -1) != ".."), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .otherwise(F.array_append(acc, x))
    )
    resolved = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    plain = path.rlike(r"^[^\\/.]([^\\/]|/[^\\/.])*$")  # nothing to resolve, as for most paths
    return F.when(plain, path).otherwise(resolved)


def locate(path: Column, base: Column, root: str) -> Column:
    """A path as meant: from the root if it then begins with ``root``, else from ``base`` (null base: the root)."""
    own = resolve(strip(path))
    joined = resolve(F.concat(strip(F.coalesce(base, F.lit(""))), F.lit("/"), own))
    return F.when(own.startswith(root), own).otherwise(joined)
