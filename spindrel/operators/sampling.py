"""Sampling whose result is the same in every run: rows are ordered by a hash of their key and a seed.

No stratum is sorted as a whole. Its hashes are counted in ranges; ranges that fit the limit are taken as they are, and only rows
of the range in which the limit lies are ranked.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of columns in between; no input column may begin with this prefix.
RANGE, N, BELOW, LIMIT, RANK, ALL = (f"__spindrel_{x}" for x in "range n below limit rank all".split())

# What a predicate or formula may hold beside the columns.
WORDS = {"and", "or", "not", "in", "is", "null", "like", "between", "true", "false", "case", "when", "then", "else", "end"}
FUNCTIONS = {"abs", "coalesce", "greatest", "least", "ln", "log", "log10", "log1p", "log2", "lower", "sqrt", "exp", "pow", "round", "trim", "upper", "isnan", "nullif", "try_divide"}
_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|'')*'|"(?:[^"\\])*")|(?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?)|(?P<word>`[^`]+`|[A-Za-z_]\w*)|(?P<sign><=|>=|<>|!=|==|[-+*/%<>=(),]))""")


def draw(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _limited(df: DataFrame, key: str, by: list[str], limit: Column, seed: int, bits: int) -> DataFrame:
    rows = df.withColumn(RANGE, F.shiftright(draw(key, seed), 64 - bits)).withColumn(LIMIT, limit.cast("bigint"))
    counts = rows.groupBy(*by, RANGE).agg(F.count(F.lit(1)).alias(N), F.max(LIMIT).alias(ALL))
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(BELOW, F.coalesce(F.sum(N).over(before), F.lit(0))).where(F.col(BELOW) < F.col(ALL)).drop(N, ALL)
    same = [rows[c].eqNullSafe(counts[c]) for c in [*by, RANGE]]
    kept = rows.join(counts, same).select(rows["*"], counts[BELOW])
    order = Window.partitionBy(*by, RANGE).orderBy(draw(key, seed), key)
    return kept.withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) + F.col(BELOW) <= F.col(LIMIT)).select(*df.columns)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows (all if there are fewer)."""
    return _limited(df, key, [], F.lit(n), seed, 16)


def per_stratum(df: DataFrame, key: str, stratum: str | list[str], limit: Column, seed: int = 42) -> DataFrame:
    """At most ``limit`` rows of each stratum; ``limit`` is constant within one, and null keeps nothing. Null is a stratum, too."""
    return _limited(df, key, [stratum] if isinstance(stratum, str) else stratum, limit, seed, 12)


def allocation(df: DataFrame, stratum: str, target: int) -> DataFrame:
    """Largest-remainder shares of ``target``: the whole parts, then one each by falling fraction and by name."""
    sizes = df.where(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row for each stratum
    exact = F.col("n") * F.least(F.lit(target), total) / total
    parts = sizes.withColumn("whole", F.floor(exact)).withColumn("rest", exact - F.floor(exact))
    left = F.least(F.lit(target), total) - F.sum("whole").over(Window.partitionBy())
    order = F.row_number().over(Window.orderBy(F.desc("rest"), stratum))
    return parts.withColumn("__left", left).withColumn("__order", order).select(
        stratum, "n", (F.col("whole") + (F.col("__order") <= F.col("__left")).cast("int")).cast("bigint").alias("n_sample")
    )


def stratified(df: DataFrame, key: str, stratum: str, target: int, seed: int = 42) -> DataFrame:
    """A sample of ``target`` rows with the strata's own proportions."""
    shares = allocation(df, stratum, target).select(stratum, "n_sample")
    return per_stratum(df.join(shares, stratum), key, stratum, F.col("n_sample"), seed).drop("n_sample")


def pseudo_replicate(key: str, seed: int = 42) -> Column:
    """``r0`` or ``r1``, by the key's hash."""
    return F.concat(F.lit("r"), F.pmod(draw(key, seed), F.lit(2)).cast("string"))


def checked(text: str, columns: list[str]) -> Column:
    """An expression of columns, numbers, texts, comparisons and a few functions; anything else is a ValueError."""
    known, at = {c.lower() for c in columns}, 0
    while at < len(text.rstrip()):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"not allowed in an expression: {text[at : at + 20]!r}")
        word = (m["word"] or "").strip("`").lower()
        call = text[m.end() :].lstrip().startswith("(")
        if word and word not in known and word not in WORDS and not (call and word in FUNCTIONS):
            raise ValueError(f"no column, word or function of an expression: {word!r}")
        if word and call and word not in FUNCTIONS | WORDS:
            raise ValueError(f"no function of an expression: {word!r}")
        at = m.end()
    return F.expr(text)


def selected(df: DataFrame, keep_column: str | None = None, keep: list | None = None, predicate: str | None = None) -> DataFrame:
    """Rows whose ``keep_column`` is among ``keep`` (all if empty) and that satisfy a checked predicate on the columns."""
    out = df.where(F.col(keep_column).isin(keep)) if keep_column and keep else df
    return out.where(checked(predicate, df.columns)) if predicate and predicate.strip() else out


def formulas(df: DataFrame, given: dict[str, str]) -> DataFrame:
    """Columns by checked formulas of the others; a division by zero is null."""
    return df.select("*", *[checked(f, df.columns).alias(name) for name, f in given.items()])
