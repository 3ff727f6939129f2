"""Queries of the general problems: missing targets (p2) and uneven keys (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.functions.paths import locate, resolve
from spindrel.operators.fragments import distinct_per_key
from spindrel.operators.orphans import orphan_references, orphan_report
from spindrel.runtime import filled, fold, strip, table

ROOT = "projects/"
#: One letter for each table, as a capital where the reference has no id.
CODES = {"paper_entry": "p", "supplement_file": "s", "kb_source": "k"}


def references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All references as ``(rid, key, at)`` and all lives as ``(key, start, end)``."""
    papers = table(spark, d, "paper_entry").distinct().where(filled("insights_path"))
    supplements = table(spark, d, "supplement_file").distinct().where(filled("path"))
    sources = table(spark, d, "kb_source").distinct().where(filled("kb_id"))
    file_key = lambda path, base: F.concat(F.lit("file:"), locate(F.col(path), F.col(base), ROOT))
    kb_key = F.concat(F.lit("kb:"), fold("kb_id"))
    pick = lambda df, name, ref_id, key, at: df.select(
        F.coalesce(F.concat(F.lit(CODES[name]), F.col(ref_id).cast("string")), F.lit(CODES[name].upper())).alias("rid"), key.alias("key"), F.col(at).alias("at")
    )
    refs = (
        pick(papers, "paper_entry", "paper_id", file_key("insights_path", "paper_dir"), "registered_at")
        .unionByName(pick(supplements, "supplement_file", "supp_id", file_key("path", "dir"), "recorded_at"))
        .unionByName(pick(sources, "kb_source", "kb_ref_id", kb_key, "recorded_at"))
    )
    artifacts = table(spark, d, "artifact").select(
        F.concat(F.lit("file:"), resolve(strip("path"))).alias("key"), F.col("created_at").alias("start"), F.col("deleted_at").alias("end")
    )
    releases = table(spark, d, "kb_release").select(
        kb_key.alias("key"), F.col("created_at").alias("start"), F.col("retired_at").alias("end")
    )
    return refs, artifacts.unionByName(releases)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs, lives = references(spark, d)
    found = orphan_references(refs, F.col("rid"), F.col("key"), F.col("at"), lives, F.col("key"), F.col("start"), F.col("end"))
    code = F.substring("rid", 1, 1)
    name = F.create_map(*[F.lit(x) for t, c in CODES.items() for x in (c, t)])[F.lower(code)]
    return found.select(name.alias("ref_table"), F.when(code == F.lower(code), F.expr("substring(rid, 2)")).alias("ref_id"), "at")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """References without a live target at their time; a reference listed with several targets comes once."""
    return _orphans(spark, d).select("ref_table", "ref_id").distinct()


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and month of their time."""
    return orphan_report(_orphans(spark, d), F.col("ref_table"), F.col("at"))


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Registered samples, one row per key: ``skey``, ``sample_id``, ``dataset_id``, ``grp`` (folded)."""
    return (
        table(spark, d, "sample_entry")
        .where(filled("sample_id"))
        .groupBy(fold("sample_id").alias("skey"))
        .agg(F.min("sample_id").alias("sample_id"), F.min("dataset_id").alias("dataset_id"), F.min(fold("grp")).alias("grp"))
    )


def setting_samples(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    """The samples of each setting of a strategy: ``setting_id``, limits, seed and the sample's columns."""
    keep = F.transform(F.coalesce("sample_keep", F.array().cast("array<string>")), fold)
    settings = (
        table(spark, d, "downsample_setting")
        .where(fold("strategy") == strategy)
        .select("setting_id", "dataset_id", "target_total", "max_per_sample", "random_seed", keep.alias("keep"))
        .distinct()
    )
    every = F.size("keep") == 0
    return settings.join(samples(spark, d), "dataset_id").where(every | F.array_contains("keep", F.col("skey"))).drop("keep")


def sample_cells(spark: SparkSession, d: str) -> DataFrame:
    """``skey``, ``n_rows``, ``n_cells`` of every registered sample."""
    obs, registered = table(spark, d, "obs_annotated"), table(spark, d, "sample_entry").where(filled("sample_id"))
    return distinct_per_key(obs, fold("sample_id"), F.col("cell_id"), registered, fold("sample_id")).select(
        F.col("__key").alias("skey"), "n_rows", F.col("n_values").alias("n_cells")
    )


def _exceeding(spark: SparkSession, d: str, cells: DataFrame) -> DataFrame:
    limits = setting_samples(spark, d, "max_per_sample").where("max_per_sample is not null")
    return limits.join(cells, "skey").where("n_cells > max_per_sample")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Samples with more cells than the limit of a setting of strategy max_per_sample."""
    return _exceeding(spark, d, sample_cells(spark, d)).select("setting_id", "sample_id").distinct()


def p4_sample_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of every registered sample and the number of settings whose limit they exceed."""
    cells = sample_cells(spark, d)
    over = _exceeding(spark, d, cells).groupBy("skey").agg(F.countDistinct("setting_id").alias("n"))
    return samples(spark, d).join(cells, "skey").join(over, "skey", "left").select(
        "sample_id", "dataset_id", "n_rows", "n_cells", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_settings_exceeded")
    )


def queries() -> dict:
    return {"p2_found": p2_found, "p2_report": p2_report, "p4_found": p4_found, "p4_sample_cells": p4_sample_cells}


_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}\x0b\x1c-\x1f\x85]+|[\s\p{{Z}}\x0b\x1c-\x1f\x85]+$', '', 'g')"
_FOLD = "lower(" + _STRIP + ")"
_FILLED = "({0} is not null and length(" + _STRIP + ") > 0)"
_PARTS = r"""list_reduce(list_prepend([]::varchar[], list_transform(string_split(replace({0}, '\', '/'), '/'), lambda x: [x])),
  lambda a, x: case when x[1] in ('', '.') then a when x[1] = '..' and len(a) > 0 and a[-1] <> '..' then a[:-2] else list_concat(a, x) end)"""
_RESOLVED = "array_to_string(" + _PARTS + ", '/')"
_ORPHANS = f"""
with file_ref as (
  select distinct 'paper_entry' ref_table, paper_id ref_id, {_STRIP.format('insights_path')} path, coalesce(paper_dir, '') base, registered_at "at"
  from paper_entry where {_FILLED.format('insights_path')}
  union all
  select distinct 'supplement_file', cast(supp_id as varchar), {_STRIP.format('path')}, coalesce(dir, ''), recorded_at
  from supplement_file where {_FILLED.format('path')}),
own as (select *, {_RESOLVED.format('path')} o from file_ref),
ref as (
  select ref_table, ref_id, "at", 'file:' || case when starts_with(o, 'projects/') then o else {_RESOLVED.format("(base || '/' || o)")} end k from own
  union
  select 'kb_source', cast(kb_ref_id as varchar), recorded_at, 'kb:' || {_FOLD.format('kb_id')} from kb_source where {_FILLED.format('kb_id')}),
life as (
  select 'file:' || {_RESOLVED.format(_STRIP.format('path'))} k, created_at s, deleted_at e from artifact
  union all select 'kb:' || {_FOLD.format('kb_id')}, created_at, retired_at from kb_release),
orphan as (select distinct * from ref r where not exists (
  select 1 from life l where l.k = r.k and l.s <= r."at" and (l.e is null or r."at" < l.e)))
"""
_CELLS = f"""
with smp as (select {_FOLD.format('sample_id')} skey, min(sample_id) sample_id, min(dataset_id) dataset_id
  from sample_entry where {_FILLED.format('sample_id')} group by 1),
cnt as (select {_FOLD.format('sample_id')} skey, count(*) n_rows, count(distinct cell_id) n_cells from obs_annotated group by 1),
cells as (select s.*, coalesce(n_rows, 0) n_rows, coalesce(n_cells, 0) n_cells from smp s left join cnt using (skey)),
over_limit as (select distinct t.setting_id, c.skey, c.sample_id from downsample_setting t join cells c using (dataset_id)
  where {_FOLD.format('strategy')} = 'max_per_sample' and max_per_sample is not null and n_cells > max_per_sample
  and (coalesce(len(sample_keep), 0) = 0 or list_contains(list_transform(sample_keep, lambda x: {_FOLD.format('x')}), c.skey)))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _ORPHANS + "select distinct ref_table, ref_id from orphan",
        "p2_report": _ORPHANS + """select ref_table, strftime("at", '%Y-%m') as month, count(*) as n_orphans from orphan group by 1, 2""",
        "p4_found": _CELLS + "select setting_id, sample_id from over_limit",
        "p4_sample_cells": _CELLS
        + """select c.sample_id, c.dataset_id, c.n_rows, c.n_cells, count(o.setting_id) as n_settings_exceeded
        from cells c left join over_limit o using (skey) group by all""",
    }
