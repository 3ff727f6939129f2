"""Queries of the llm problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm import canonical, cube, leaks, packing, prose, topn
from spindrel.plans.registry_queries import setting_samples
from spindrel.runtime import checkpoint, fold, table

DEFAULT_N = 50


# --- problem 1: typed names to canonical types


def _p1(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "kb_type")
    names = types.select(F.explode(F.array("type_key", "display_name")).alias("cell_type_raw")).distinct()
    return canonical.map_rows(table(spark, d, "obs_annotated").select("row_id", "cell_type_raw"), "cell_type_raw", types, names)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The type that each typed name stands for, where it is not already the name in the list."""
    return _p1(spark, d).select("row_id", "type_key")


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed names that stand for no entry, with their numbers of cells."""
    return canonical.unmatched_report(_p1(spark, d), "cell_type_raw")


# --- problem 3: top N per group


def p3_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The best ``n_genes`` genes of every dataset and group, with score, fold change and rank."""
    genes = topn.latest(
        table(spark, d, "marker_gene").where("dataset_id is not null and group_label is not null and names is not null"),
        ["dataset_id", "group_label", "names"],
        "exported_at",
        "row_id",
        ["scores", "logfoldchanges"],
    )
    limits = table(spark, d, "de_config").groupBy("dataset_id").agg(F.max("n_genes").alias("n_genes"))
    genes = checkpoint(genes.join(limits, "dataset_id", "left"))  # read for the histogram and again for the rows
    return topn.top_per_group(
        genes,
        ["dataset_id", "group_label"],
        "scores",
        [F.col("logfoldchanges").desc_nulls_last(), F.col("names").asc()],
        F.coalesce("n_genes", F.lit(DEFAULT_N)),
        F.col("names"),
    ).select("dataset_id", "group_label", "names", "scores", "logfoldchanges", F.col("rank").cast("bigint").alias("rank"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_ranked(spark, d).select("dataset_id", "group_label", "names")


_RANKED = """
with one as (select *, row_number() over (partition by dataset_id, group_label, names order by exported_at desc nulls last, row_id desc) k
  from marker_gene where dataset_id is not null and group_label is not null and names is not null),
lim as (select dataset_id, max(n_genes) n from de_config group by 1),
ranked as (select o.*, coalesce(n, 50) n, row_number() over (partition by o.dataset_id, group_label
  order by scores desc, case when isnan(logfoldchanges) then 'inf'::double else logfoldchanges end desc nulls last, encode(names) asc) as rank
  from one o left join lim using (dataset_id) where k = 1 and scores is not null and not isnan(scores))
"""


# --- problem 5: target proportions


def _p5(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    units = (
        setting_samples(spark, d, "stratified")
        .where("target_total is not null and grp is not null")
        .select("setting_id", F.col("grp").alias("category"), F.col("skey").alias("unit"), F.col("max_per_sample").alias("most"), F.col("random_seed").alias("seed"))
        .distinct()
    )
    settings = (
        table(spark, d, "downsample_setting")
        .where((fold("strategy") == "stratified") & F.col("target_total").isNotNull())
        .select("setting_id", "target_total").distinct()
    )
    need = F.greatest(
        F.coalesce(F.col("min_cells").cast("bigint"), F.lit(0)),
        F.floor(F.col("target_total").cast("bigint") * F.coalesce("share_pct", F.lit(0)) / 100),
    )
    targets = (
        table(spark, d, "target_share").select("setting_id", fold("grp").alias("category"), "share_pct", "min_cells").distinct()
        .where("category is not null").join(settings, "setting_id")
        .groupBy("setting_id", "category").agg(F.max(need).alias("need"))
    )
    return cube.cube_sample(table(spark, d, "obs_annotated"), fold("sample_id"), F.col("cell_id"), units, targets)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups for which the drawn sample falls short of what was wanted."""
    return _p5(spark, d)[1].where("shortfall > 0").select("setting_id", F.col("category").alias("grp"))


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    """The drawn cells of every setting."""
    return _p5(spark, d)[0].select("setting_id", F.col("category").alias("grp"), F.col("unit").alias("sample_key"), F.col("item").alias("cell_id"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted, available and drawn cells of every setting and group, and the residual imbalance of their shares."""
    report = _p5(spark, d)[1].withColumnRenamed("category", "grp")
    return report.withColumns({c: F.round(c, 9) + F.lit(0.0) for c in ("wanted_share", "realised_share", "imbalance")})


def _norm(x: str) -> str:
    return rf"lower(regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"


_REPORT = f"""
with smp as (select {_norm('sample_id')} skey, min(dataset_id) dataset_id, min({_norm('grp')}) grp from sample_entry group by 1),
cnt as (select {_norm('sample_id')} skey, count(distinct cell_id) n from obs_annotated group by 1),
tgt as (select t.setting_id, {_norm('t.grp')} grp, max(greatest(coalesce(min_cells, 0), s.target_total::bigint * share_pct // 100)) need
  from target_share t join (select distinct setting_id, target_total from downsample_setting
    where {_norm('strategy')} = 'stratified' and target_total is not null) s using (setting_id) group by all),
use as (select distinct s.setting_id, m.grp, m.skey, least(n, coalesce(max_per_sample, n)) give
  from downsample_setting s join smp m using (dataset_id) join cnt using (skey)
  where coalesce(len(sample_keep), 0) = 0 or list_contains(list_transform(sample_keep, lambda x: {_norm('x')}), m.skey)),
av as (select setting_id, grp, sum(give)::bigint available from use group by all),
report as (select t.setting_id, t.grp, need::bigint need, coalesce(available, 0) available,
  least(need, coalesce(available, 0))::bigint selected, (need - least(need, coalesce(available, 0)))::bigint shortfall
  from tgt t left join av using (setting_id, grp)),
shares as (select *, coalesce(need / nullif(sum(need) over (partition by setting_id), 0), 0) wanted,
  coalesce(selected / nullif(sum(selected) over (partition by setting_id), 0), 0) realised from report)
"""


# --- problem 6: containers


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every piece of every text."""
    return packing.pack(table(spark, d, "documents"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers and unused space by bucket."""
    return packing.packing_report(p6_containers(spark, d))


# --- problem 7: leaked evaluation items


def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    """Documents and items with a common or nearly common passage, how much and how alike."""
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a window of an item word for word."""
    return p7_passages(spark, d).where("n_exact > 0").select("doc_id", "item_id")


# --- problem 8: text quality


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of every document."""
    return prose.text_statistics(table(spark, d, "documents"), table(spark, d, "common_word"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of which less than half is running prose."""
    return p8_statistics(spark, d).where("prose_share < 0.5").select("doc_id")


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_unmatched": p1_unmatched,
        "p3_found": p3_found, "p3_ranked": p3_ranked,
        "p5_found": p5_found, "p5_sample": p5_sample, "p5_report": p5_report,
        "p6_containers": p6_containers, "p6_report": p6_report,
        "p7_found": p7_found, "p7_passages": p7_passages,
        "p8_found": p8_found, "p8_statistics": p8_statistics,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _RANKED + "select dataset_id, group_label, names from ranked where rank <= n",
        "p3_ranked": _RANKED + "select dataset_id, group_label, names, scores, logfoldchanges, rank from ranked where rank <= n",
        "p5_found": _REPORT + "select setting_id, grp from report where shortfall > 0",
        "p5_report": _REPORT + """select setting_id, grp, need, available, selected, shortfall, round(wanted, 9) + 0.0 wanted_share,
          round(realised, 9) + 0.0 realised_share, round(realised - wanted, 9) + 0.0 imbalance from shares""",
    }
