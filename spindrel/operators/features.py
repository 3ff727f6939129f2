"""Genes, cells and samples around the matrix: names, thresholds, attachments, peaks, selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.operators import intervals, matrix, stats

# Forms of identifiers, and words that tell assays apart.
ENSEMBL = r"^ENS[A-Z]*G\d{6,}"
MT_PREFIXES = ("MT-", "mt-", "Mt-")
MODALITIES = {"atac": ("atac", "chromatin accessibility"), "spatial": ("visium", "spatial"), "bulk": ("bulk",), "rna": ("rna", "expression", "transcript")}
TISSUES = ("retina", "brain", "heart", "liver", "lung", "kidney")
GENOMES = {"human": "hg38", "mouse": "mm10", "zebrafish": "danRer11"}


def v() -> Column:
    return F.col("value").cast("double")


# --- names of genes


def id_type(genes: DataFrame, first: int = 200) -> DataFrame:
    """Kind of the identifiers, by the first ``first`` in order of ``n`` (a head, as is the feature); one row."""
    head = genes.orderBy("n").limit(first)
    share = F.coalesce(F.avg(F.col("gene").rlike(ENSEMBL).cast("double")), F.lit(0.0))
    return head.agg(share.alias("share")).select("share", F.when(F.col("share") > 0.7, "ensembl").when(F.col("share") > 0, "mixed").otherwise("symbol").alias("kind"))


def first_rows(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__k = 1").drop("__k")


def with_symbols(genes: DataFrame, symbols: DataFrame) -> DataFrame:
    """``genes(gene_id, n)`` with the symbol of each from ``symbols(gene_id, symbol)``; unmapped ones and later ones of a symbol are left out."""
    mapped = genes.join(symbols.groupBy("gene_id").agg(F.min("symbol").alias("symbol")), "gene_id").where("symbol is not null and symbol <> ''")
    return first_rows(mapped, ["symbol"], ["n", "gene_id"])


def orthologs(genes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``gene, ortholog`` with the one-to-one partner of each gene; others keep their name, unmapped identifiers are marked.

    ``pairs(source, target)``; a source with several targets, or a target with several sources, is not one to one.
    """
    p = pairs.distinct()
    one = lambda c: p.groupBy(c).agg(F.count(F.lit(1)).alias("k")).where("k = 1").select(c)
    single = p.join(one("source"), "source", "left_semi").join(one("target"), "target", "left_semi")
    j = genes.join(single.withColumnRenamed("source", "gene"), "gene", "left")
    kept = F.when(F.col("gene").rlike(ENSEMBL), F.concat(F.lit("UNMAPPED_"), "gene")).otherwise(F.col("gene"))
    return j.select("gene", F.coalesce("target", kept).alias("ortholog"))


def normalised_symbols(df: DataFrame, column: str, order: list) -> DataFrame:
    """Rows with a symbol, in upper case, the first of each."""
    rows = df.where(F.col(column).isNotNull() & (F.trim(column) != "")).withColumn(column, F.upper(F.trim(column)))
    return first_rows(rows, [column], order)


def gene_set_name(name: Column, species: str) -> Column:
    """The library of gene sets for a species."""
    return F.regexp_replace(name, "_Human$", "_Mouse") if species == "mouse" else name


def mitochondrial_prefix(genes: DataFrame) -> DataFrame:
    """The prefix of mitochondrial genes that most names have, the first of those with as many; null if none; one row."""
    counts = genes.agg(*[F.count_if(F.col("gene").startswith(p)).alias(f"n{i}") for i, p in enumerate(MT_PREFIXES)])
    most = F.greatest(*[F.col(f"n{i}") for i in range(len(MT_PREFIXES))])
    pick = F.coalesce(*[F.when(F.col(f"n{i}") == most, p) for i, p in enumerate(MT_PREFIXES)])
    return counts.select(F.when(most > 0, pick).alias("prefix"), most.alias("n"))


def merged_lists(lists: list[DataFrame], cap: int) -> DataFrame:
    """``gene, source, rank``: the genes of ordered lists ``gene, n``, earlier lists first, each gene once, at most ``cap`` of them."""
    tagged = reduce(DataFrame.unionByName, [x.select("gene", "n", F.lit(i).alias("source")) for i, x in enumerate(lists)])
    once = first_rows(tagged, ["gene"], ["source", "n"])
    return once.withColumn("rank", F.row_number().over(Window.orderBy("source", "n", "gene"))).where(F.col("rank") <= cap).select("gene", "source", "rank")  # one row a gene


def common_genes(sets: DataFrame) -> DataFrame:
    """Genes that every sample of ``sets(sample, gene)`` has."""
    n = sets.agg(F.count_distinct("sample").alias("n"))
    per = sets.groupBy("gene").agg(F.count_distinct("sample").alias("k"))
    return per.join(F.broadcast(n), F.col("k") == F.col("n")).select("gene")


def same_genes(sets: DataFrame) -> DataFrame:
    """Do all samples of ``sets(sample, n, gene)`` have the same genes in the same order? By number and sum of hashes; one row."""
    print_ = sets.groupBy("sample").agg(F.count(F.lit(1)).alias("k"), F.sum(F.xxhash64("n", "gene").cast("decimal(38,0)")).alias("h"))
    return print_.agg((F.count_distinct("k", "h") <= 1).alias("same"), F.count(F.lit(1)).alias("n_samples"))


def aligned_genes(a: DataFrame, b: DataFrame, least: float = 0.5) -> DataFrame:
    """Genes of two tables ``gene``: how many are common, as a share of the smaller, and whether that is enough; one row."""
    a, b = a.select("gene").distinct(), b.select("gene").distinct()
    one = a.agg(F.count(F.lit(1)).alias("n_a")).crossJoin(b.agg(F.count(F.lit(1)).alias("n_b"))).crossJoin(a.join(b, "gene", "left_semi").agg(F.count(F.lit(1)).alias("n_both")))
    share = F.coalesce(F.try_divide("n_both", F.least("n_a", "n_b")), F.lit(0.0))
    return one.withColumn("share", share).withColumn("enough", F.col("share") >= least)


# --- cells and thresholds


def hard_limit(metrics: DataFrame, column: str, low: float, least_cells: int = 10, share: float = 0.8) -> DataFrame:
    """A lower limit that is at most ``share`` of the median, if there are enough cells; one row."""
    one = metrics.agg(F.count(column).alias("n"), F.median(column).alias("median"))
    return one.select("n", "median", F.when(F.col("n") >= least_cells, F.least(F.lit(float(low)), F.col("median") * share)).otherwise(F.lit(float(low))).alias("low"))


def suggestions(metrics: DataFrame, mt_high: float = 20.0, genes_low: float = 500.0) -> DataFrame:
    """Findings on quality, per sample: a high median of mitochondrial counts, few genes, many cells beyond three deviations."""
    one = metrics.groupBy("sample").agg(F.median("pct_mt").alias("mt"), F.median("n_genes").alias("genes"), F.avg("total").alias("m"), F.stddev_samp("total").alias("s"))
    far = metrics.join(one, "sample").groupBy("sample").agg(F.avg((F.abs(F.col("total") - F.col("m")) > 3 * F.col("s")).cast("double")).alias("far"))
    found = F.array_compact(F.array(
        F.when(F.col("mt") > mt_high, F.lit("mitochondrial")), F.when(F.col("genes") < genes_low, F.lit("few_genes")), F.when(F.col("far") > 0.01, F.lit("outliers"))
    ))
    return one.join(far, "sample").select("sample", F.array_join(found, ",").alias("findings"))


def attached(cells: DataFrame, labels: DataFrame, key: str, columns: list[str], missing: str = "unassigned") -> DataFrame:
    """Cells with the label columns of their barcode, ``missing`` where there is none; columns that cells have are kept."""
    new = [c for c in columns if c not in cells.columns]
    j = cells.join(first_rows(labels.select(key, *new), [key], new), key, "left")
    return j.withColumns({c: F.coalesce(c, F.lit(missing)) for c in new})


def with_batches(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that have all batch keys."""
    return cells.dropna(subset=keys)


def expressed_by_group(x: DataFrame, samples: DataFrame, least_count: float, least_samples: int, least_total: float) -> DataFrame:
    """Genes that reach a count per million in as many samples as the smallest group, and a total.

    ``x(sample, gene, value)``, ``samples(sample, grp)``. The limit per million is ``least_count`` at the median library.
    """
    libs = x.groupBy("sample").agg(F.sum(v()).alias("lib"))
    mid = libs.agg(F.median("lib").alias("mid"))
    smallest = samples.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).agg(F.least(F.min("n"), F.lit(least_samples)).alias("need"))
    cpm = x.join(libs, "sample").crossJoin(F.broadcast(mid)).crossJoin(F.broadcast(smallest))
    reach = v() / F.col("lib") * 1e6 >= F.lit(float(least_count)) / F.col("mid") * 1e6
    per = cpm.groupBy("gene").agg(F.count_if(reach).alias("k"), F.sum(v()).alias("total"), F.max("need").alias("need"))
    return per.where((F.col("k") >= F.col("need")) & (F.col("total") >= least_total)).select("gene", "total")


def cycle_phase(x: DataFrame, n_cells: int, s_genes: list[str], g2m_genes: list[str], bins: int = 25) -> DataFrame:
    """``s``, ``g2m`` and the phase of each cell: the higher score if one is above 0, else ``G1``."""
    s = matrix.score_set(x, n_cells, s_genes, bins).select("cell_id", F.col("score").alias("s"))
    g = matrix.score_set(x, n_cells, g2m_genes, bins).select("cell_id", F.col("score").alias("g2m"))
    out = s.join(g, "cell_id", "full").na.fill(0.0, ["s", "g2m"])
    return out.withColumn("phase", F.when((F.col("s") <= 0) & (F.col("g2m") <= 0), "G1").when(F.col("s") >= F.col("g2m"), "S").otherwise("G2M"))


def root_cells(cells: DataFrame, types: list[str]) -> DataFrame:
    """Cells to start a trajectory from: those of the types at the first stage, else of the types, else of the first stage.

    ``cells(cell_id, type, stage)``; without any stage the first cell by name.
    """
    first = cells.agg(F.min("stage").alias("__first"))
    own = F.coalesce(F.col("type").isin(types), F.lit(False)) if types else F.lit(False)
    start = F.coalesce(F.col("stage") == F.col("__first"), F.lit(False))
    level = F.when(own & start, 1).when(own, 2).when(start, 3).otherwise(4)
    leveled = cells.crossJoin(F.broadcast(first)).withColumn("level", level)
    best = leveled.agg(F.min("level").alias("__best"), F.min("cell_id").alias("__cell"))
    out = leveled.crossJoin(F.broadcast(best)).where((F.col("level") == F.col("__best")) & ((F.col("level") < 4) | (F.col("cell_id") == F.col("__cell"))))
    return out.select("cell_id", "level")


def condition_metrics(x: DataFrame, cells: DataFrame, genes: list[str], least: int = 10) -> DataFrame:
    """Mean over all cells of each gene, of the set, and the share of the condition's cells, for each ``type, condition``.

    Combinations of fewer than ``least`` cells are left out.
    """
    n = cells.groupBy("type", "condition").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    whole = cells.groupBy("condition").agg(F.count(F.lit(1)).alias("n_condition"))
    means = x.where(F.col("gene_id").isin(genes)).join(cells, "cell_id").groupBy("type", "condition", "gene_id").agg(F.sum(v()).alias("s"))
    per = n.join(means, ["type", "condition"], "left").groupBy("type", "condition").agg(F.max("n").alias("n"), (F.coalesce(F.sum("s"), F.lit(0.0)) / F.max("n") / len(genes)).alias("set_mean"))
    return per.join(whole, "condition").select("type", "condition", "n", "set_mean", (F.col("n") * 100 / F.col("n_condition")).alias("pct_cells"))


def pairwise_effects(x: DataFrame, cells: DataFrame, least: int = 20, least_side: int = 10) -> DataFrame:
    """Rank-sum test of each gene between neighbouring stages of each type: ``type, first, second, gene_id, z, logfc, p, p_adj``.

    ``cells(cell_id, type, stage)``. Pairs with fewer cells than ``least``, or than ``least_side`` on one side, are left out.
    """
    sizes = cells.groupBy("type", "stage").agg(F.count(F.lit(1)).alias("n"))
    next_ = Window.partitionBy("type").orderBy("stage")
    pairs = sizes.withColumn("second", F.lead("stage").over(next_)).withColumn("m", F.lead("n").over(next_)).where("second is not null")
    pairs = pairs.where((F.col("n") + F.col("m") >= least) & (F.least("n", "m") >= least_side)).select("type", F.col("stage").alias("first"), "second", "n", "m")
    side = F.explode(F.array(F.struct(F.col("first").alias("stage"), F.lit(True).alias("a")), F.struct(F.col("second").alias("stage"), F.lit(False).alias("a")))).alias("x")
    ends = pairs.select("type", "first", "second", "n", "m", side).select("type", "first", "second", "n", "m", "x.stage", "x.a")  # a stage is in two pairs at most
    by = ["type", "first", "second", "gene_id"]
    counts = x.where("value > 0").join(cells, "cell_id").groupBy("type", "stage", "gene_id", "value").agg(F.count(F.lit(1)).alias("c"))
    both = counts.join(F.broadcast(ends), ["type", "stage"]).groupBy(*by, "value").agg(
        F.sum(F.when(F.col("a"), F.col("c")).otherwise(0)).alias("ca"), F.sum("c").alias("t"), F.max("n").alias("n"), F.max("m").alias("m")
    )
    upto = F.sum("t").over(Window.partitionBy(*by).orderBy("value"))
    r = both.withColumn("upto", upto)
    value = F.col("value").cast("double")
    per = r.groupBy(*by).agg(
        F.max("n").alias("n"), F.max("m").alias("m"), F.sum("t").alias("nnz"), F.sum("ca").alias("na"), F.sum(F.col("ca") * (F.col("upto") - F.col("t") + (F.col("t") + 1) / 2)).alias("ra"),
        F.sum(F.col("t").cast("double") * F.col("t") * F.col("t") - F.col("t")).alias("ties"), F.sum(F.col("ca") * value).alias("sa"), F.sum((F.col("t") - F.col("ca")) * value).alias("sb"),
    )
    per = per.withColumn("both", F.col("n") + F.col("m")).withColumn("zeros", F.col("both") - F.col("nnz"))
    rank_sum = F.expr("ra + na * zeros + (n - na) * (1 + zeros) / 2.0")
    tie = F.expr("1 - (ties + cast(zeros as double) * zeros * zeros - zeros) / (cast(both as double) * both * both - both)")
    sigma = F.sqrt(F.greatest(F.lit(0.0), tie) * F.expr("cast(n as double) * m * (both + 1) / 12"))
    z = F.coalesce(F.try_divide(rank_sum - F.expr("n * (both + 1) / 2.0"), F.when(sigma > 0, sigma)), F.lit(0.0))
    fold = F.log2((F.expm1(F.col("sa") / F.col("n")) + 1e-9) / (F.expm1(F.col("sb") / F.col("m")) + 1e-9))
    out = per.select(*by, z.alias("z"), fold.alias("logfc"), stats.normal_two_sided(z).alias("p"))
    return stats.benjamini_hochberg(out, "p", "type", "first", "second")


def always_significant(tests: DataFrame, groups: DataFrame, most_p: float = 0.05, least_fold: float = 1.0) -> DataFrame:
    """Per group, the genes that are significant against every other group; ``tests(a, b, gene, p_adj, logfc)`` has both directions."""
    n = groups.agg((F.count_distinct("grp") - 1).alias("k"))
    won = tests.where((F.col("p_adj") < most_p) & (F.col("logfc") >= least_fold)).groupBy("a", "gene").agg(F.count_distinct("b").alias("wins"))
    full = won.join(F.broadcast(n), F.col("wins") == F.col("k")).groupBy(F.col("a").alias("grp")).agg(F.count(F.lit(1)).alias("n_genes"))
    return groups.select("grp").distinct().join(full, "grp", "left").na.fill(0, ["n_genes"])


# --- selections


def top_interactions(pairs: DataFrame, rank: str, n: int) -> DataFrame:
    """The first ``n`` interactions by ``rank`` with a readable name (a report, whose length is its feature)."""
    name = F.concat(F.concat_ws(" -> ", "source", "target"), F.lit(": "), F.concat_ws("-", "ligand", "receptor"))
    return pairs.withColumn("interaction", name).orderBy(rank, "interaction").limit(n)


def variable_sources(relevance: DataFrame, n: int, by_rank: bool = False) -> DataFrame:
    """The ``n`` regulators that vary most over the groups, or with the best sum of ranks of variance and of relevance."""
    v_rank = F.row_number().over(Window.orderBy(F.desc("variance"), "source"))  # one row for each regulator
    r_rank = F.row_number().over(Window.orderBy(F.desc("relevance"), "source"))
    ranked = relevance.withColumn("v", v_rank).withColumn("r", r_rank)
    order = [F.col("v") + F.col("r"), F.col("source")] if by_rank else [F.col("v")]
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(*order))).where(F.col("rank") <= n).select("source", "rank")


def species_matches(species: Column, wanted: Column, synonyms: DataFrame, df: DataFrame) -> DataFrame:
    """Rows of ``df`` whose species is the wanted one by some name; ``synonyms(name, species)``, letter case does not count."""
    names = synonyms.select(F.lower("name").alias("__n"), F.col("species").alias("__s")).distinct()
    one = df.withColumn("__a", F.lower(species)).withColumn("__b", F.lower(wanted))
    one = one.join(names.withColumnsRenamed({"__n": "__a", "__s": "__sa"}), "__a", "left").join(names.withColumnsRenamed({"__n": "__b", "__s": "__sb"}), "__b", "left")
    return one.where(F.coalesce("__sa", "__a") == F.coalesce("__sb", "__b")).drop("__a", "__b", "__sa", "__sb")


# --- fragments and peaks


def tss_enrichment(fragments: DataFrame, sites: DataFrame, flank: int, centre: int) -> DataFrame:
    """Per cell, insertions within ``centre`` of a site per base over those in the outer flanks per base (one added below).

    ``fragments(cell_id, chrom, start, end)``, ``sites(chrom, site)``; both ends of a fragment are insertions.
    """
    cuts = fragments.select("cell_id", "chrom", F.explode(F.array("start", F.col("end") - 1)).alias("pos"))
    width = F.lit(2 * flank + 1)
    s = sites.distinct().select("chrom", "site", F.explode(F.sequence(F.floor((F.col("site") - flank) / width), F.floor((F.col("site") + flank) / width))).alias("bin"))
    near = cuts.withColumn("bin", F.floor(F.col("pos") / width)).join(s, ["chrom", "bin"]).withColumn("d", F.abs(F.col("pos") - F.col("site"))).where(F.col("d") <= flank)
    per = near.groupBy("cell_id").agg(F.count_if(F.col("d") <= centre).alias("inner"), F.count_if(F.col("d") > flank - centre).alias("outer"))
    return per.select("cell_id", "inner", "outer", (F.col("inner") / (2 * centre + 1) / ((F.col("outer") + 1) / (2.0 * centre))).alias("tss"))


def share_in_peaks(fragments: DataFrame, peaks: DataFrame, bin_width: int) -> DataFrame:
    """Per cell, fragments, those that overlap some peak, and their share. ``fragments(id, cell_id, chrom, start, end)``."""
    hit = intervals.overlaps(fragments.select("id", "chrom", "start", "end"), peaks, bin_width).select(F.col("id_a").alias("id")).distinct().withColumn("hit", F.lit(1))
    j = fragments.select("id", "cell_id").join(hit, "id", "left")
    return j.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("n_in")).withColumn("frip", F.col("n_in") / F.col("n"))


def kept_barcodes(per_cell: DataFrame, low: int, high: int, least_tss: float) -> DataFrame:
    return per_cell.where(F.col("n").between(low, high) & (F.col("tss") >= least_tss))


def binned_peaks(fragments: DataFrame, width: int, least_log: float = 5.0) -> DataFrame:
    """Windows of fixed width with more fragments than a Poisson rate of their chromosome explains, as a stand-in for peaks.

    A fragment counts where its middle lies. ``score`` is -log10 of the bound ``exp(-n ln(n / m) + n - m)`` on the tail.
    """
    mid = F.floor((F.col("start") + F.col("end")) / 2 / width)
    n = fragments.groupBy("chrom", mid.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    rate = n.groupBy("chrom").agg((F.sum("n") / (F.max("bin") - F.min("bin") + 1)).alias("m"))
    score = (F.col("n") * F.ln(F.col("n") / F.col("m")) - F.col("n") + F.col("m")) / F.ln(F.lit(10.0))
    out = n.join(rate, "chrom").where("n > m").withColumn("score", score).where(F.col("score") >= least_log)
    return out.select("chrom", (F.col("bin") * width).alias("start"), ((F.col("bin") + 1) * width).alias("end"), "n", "score")


# --- files of a data set


def folder_kinds(files: DataFrame) -> DataFrame:
    """``folder, kind, n``: what the files of each folder make together. ``files(path)``."""
    p = F.lower("path")
    f = files.select(F.regexp_extract("path", r"^(.*?)/?[^/]*$", 1).alias("folder"), F.regexp_extract(p, r"[^/]*$", 0).alias("name"))
    has = lambda pattern: F.bool_or(F.col("name").rlike(pattern))
    per = f.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), has(r"matrix\.mtx(\.gz)?$").alias("m"), has(r"barcodes\.tsv(\.gz)?$").alias("b"), has(r"(features|genes)\.tsv(\.gz)?$").alias("g"),
        has(r"peaks\.bed(\.gz)?$").alias("p"), has(r"fragments\.tsv(\.gz)?$").alias("f"), has(r"\.h5$").alias("h"), F.count_if(F.col("name").rlike(r"\.(csv|tsv|txt)(\.gz)?$")).alias("t"),
    )
    kind = (
        F.when(F.col("m") & F.col("b") & F.col("p"), "peaks").when(F.col("m") & F.col("b") & F.col("g"), "mtx").when(F.col("f"), "fragments")
        .when(F.col("h"), "h5").when(F.col("t") >= 3, "tables").otherwise("other")
    )
    return per.select("folder", kind.alias("kind"), "n")


def sample_of(path: Column) -> Column:
    """A sample's name from a file: what is before the first known part of its name, else its folder."""
    name = F.regexp_extract(path, r"[^/]*$", 0)
    head = F.regexp_replace(name, r"(?i)[._-]?(matrix|barcodes|features|genes|counts|filtered|raw)?\.(mtx|tsv|csv|txt|h5|h5ad)(\.gz)?$", "")
    return F.when(head != "", head).otherwise(F.regexp_extract(path, r"([^/]+)/[^/]*$", 1))


def tissue_of(path: Column) -> Column:
    return reduce(lambda acc, t: F.when(F.lower(path).contains(t), t).otherwise(acc), reversed(TISSUES), F.lit(None).cast("string"))


def genome_of(species: Column) -> Column:
    return reduce(lambda acc, x: F.when(species == x[0], x[1]).otherwise(acc), reversed(GENOMES.items()), F.lit(None).cast("string"))


def modalities(text: Column) -> Column:
    """Assays that a description names, ``rna`` if it names none."""
    low = F.lower(text)
    found = F.array_compact(F.array(*[F.when(reduce(Column.__or__, [low.contains(w) for w in words]), F.lit(m)) for m, words in MODALITIES.items()]))
    return F.when(F.size(found) > 0, F.array_join(found, ",")).otherwise("rna")


def value_kind(numbers: DataFrame) -> DataFrame:
    """Raw counts if all numbers are whole, else per-million values by their median; ``numbers(sample, value)``."""
    per = numbers.groupBy("sample").agg(F.bool_and(v() == F.floor(v())).alias("whole"), F.median(F.when(v() > 0, v())).alias("mid"))
    return per.select("sample", F.when(F.col("whole"), "raw").when(F.col("mid") > 1, "cpm").otherwise("tpm").alias("kind"))


