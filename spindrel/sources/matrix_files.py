"""Readers of measurement files into ``x(cell_id, gene_id, value)`` and their side tables.

Only names and first lines are looked at on the driver; contents are read by Spark's own sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.runtime import checkpoint

MISSING = float("nan")


SAMPLE_FOLDER = r"/(?:sample=)?([^/]+)/[^/]+$"


def numbered_lines(spark: SparkSession, path: str, skip: str | None = None) -> DataFrame:
    """``file, n, value``: lines of text files, numbered from 1 within each file, without those that begin with ``skip``.

    Files are read in splits like any other. A line's number is its place in its split behind the lines of the splits before it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    if skip:
        lines = lines.where(~F.col("value").startswith(skip))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # Numbers in a split rise with the lines but have gaps where lines are skipped, so they are counted within the split.
    ranked = lines.withColumn("k", F.row_number().over(Window.partitionBy("file", "at").orderBy("id"))) if skip else None
    counted = lines.groupBy("file", "at").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("first"))
    splits = counted.select("file", "at", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    if ranked is not None:
        return ranked.join(splits, ["file", "at"]).select("file", (F.col("offset") + F.col("k")).alias("n"), "value")
    return lines.join(splits, ["file", "at"]).select("file", (F.col("offset") + F.col("id") - F.col("first") + 1).alias("n"), "value")


def has_header(first_name: str) -> bool:
    """A features file has a header if its first field starts in lower case."""
    return bool(first_name) and first_name[0].islower()


def read_mtx(spark: SparkSession, matrix: str, barcodes: str, features: str, sample: str | None = None, folder: str | None = None) -> DataFrame:
    """Matrix-Market files of genes by cells with their barcodes and features: ``cell_id, gene_id, value`` and ``sample`` if it is told.

    Each path is a file or, for many samples at once, a folder or pattern; then ``folder`` is the expression that finds the
    sample in a file's path (as ``SAMPLE_FOLDER``). Features have an id and, if there are two fields and more, a symbol that is used as the gene; a header is one that begins
    in lower case. Comment lines are skipped, and the line of sizes, which is the first of its file that is no comment.
    Genes that a sample lacks are zeros, as they are in long form.
    """
    own = F.regexp_extract("file", folder, 1) if folder else F.lit(sample or "")
    split = lambda c: F.split(F.trim(c), r"\s+")
    rows = spark.read.text(matrix).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    rows = rows.where(~F.col("value").startswith("%"))
    sizes = rows.groupBy("file").agg(F.min(F.struct("at", "id")).alias("first")).select("file", F.col("first.id").alias("size_id"))  # one row for each file
    rows = rows.join(sizes, "file").where((F.col("id") != F.col("size_id")) & (F.trim("value") != ""))
    parts = split("value")
    triplets = rows.select(own.alias("sample"), parts[0].cast("bigint").alias("g"), parts[1].cast("bigint").alias("c"), parts[2].try_cast("float").alias("value"))
    fields = F.split("value", "\t")
    genes = numbered_lines(spark, features).where("value <> ''").select(own.alias("sample"), "n", fields.alias("f"))
    header = genes.where("n = 1").select("sample", F.coalesce(F.col("f")[0].rlike("^[a-z]"), F.lit(False)).cast("int").alias("shift"))
    genes = genes.join(header, "sample").where(F.col("n") > F.col("shift"))
    genes = genes.select("sample", (F.col("n") - F.col("shift")).alias("g"), F.coalesce(F.get("f", F.lit(1)), F.col("f")[0]).alias("gene_id"))
    cells = numbered_lines(spark, barcodes).select(own.alias("sample"), F.col("n").alias("c"), fields[0].alias("cell_id"))
    out = triplets.join(genes, ["sample", "g"]).join(cells, ["sample", "c"]).select("cell_id", "gene_id", "value", "sample")
    if folder:
        return out
    return out.withColumn("cell_id", F.concat_ws("_", "sample", "cell_id")) if sample else out.drop("sample")


def concat(parts: list[DataFrame]) -> DataFrame:
    """Samples one under the other; genes that a sample lacks are zeros as they are in long form."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _long(wide: DataFrame, key: str, names: list[str], other: str) -> DataFrame:
    quoted = [F.col(f"`{n}`").cast("string").alias(n) for n in names]
    text = wide.select(key, *quoted).unpivot([key], names, other, "__text")
    number: Column = F.coalesce(F.col("__text").try_cast("float"), F.lit(MISSING).cast("float"))
    return text.withColumn("value", number).drop("__text").where((F.col("value") != 0) | F.isnan("value"))


def read_table(spark: SparkSession, path: str, sep: str = ",", decimal: str = ".") -> DataFrame:
    """A table of genes by cells; fields that are no number are NaN and exact zeros are dropped."""
    wide = spark.read.csv(path, header=True, sep=sep)
    gene, cells = wide.columns[0], wide.columns[1:]
    if decimal != ".":
        wide = wide.withColumns({c: F.replace(F.col(f"`{c}`"), F.lit(decimal), F.lit(".")) for c in cells})
    return _long(wide.withColumnRenamed(gene, "gene_id"), "gene_id", cells, "cell_id").select("cell_id", "gene_id", "value")


def read_cells_by_genes(spark: SparkSession, paths: list[str], meta: list[str], sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Tables of metadata and gene columns, aligned by name; ``(obs, x)``. Genes that a file lacks are NaN there, in ``x`` as rows.

    A barcode that comes again gets its number as a suffix.
    """
    at = F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    read = lambda i, p: spark.read.csv(p, header=True, sep=sep).select("*", F.struct(F.lit(i).alias("file"), at.alias("at")).alias("__at"))
    wide = concat([read(i, p) for i, p in enumerate(paths)])
    key = meta[0]
    again = F.row_number().over(Window.partitionBy(key).orderBy("__at")) - 1
    wide = checkpoint(wide.withColumn("__again", again).drop("__at"))  # numbered once, for both results
    wide = wide.withColumn("cell_id", F.when(F.col("__again") > 0, F.concat_ws("_", key, F.col("__again").cast("string"))).otherwise(F.col(key)))
    genes = [c for c in wide.columns if c not in {*meta, "__again", "cell_id"}]
    return wide.select("cell_id", *meta), _long(wide, "cell_id", genes, "gene_id").select("cell_id", "gene_id", "value")


def metadata_boundary(spark: SparkSession, path: str, sep: str = ",", rows: int = 100) -> list[str]:
    """The columns before the first that looks like expression, judged by the first ``rows`` rows, which is the feature."""
    head = spark.read.csv(path, header=True, sep=sep).limit(rows)
    columns = head.columns
    number = {c: F.col(f"`{c}`").try_cast("double") for c in columns}
    facts = head.agg(*[
        F.struct(
            F.avg(number[c].isNotNull().cast("double")).alias("numeric"), F.avg((number[c] == 0).cast("double")).alias("zero"),
            F.min(F.coalesce(number[c] == F.floor(number[c]), F.lit(False))).alias("whole"), (F.max(number[c]) - F.min(number[c])).alias("range"),
            (F.countDistinct(F.col(f"`{c}`")) / F.count(F.lit(1))).alias("unique"),
        ).alias(f"f{i}") for i, c in enumerate(columns)
    ]).first()
    for i, _ in enumerate(columns):
        f = facts[f"f{i}"]
        if f["numeric"] is None or f["numeric"] < 0.5:
            continue
        if (f["zero"] or 0) > 0.8 or not (f["whole"] and (f["range"] or 0) < 50 or f["unique"] < 0.5):
            if not 1 <= i < len(columns) - 2:
                break
            return columns[:i]
    raise ValueError("no boundary between metadata and expression columns")


def read_fragments(spark: SparkSession, path: str, barcodes: DataFrame | None = None) -> DataFrame:
    """``chrom, start, end, cell_id, n`` of a fragments file, of the cells in ``barcodes`` if given."""
    out = spark.read.csv(path, sep="\t", comment="#", schema="chrom string, start bigint, end bigint, cell_id string, n int")
    return out if barcodes is None else out.join(barcodes.select("cell_id"), "cell_id", "left_semi").select(*out.columns)


def read_spots(spark: SparkSession, counts: str, metadata: str) -> tuple[DataFrame, DataFrame]:
    """A counts table of genes by spots and its metadata with ``pixel_x, pixel_y``; ``(x, obs)``."""
    obs = spark.read.csv(metadata, header=True, inferSchema=False)
    obs = obs.withColumnRenamed(obs.columns[0], "cell_id")
    obs = obs.withColumn("spatial", F.array(F.col("pixel_x").try_cast("double"), F.col("pixel_y").try_cast("double")))
    return read_table(spark, counts), obs


def read_samples(spark: SparkSession, counts: str, metadata: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Bulk counts of genes by samples and the samples' metadata, joined by the sample and not by position."""
    x = read_table(spark, counts, sep).select(F.col("cell_id").alias("sample"), F.col("gene_id").alias("gene"), "value")
    obs = spark.read.csv(metadata, header=True, sep=sep)
    obs = obs.withColumnRenamed(obs.columns[0], "sample")
    return x, x.select("sample").distinct().join(obs, "sample", "left")


def read_markers(spark: SparkSession, path: str, top: int, least_logfc: float = 0.0, most_p: float = 0.05) -> DataFrame:
    """The ``top`` markers of each group of a marker file that pass the limits, by score."""
    m = spark.read.csv(path, header=True, schema="`group` string, names string, scores double, logfoldchanges double, pvals double, pvals_adj double")
    order = Window.partitionBy("group").orderBy(F.desc("scores"), "names")
    kept = m.where((F.col("pvals_adj") < most_p) & (F.col("logfoldchanges") > least_logfc))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def write_matrix(x: DataFrame, path: str, cells: DataFrame | None = None, codec: str = "zstd") -> None:
    """Write a matrix, of kept cells only if given, in one pass; a failed write leaves no table behind."""
    out = x if cells is None else x.join(cells.select("cell_id"), "cell_id", "left_semi")
    out.write.mode("overwrite").option("compression", codec).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
