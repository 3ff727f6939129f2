"""Queries on files: tables are written in a format to the shared folder, read back, and held to SQL on the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.plans.book import Book
from spindrel.runtime import checkpoint, shared_folder, strip, table
from spindrel.sources import documents, matrix_files

BOOK = Book("with ")
queries, oracle_sql = BOOK.queries, BOOK.oracle_sql
query = BOOK.query


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _lines(df: DataFrame, path: str, order: str, by: str | None = None) -> str:
    """Write ``value`` as lines in ``order``: one file or, with ``by``, one for each of its values."""
    if by:
        # Written first, as rows of one group were seen to stay apart when the union itself was repartitioned and written.
        checkpoint(df).repartition(by).sortWithinPartitions(by, order).select(by, "value").write.partitionBy(by).text(path)
    else:
        df.coalesce(1).sortWithinPartitions(order).select("value").write.text(path)
    return path


_MTX = """m as (select dataset_id sample, coalesce(group_label, '-') cell, upper(trim(names)) gene, max(scores) v from marker_gene where dataset_id is not null and names is not null and trim(names) <> '' and not contains(names, chr(9)) and scores is not null and not isnan(scores) and not isinf(scores) group by all)
"""


@query(_MTX + """ select sample, cell cell_id, gene gene_id, v::float::double as "value" from m where v <> 0""")
def matrix_market_samples(spark, d):
    """Scores of the marker table as Matrix-Market files, one folder for each data set, read back at once."""
    m = table(spark, d, "marker_gene").where("dataset_id is not null and names is not null and trim(names) <> '' and not contains(names, '\t') and scores is not null and not isnan(scores)")
    m = m.where(F.abs("scores") != float("inf")).groupBy(F.col("dataset_id").alias("sample"), F.coalesce("group_label", F.lit("-")).alias("cell"), F.upper(F.trim("names")).alias("gene")).agg(F.max("scores").alias("v"))
    number = lambda c: F.dense_rank().over(Window.partitionBy("sample").orderBy(c))
    m = m.where("v <> 0").withColumn("g", number("gene")).withColumn("c", number("cell"))
    root = folder(spark)
    heads = m.groupBy("sample").agg(F.concat_ws(" ", F.max("g"), F.max("c"), F.count(F.lit(1))).alias("value"))
    lines = heads.select("sample", F.lit(-1).alias("o"), F.lit("%%MatrixMarket matrix coordinate real general").alias("value")).unionByName(heads.select("sample", F.lit(0).alias("o"), "value"))
    lines = lines.unionByName(m.select("sample", F.lit(1).alias("o"), F.concat_ws(" ", "g", "c", F.col("v").cast("string")).alias("value")))
    matrix = _lines(lines, f"{root}/matrix", "o", "sample")
    side = lambda name, n, value: _lines(m.select("sample", n, value.alias("value")).distinct(), f"{root}/{name}", n, "sample")
    cells = side("barcodes", "c", F.col("cell"))
    genes = side("features", "g", F.concat_ws("\t", F.concat(F.lit("ID"), F.col("g").cast("string")), "gene"))
    return matrix_files.read_mtx(spark, matrix, cells, genes, folder=matrix_files.SAMPLE_FOLDER).select("sample", "cell_id", "gene_id", F.col("value").cast("double").alias("value"))


@query("""c as (select p_brand gene_id, p_type cell_id, count(*)::float v from part group by all) select cell_id, gene_id, v as "value" from c""")
def gene_table(spark, d):
    """Brands by types of parts as a table of genes by cells."""
    wide = table(spark, d, "part").groupBy(F.col("p_brand").alias("gene")).pivot("p_type").count().na.fill(0)
    path = folder(spark)
    wide.coalesce(1).write.option("header", True).csv(path)
    return matrix_files.read_table(spark, path)


@query("""s as (select n_name, n_regionkey r, c_mktsegment g, count(*)::float v from customer join nation on n_nationkey = c_nationkey group by all), f as (select distinct r < 3 f, g from s where (r < 3 and g <> 'BUILDING') or (r >= 3 and g <> 'MACHINERY')), ns as (select distinct n_name, r from s)
 select ns.n_name cell_id, al.g gene_id, case when f.g is null then null else v end as "value" from ns cross join (select distinct g from f) al left join f on f.f = (ns.r < 3) and f.g = al.g left join s on s.n_name = ns.n_name and s.g = al.g where f.g is null or v is not null""")
def cell_tables(spark, d):
    """Segments by nations in two tables that lack different genes; what a file lacks is not known (null here)."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    root = folder(spark)
    parts = []
    for i, (test, lost) in enumerate((("n_regionkey < 3", "BUILDING"), ("n_regionkey >= 3", "MACHINERY"))):
        wide = c.where(test).groupBy("n_name", "n_regionkey").pivot("c_mktsegment").count().na.fill(0).drop(lost)
        wide.coalesce(1).write.option("header", True).csv(f"{root}/{i}")
        parts.append(f"{root}/{i}")
    _, x = matrix_files.read_cells_by_genes(spark, parts, ["n_name", "n_regionkey"])
    return x.withColumn("value", F.nanvl("value", F.lit(None).cast("float")))


@query("""z as (select 1) select unnest(['s_suppkey', 's_nationkey']) as name""")
def expression_boundary(spark, d):
    """The columns before the measured ones in a table of suppliers."""
    s = table(spark, d, "supplier").orderBy("s_suppkey").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("s_suppkey"), (F.col("s_nationkey") % 7).alias("s_nationkey"), *[(F.col("s_acctbal") / k).alias(f"G{k}") for k in (1, 3, 7, 9)])
    path = folder(spark)
    s.coalesce(1).write.option("header", True).csv(path)
    return spark.createDataFrame([(n,) for n in matrix_files.metadata_boundary(spark, path)], "name string")


@query("""f as (select user_id % 10 chrom, epoch(date_trunc('second', ts))::bigint s, user_id cell, floor("value")::int n from events) select 'chr' || chrom chrom, count(*) n_fragments, sum(s)::bigint starts, sum(n)::bigint n_reads from f where cell % 3 = 0 group by 1""")
def fragment_file(spark, d):
    """Events as a fragments file, read for some barcodes."""
    e = table(spark, d, "events")
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = e.select(F.concat(F.lit("chr"), (F.col("user_id") % 10).cast("string")), start, start + 100, F.col("user_id").cast("string"), F.floor("value").cast("int"))
    path = folder(spark)
    rows.write.option("sep", "\t").csv(path)
    keep = e.where("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("cell_id")).distinct()
    return matrix_files.read_fragments(spark, path, keep).groupBy("chrom").agg(F.count(F.lit(1)).alias("n_fragments"), F.sum("start").alias("starts"), F.sum("n").alias("n_reads"))


@query("""s as (select r_name, n_name from nation join region on r_regionkey = n_regionkey), c as (select n_name, c_mktsegment gene, count(*)::float v from customer join nation on n_nationkey = c_nationkey group by all) select n_name sample, r_name condition, gene, v as "value" from c join s using (n_name)""")
def bulk_tables(spark, d):
    """Counts of genes by samples and the samples' metadata, joined by name."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    root = folder(spark)
    counts = table(spark, d, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy("c_mktsegment").pivot("n_name").count().na.fill(0)
    counts.coalesce(1).write.option("header", True).csv(f"{root}/counts")
    nation.select(F.col("n_name").alias("sample"), F.col("r_name").alias("condition")).coalesce(1).write.option("header", True).csv(f"{root}/meta")
    x, obs = matrix_files.read_samples(spark, f"{root}/counts", f"{root}/meta")
    return x.join(obs, "sample").select("sample", "condition", "gene", "value")


@query("""m as (select group_label, names, scores from marker_gene where group_label is not null and names is not null and not contains(names, '"') and not contains(group_label, '"') and dataset_id = 'FXD000001' and logfoldchanges > 0 and pvals_adj < 0.05 and scores is not null and not isnan(scores))
 select group_label "group", names, round(scores, 4) scores, rank from (select *, row_number() over (partition by group_label order by scores desc, names) as rank from m) where rank <= 5""")
def marker_file(spark, d):
    """The five best markers of each group of a marker file."""
    m = table(spark, d, "marker_gene").where("group_label is not null and names is not null and not contains(names, '\"') and not contains(group_label, '\"') and dataset_id = 'FXD000001' and scores is not null and not isnan(scores)")
    path = folder(spark)
    m.select(F.col("group_label").alias("group"), "names", "scores", "logfoldchanges", "pvals", "pvals_adj").write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return _r(matrix_files.read_markers(spark, path, 5), "scores", digits=4).select("group", "names", "scores", F.col("rank").cast("bigint").alias("rank"))


@query("""s as (select vec_id::varchar spot, embedding[1] x, embedding[2] y from embeddings) select spot cell_id, x::double px, y::double py from s""")
def spot_positions(spark, d):
    """Positions of spots from the metadata of a slide."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("spot"), F.col("embedding")[0].alias("pixel_x"), F.col("embedding")[1].alias("pixel_y"))
    root = folder(spark)
    e.coalesce(1).write.option("header", True).csv(f"{root}/meta")
    table(spark, d, "region").select(F.col("r_name").alias("gene"), F.lit(1).alias("s0")).coalesce(1).write.option("header", True).csv(f"{root}/counts")
    _, obs = matrix_files.read_spots(spark, f"{root}/counts", f"{root}/meta")
    return obs.select("cell_id", *[F.col("spatial")[i].cast("float").cast("double").alias(n) for i, n in enumerate(("px", "py"))])


@query("""e as (select distinct sample_id, trim(label) "label", trim(species) species from sample_entry where sample_id is not null and trim(sample_id) <> '' and "label" is not null and species is not null)
 select trim(sample_id) sample, 'Sample_title' "key", "label" "text" from e union all select trim(sample_id), 'Sample_organism', species from e""")
def soft_sample_fields(spark, d):
    """Fields of the sample blocks of a metadata file."""
    e = table(spark, d, "sample_entry").where("sample_id is not null and trim(sample_id) <> '' and label is not null and species is not null").select("sample_id", F.trim("label").alias("label"), F.trim("species").alias("species")).distinct()
    block = F.concat(F.lit("^SAMPLE = "), F.trim("sample_id"), F.lit("\n!Sample_title = "), "label", F.lit("\n!Sample_organism = "), "species")
    path = _lines(e.select("sample_id", block.alias("value")), folder(spark), "sample_id")
    return documents.soft_samples(spark, path)


@query("""p as (select distinct 'n' || s_nationkey c, 'GSE' || (s_suppkey + 1000) g from supplier) select g child from p""")
def superseries_members(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("!Series_relation = SuperSeries of: GSE"), (F.col("s_suppkey") + 1000).cast("string")).alias("value"))
    return documents.superseries(spark, _lines(s, folder(spark), "s_suppkey"))


@query("""p as (select distinct paper_id, regexp_replace(trim(title), '\\s+', ' ', 'g') t, regexp_replace(trim(journal), '\\s+', ' ', 'g') j from paper_entry where title is not null and journal is not null and paper_id is not null)
 select t title, 'Outer' "section", 'in ' || j || ' end' "text" from p union all select t, 'Inner', t from p""")
def article_sections(spark, d):
    """Sections, one nested in the other, of articles in XML."""
    p = table(spark, d, "paper_entry").where("title is not null and journal is not null and paper_id is not null").select("paper_id", "title", "journal").distinct()
    safe = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit("<article><article-title>"), safe("title"), F.lit("</article-title><sec><title>Outer</title><p>in "), safe("journal"), F.lit("</p><sec><title>Inner</title><p>"), safe("title"), F.lit("</p></sec> end</sec></article>"))
    n = Window.orderBy("paper_id", "title", "journal")
    one = p.select(F.concat(F.lit("a"), F.row_number().over(n).cast("string")).alias("file"), xml.alias("value"))
    path = _lines(one.withColumn("o", F.lit(0)), folder(spark), "o", "file")
    return documents.paper_xml(spark, path).select("title", "section", "text")


@query("""t as (select distinct type_key, display_name from kb_type) select type_key, null::varchar heading, 'intro' body from t union all select type_key, display_name, 'of ' || type_key from t""")
def markdown_sections(spark, d):
    t = table(spark, d, "kb_type").select("type_key", F.concat(F.lit("intro\n# "), "display_name", F.lit("\nof "), "type_key").alias("t")).distinct()
    out = t.select("type_key", F.explode(documents.markdown_sections(F.col("t"))).alias("s"))
    return out.select("type_key", F.col("s.heading").alias("heading"), F.col("s.body").alias("body"))


@query("""p as (select distinct regexp_extract(path, '[^/]*$') f from artifact where path is not null and not contains(path, '?') and not contains(path, '"') and not contains(path, chr(92))) select f link from p where f <> ''""")
def listed_files(spark, d):
    """Files that a listing links to."""
    p = table(spark, d, "artifact").where("path is not null and not contains(path, '?') and not contains(path, '\"') and not contains(path, '\\\\')").select(F.regexp_extract("path", r"[^/]*$", 0).alias("f")).distinct()
    html = F.concat(F.lit('<a href="/up">..</a> <a href="sub/">sub</a> <a href="'), "f", F.lit('">x</a>'))
    return p.where("f <> ''").select(F.explode(documents.file_links(html)).alias("link")).distinct()


@query("""o as (select cell_id, max(n_genes_by_counts) n from obs_annotated where cell_id is not null group by 1) select count(*) n_cells, sum(n)::bigint total from o where n >= 1000""")
def written_matrix(spark, d):
    """A matrix written for kept cells only, and read again."""
    o = table(spark, d, "obs_annotated").where("cell_id is not null").groupBy("cell_id").agg(F.max("n_genes_by_counts").alias("value"))
    path = folder(spark)
    matrix_files.write_matrix(o.withColumn("gene_id", F.lit("g")), path, o.where("value >= 1000"))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_cells"), F.sum("value").alias("total"))


@query("""e as (select distinct lower(trim(sample_id)) s from sample_entry where sample_id is not null) select s sample from e""")
def written_csv(spark, d):
    s = table(spark, d, "sample_entry").where("sample_id is not null").select(F.lower(strip("sample_id")).alias("sample")).distinct()
    path = folder(spark)
    matrix_files.write_csv(s, path)
    return spark.read.csv(path, header=True)
