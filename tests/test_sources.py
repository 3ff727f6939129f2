import gzip
import math

import pytest
from pyspark.sql import functions as F

from spindrel.functions import text
from spindrel.operators import matrix, spatial
from spindrel.sources import documents, matrix_files


def put(path, content):
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt") as f:
            f.write(content)
    else:
        path.write_text(content)
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("header", ["", "id\tname\n"])
def test_mtx(spark, tmp_path, header):
    m = put(tmp_path / "matrix.mtx.gz", "%%MatrixMarket\n%c\n2 3 3\n1 1 5\n2 3 7\n1 2 1\n")
    b = put(tmp_path / "barcodes.tsv", "AAA-1\nCCC-1\nGGG-1\n")
    f = put(tmp_path / "features.tsv", header + "ENSG1\tTP53\nENSG2\tRHO\n")
    assert rows(matrix_files.read_mtx(spark, m, b, f)) == [("AAA-1", "TP53", 5.0), ("CCC-1", "TP53", 1.0), ("GGG-1", "RHO", 7.0)]
    two = matrix_files.concat([matrix_files.read_mtx(spark, m, b, f, s) for s in ("s1", "s2")])
    assert two.count() == 6 and two.select("cell_id").distinct().count() == 6


def test_mtx_entry_like_the_line_of_sizes(spark, tmp_path):
    m = put(tmp_path / "matrix.mtx", "%%MatrixMarket\n2 3 3\n1 1 5\n2 3 3\n1 2 1\n")
    b, f = put(tmp_path / "b.tsv", "A\nB\nC\n"), put(tmp_path / "f.tsv", "G1\nG2\n")
    assert rows(matrix_files.read_mtx(spark, m, b, f)) == [("A", "G1", 5.0), ("B", "G1", 1.0), ("C", "G2", 3.0)]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    p = put(tmp_path / "long.txt", "".join(("%c" if i % 7 == 3 else f"line {i}") + "\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = {r["n"]: r["value"] for r in matrix_files.numbered_lines(spark, p).collect()}
        kept = {r["n"]: r["value"] for r in matrix_files.numbered_lines(spark, p, "%").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lines = open(p).read().splitlines()
    assert got == dict(enumerate(lines, 1)) and kept == dict(enumerate([x for x in lines if x[0] != "%"], 1))


def test_nested_sections(spark, tmp_path):
    p = put(tmp_path / "n.xml", "<?xml version='1.0' encoding='UTF-8'?><!DOCTYPE a><a><article-title>T</article-title><sec><title>Outer</title><p>one</p><sec><title>Inner</title><p>two</p></sec><p>three</p></sec></a>")
    assert rows(documents.paper_xml(spark, p)) == [("T", "Inner", "two"), ("T", "Outer", "one three")]
    assert documents.paper_xml(spark, put(tmp_path / "bad.xml", "<a><b>")).count() == 0


def test_table(spark, tmp_path):
    p = put(tmp_path / "x.csv", "gene,c1,c2\nA,0,2.5\nB,x,0\n")
    got = rows(matrix_files.read_table(spark, p))
    assert got[0][:2] == ("c1", "B") and math.isnan(got[0][2]) and got[1:] == [("c2", "A", 2.5)]


def test_cells_by_genes(spark, tmp_path):
    a = put(tmp_path / "a.csv", "cell,batch,A,B\nx,b1,1,0\ny,b1,0,2\n")
    b = put(tmp_path / "b.csv", "cell,batch,B,C\nx,b2,3,4\n")
    obs, x = matrix_files.read_cells_by_genes(spark, [a, b], ["cell", "batch"])
    assert rows(obs.select("cell_id", "batch")) == [("x", "b1"), ("x_1", "b2"), ("y", "b1")]
    got = {(c, g): v for c, g, v in rows(x)}
    assert got["x_1", "B"] == 3 and math.isnan(got["x_1", "A"]) and math.isnan(got["x", "C"]) and ("x", "B") not in got


def test_boundary(spark, tmp_path):
    lines = ["cell,batch,plate,G1,G2,G3"] + [f"c{i},b{i % 2},{i % 3},{i * 1.5},{0 if i % 9 else i},{i * 0.7}" for i in range(60)]
    assert matrix_files.metadata_boundary(spark, put(tmp_path / "p.csv", "\n".join(lines))) == ["cell", "batch", "plate"]


def test_fragments_and_samples(spark, tmp_path):
    p = put(tmp_path / "f.tsv", "# c\nchr1\t5\t9\tA\t2\nchr2\t1\t4\tB\t1\n")
    keep = spark.createDataFrame([("A",)], "cell_id string")
    assert rows(matrix_files.read_fragments(spark, p, keep)) == [("chr1", 5, 9, "A", 2)]
    counts = put(tmp_path / "c.csv", "gene,s2,s1\nA,1,2\n")
    meta = put(tmp_path / "m.csv", "sample,condition\ns1,treated\ns2,control\n")
    _, obs = matrix_files.read_samples(spark, counts, meta)
    assert rows(obs) == [("s1", "treated"), ("s2", "control")]


def test_spots_and_markers(spark, tmp_path):
    counts = put(tmp_path / "c.csv", "gene,p1\nA,3\n")
    md = put(tmp_path / "md.csv", ",pixel_x,pixel_y\np1,1.5,2\n")
    x, obs = matrix_files.read_spots(spark, counts, md)
    assert rows(x) == [("p1", "A", 3.0)] and obs.first()["spatial"] == [1.5, 2.0]
    m = put(tmp_path / "m.csv", "group,names,scores,logfoldchanges,pvals,pvals_adj\n1,A,5,1,0,0.01\n1,B,9,1,0,0.2\n1,C,7,1,0,0.01\n1,D,1,1,0,0.01\n")
    assert [r["names"] for r in matrix_files.read_markers(spark, m, 2).orderBy("rank").collect()] == ["C", "A"]


def test_round_trip(spark, tmp_path):
    x = spark.createDataFrame([("a", "g", 1.0), ("b", "g", 2.0)], "cell_id string, gene_id string, value double")
    matrix_files.write_matrix(x, str(tmp_path / "out"), x.where("cell_id = 'a'"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("a", "g", 1.0)]


def test_soft(spark, tmp_path):
    p = put(tmp_path / "s.soft", "^SERIES = GSE1\n!Series_title = T = x\n!Series_relation = SuperSeries of: GSE2\n^SAMPLE = GSM1\n!Sample_title = a\n^SAMPLE = GSM2\n!Sample_title = b\n")
    assert ("Series_title", "T = x") in rows(documents.soft_fields(spark, p))
    assert rows(documents.soft_samples(spark, p)) == [("GSM1", "Sample_title", "a"), ("GSM2", "Sample_title", "b")]
    assert rows(documents.superseries(spark, p)) == [("GSE2",)]


def test_paper(spark, tmp_path):
    p = put(tmp_path / "a.xml", "<?xml version='1.0'?><article><article-title>On <i>x</i></article-title><sec id='1'><title>Methods</title><p>We did.</p></sec><sec><title>Results</title><p>It was.</p></sec></article>")
    assert rows(documents.paper_xml(spark, p)) == [("On x", "Methods", "We did."), ("On x", "Results", "It was.")]
    md = spark.createDataFrame([("intro\n# A\nbody\n## B\n",)], "t string").select(documents.markdown_sections(F.col("t"))).first()[0]
    assert [(s["heading"], s["body"]) for s in md] == [(None, "intro"), ("A", "body"), ("B", "")]


def test_text(spark):
    one = lambda f, *v: spark.createDataFrame([v], ", ".join(f"c{i} string" for i in range(len(v)))).select(f(*[F.col(f"c{i}") for i in range(len(v))])).first()[0]
    assert one(text.json_block, 'so: ```json\n{"a": 1}\n``` end') == '{"a": 1}'
    assert one(text.json_block, 'x {"a": {"b": 2}} y') == '{"a": {"b": 2}}' and one(text.json_block, "none") == "none"
    assert one(text.label_key, " T-Zelle (Rühend)!") == "t_zelle_ruhend" and one(text.gene_key, "rho_p") == "RHO"
    assert one(text.gene_symbol, "'a;b;c'") == "c" and one(text.without_suffixes, "S1.mtx.gz") == "s1"
    assert one(text.similarity, "abc", "abd") == pytest.approx(2 / 3) and one(text.file_species, "x_mm10.csv") == "mouse"
    assert one(text.interval, "chr1:5-9") == ("chr1", 5, 9) and one(text.expression_type, "a_tpm.csv") == "normalised"


def test_nearest_graph_reaches_far(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, 50.0, 0.0)], "id int, px double, py double")
    assert rows(spatial.nearest_graph(p, 1, 0.05).select("src", "dst")) == [(1, 2), (2, 1), (3, 2)]
    assert spatial.nearest_graph(p, 5, 0.05).count() == 6


def test_empty_matrix(spark):
    x = spark.createDataFrame([], "cell_id string, gene_id string, value double")
    assert matrix.normalise(x).count() == 0
    assert matrix.cell_metrics(x, F.lit(False), F.lit(False)).count() == 0
    zero = spark.createDataFrame([("a", "g", 0.0)], "cell_id string, gene_id string, value double")
    m = matrix.cell_metrics(zero, F.lit(False), F.lit(False)).first()
    assert m["pct_mt"] is None and m["complexity"] is None and matrix.normalise(zero).first()["value"] == 0.0
