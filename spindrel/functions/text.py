"""Text functions as column expressions: labels, gene names, file names, JSON within prose."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks and their plain ones, of all Latin letters that decompose so.
_LATIN = [chr(c) for a, b in ((0xC0, 0x250), (0x1E00, 0x1F00)) for c in range(a, b)]
_PLAIN = {c: unicodedata.normalize("NFD", c)[0] for c in _LATIN}
ACCENTS = ("".join(c for c, p in _PLAIN.items() if p.isascii()), "".join(p for p in _PLAIN.values() if p.isascii()))

# Fixed values.
RAW_WORDS, NORMALISED_WORDS = ("raw", "count", "umi"), ("tpm", "cpm", "fpkm", "rpkm", "norm", "log")
SPECIES = {"human": ("human", "homo_sapiens", "grch38", "hg38", "hg19"), "mouse": ("mouse", "mus_musculus", "grcm38", "mm10", "mm39"), "zebrafish": ("zebrafish", "danio", "grcz11")}
SUFFIXES = (".gz", ".mtx", ".h5ad", ".h5", ".csv", ".tsv", ".txt", ".bed", ".tar", ".zip", ".loom", ".rds", ".xlsx", ".pdf")


def label_key(c: Column) -> Column:
    """Lower case without accents, all that is no letter or digit made one underscore, none at the ends."""
    plain = F.lower(F.translate(F.regexp_replace(c, r"\p{M}+", ""), *ACCENTS))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def gene_key(c: Column) -> Column:
    """Upper case without the suffix of a positive or negative marker."""
    return F.upper(F.regexp_replace(F.trim(c), "_[pn]$", ""))


def gene_symbol(c: Column) -> Column:
    """Without quotes; of three and more parts between semicolons the last, else the first."""
    parts = F.split(F.regexp_replace(c, "[\"']", ""), ";")
    return F.trim(F.when(F.size(parts) >= 3, F.element_at(parts, -1)).otherwise(parts[0]))


def similarity(a: Column, b: Column) -> Column:
    """One minus the edit distance over the longer length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / F.when(longest > 0, longest))


def json_block(c: Column) -> Column:
    """The JSON in an answer: a fenced block, else the first brace to the last, else brackets, else the text."""
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*([\{\[].*?)\s*```", 1)
    braces = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    brackets = F.regexp_extract(c, r"(?s)\[.*\]", 0)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (fenced, braces, brackets)], c)


def without_suffixes(c: Column) -> Column:
    """A file's name without the known suffixes, however many follow each other."""
    return F.regexp_replace(F.lower(c), "(" + "|".join(s.replace(".", r"\.") for s in SUFFIXES) + ")+$", "")


def file_species(path: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, words in reversed(SPECIES.items()):
        out = F.when(F.lower(path).rlike("|".join(words)), name).otherwise(out)
    return out


def expression_type(path: Column) -> Column:
    p = F.lower(path)
    return F.when(p.rlike("|".join(NORMALISED_WORDS)), "normalised").when(p.rlike("|".join(RAW_WORDS)) | p.rlike(r"\.mtx|\.h5$"), "raw").otherwise("unknown")


def file_format(path: Column) -> Column:
    p = F.lower(path)
    return (
        F.when(p.rlike(r"\.(tar|zip|tgz|7z|rar)(\.gz)?$"), "archive").when(p.rlike(r"fragments?\.(tsv|bed)(\.gz)?$"), "fragments")
        .when(p.rlike(r"\.mtx(\.gz)?$"), "mtx").when(p.rlike(r"\.h5ad$"), "h5ad").when(p.rlike(r"\.h5$"), "h5").when(p.rlike(r"\.(csv|tsv|txt)(\.gz)?$"), "table").otherwise("unsupported")
    )


def interval(c: Column) -> Column:
    """``chrom:start-end`` as a struct; null parts if it is none."""
    part = lambda k: F.nullif(F.regexp_extract(c, r"^([^:]+):(\d+)-(\d+)$", k), F.lit(""))
    return F.struct(part(1).alias("chrom"), part(2).cast("bigint").alias("start"), part(3).cast("bigint").alias("end"))


def accessions(c: Column, kind: str = "GSE") -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(kind + r"\d+"), F.lit(0)))
