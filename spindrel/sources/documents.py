"""Readers of papers and of metadata in plain text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.runtime import strip


def soft_fields(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` of a series' metadata file, in lines of the form ``!key = value``."""
    pair = lambda k: F.trim(F.regexp_extract("value", r"^!([^=]+?)\s*=\s*(.*)$", k))
    return spark.read.text(path).select(pair(1).alias("key"), pair(2).alias("text")).where("key <> ''")


def soft_samples(spark: SparkSession, path: str) -> DataFrame:
    """``sample, key, value`` of the sample blocks; each begins with ``^SAMPLE = id``."""
    blocks = spark.read.text(path, wholetext=True).select(F.split("value", r"(?m)^\^SAMPLE\s*=\s*").alias("b"))
    blocks = blocks.where(F.size("b") > 1).select(F.explode(F.slice("b", F.lit(2), F.size("b") - 1)).alias("block"))
    lines = blocks.select(F.trim(F.split("block", "\n")[0]).alias("sample"), F.explode(F.split("block", "\r?\n")).alias("line"))
    pair = lambda k: F.trim(F.regexp_extract("line", r"^!([^=]+?)\s*=\s*(.*)$", k))
    return lines.select("sample", pair(1).alias("key"), pair(2).alias("text")).where("key <> ''")


def superseries(spark: SparkSession, path: str) -> DataFrame:
    """Is a series made of others, and of which."""
    lines = spark.read.text(path).where(F.col("value").contains("SuperSeries of"))
    found = lines.select(F.explode(F.regexp_extract_all("value", F.lit(r"GSE\d+"), F.lit(0))).alias("child"))
    return found.distinct()


def paper_xml(spark: SparkSession, path: str) -> DataFrame:
    """``title, section, text`` of the sections of articles in XML, one file each; a section's text leaves out those nested in it.

    Files that are no well-formed XML have no sections.
    """

    def plain(parts: Iterator[str]) -> str:
        return " ".join(" ".join(parts).split())

    def own(section: ElementTree.Element) -> Iterator[str]:
        yield section.text or ""
        for child in section:
            if child.tag not in ("sec", "title"):
                yield from child.itertext()
            yield child.tail or ""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for x in b["value"]:
                try:
                    root = ElementTree.fromstring(re.sub(r"(?s)<!DOCTYPE.*?>", "", x))
                except ElementTree.ParseError:
                    continue
                head = root.find(".//article-title")
                title = plain(head.itertext()) if head is not None else ""
                for s in root.iter("sec"):
                    name = s.find("title")
                    rows.append((title, plain(name.itertext()) if name is not None else "", plain(own(s))))
            yield pd.DataFrame(rows, columns=["title", "section", "text"])

    return spark.read.text(path, wholetext=True).mapInPandas(read, "title string, section string, text string")


def markdown_sections(text: Column) -> Column:
    """``heading, body`` of each part of a text in Markdown; what comes before the first heading has none."""
    parts = F.split(F.concat(F.lit("\n"), text), r"(?m)^#{1,6}\s+")
    whole = F.transform(parts, lambda p, i: F.struct(
        F.when(i > 0, F.trim(F.regexp_extract(p, r"^[^\n]*", 0))).alias("heading"),
        strip(F.when(i > 0, F.regexp_replace(p, r"^[^\n]*\n?", "")).otherwise(p)).alias("body"),
    ))
    return F.filter(whole, lambda s: s["heading"].isNotNull() | (s["body"] != ""))


def file_links(html: Column) -> Column:
    """Targets of the links in a listing."""
    return F.filter(F.regexp_extract_all(html, F.lit(r'href="([^"?]+)"'), F.lit(1)), lambda h: ~h.startswith("/") & ~h.endswith("/"))
