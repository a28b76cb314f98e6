"""Readers and writers of sequencing files, sample sheets and stage tables."""

from __future__ import annotations

import configparser
import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.functions.seq import label_of, natural_key
from spindrift.sources.excel import read_sheet
from spindrift.sources.fastq import fastq_pairs

STAGES = {
    "reads": "sequence string, source string",
    "aggregated": "sequence string, source string, read_count long",
    "filtered": "source string, read_count long, vbc_read string, spikeseq string, libtag string, umi string, ssi string",
    "readtable": "source string, read_count long, vbc_read string, libtag string, umi string, rtprimer string, label string, site string, type string, brain string, region string, ourtube string",
    "collapsed": "source string, read_count long, vbc_read string, libtag string, umi string, rtprimer string, label string, site string, type string, brain string, region string, ourtube string, vbc_read_orig string",
    "vbctable": "vbc_read string, label string, type string, umi_count long, read_count long, brain string, region string, site string, ourtube string",
}
#: Missing values of these columns are empty strings, not nulls.
CATEGORIES = ("brain", "region", "ourtube")
#: Sample sheet headers and the columns they become.
SHEET = {
    "Tube # by user": "usertube", "Our Tube #": "ourtube", "Sample names provided by user": "samplename", "Site information": "siteinfo", "RT primers for MAPseq": "rtprimer",
    "Brain": "brain", "Region": "region", "Matrix Column": "matrixcolumn", "Spike-in Ratio": "si_ratio", "Read Count Minimum": "min_reads",
}


def read_fastq_pairs(spark: SparkSession, pairs: list[tuple[str, str]], r1=(0, 32), r2=(0, 20), source_regex: str = r"([^/_.]+)[^/]*$", concat: bool = True, number: bool = False) -> DataFrame:
    """(sequence, source) of paired FASTQ files, record by record; see :mod:`spindrift.sources.fastq`.

    A pair whose files differ in their number of records raises an error.  With
    ``concat=False`` the two slices are rows of their own.  ``number`` adds pair_id, the
    pair's place in ``pairs``.
    """
    rows = fastq_pairs(spark, pairs, r1, r2)
    named = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pairs)], "pair_id int, path string")
    out = rows.join(F.broadcast(named.select("pair_id", F.regexp_extract("path", source_regex, 1).alias("source"))), "pair_id")  # one row a pair
    more = ["pair_id"] if number else []
    if concat:
        return out.select(F.concat("s1", "s2").alias("sequence"), "source", *more)
    return out.select(F.explode(F.array("s1", "s2")).alias("sequence"), "source", *more)


def write_fastq_pairs(df: DataFrame, folder: str, r1=(0, 32), r2=(32, 52), column: str = "sequence") -> None:
    """Slices of a column as FASTQ text under ``<folder>/R1`` and ``<folder>/R2``, a part of each for every part of ``df``.

    ``df`` reads a written table, so that both writes go through the rows in one order.
    """
    for side, (a, b) in (("R1", r1), ("R2", r2)):
        seq = F.substring(column, a + 1, b - a)
        record = F.concat_ws("\n", F.concat(F.lit("@"), F.lit(side)), seq, F.lit("+"), F.repeat(F.lit("I"), F.length(seq)))
        df.where(F.col(column).isNotNull()).select(record.alias("value")).write.mode("overwrite").text(f"{folder}/{side}")


def read_table(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """A stage table from Parquet or TSV (by suffix) with that stage's types; extra columns stay."""
    tsv = path.rstrip("/").endswith((".tsv", ".tsv.gz"))
    df = spark.read.csv(path, sep="\t", header=True) if tsv else spark.read.parquet(path)
    for f in spark.createDataFrame([], STAGES[stage]).schema:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
            df = df.withColumn(f.name, F.coalesce(c, F.lit("")) if f.name in CATEGORIES else c)
    return df


def write_table(df: DataFrame, path: str, formats=("parquet",), partition_by: list[str] | None = None) -> None:
    """Write ``path``.parquet and/or ``path``.tsv."""
    for kind in formats:
        w = df.write.mode("overwrite")
        w = w.partitionBy(*partition_by) if partition_by else w
        w.csv(f"{path}.tsv", sep="\t", header=True) if kind == "tsv" else w.parquet(f"{path}.parquet")


def write_fasta(df: DataFrame, path: str, sequence: str = "sequence", name: str | None = None) -> None:
    """One record a row, named by a column or by the sequence."""
    df.select(F.concat(F.lit(">"), F.col(name or sequence).cast("string"), F.lit("\n"), F.col(sequence)).alias("value")).write.mode("overwrite").text(path)


def read_fasta(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """Sequence lines of a one-line-per-record FASTA; with ``head`` also the rest as ``tail``."""
    s = spark.read.text(path).where(~F.col("value").startswith(">") & (F.col("value") != "")).select(F.col("value").alias("sequence"))
    return s if head is None else s.select(F.substring("sequence", 1, head).alias("sequence"), F.substring("sequence", head + 1, 1 << 20).alias("tail"))


def read_sam(spark: SparkSession, path: str, max_distance: int = 3, ignore_self: bool = True) -> DataFrame:
    """(a, b, distance) from alignments: query, reference and the NM tag, 1..max_distance."""
    p = F.split("value", "\t")
    tags = F.slice(p, F.lit(12), F.greatest(F.size(p) - 11, F.lit(0)))
    nm = F.get(F.filter(tags, lambda t: t.startswith("NM:i:")), 0)
    out = spark.read.text(path).where(~F.col("value").rlike(r"^@(HD|SQ|PG|RG|CO)\t") & (F.size(p) >= 11)).select(F.get(p, 0).alias("a"), F.get(p, 2).alias("b"), F.substring(nm, 6, 9).try_cast("int").alias("distance"))
    return out.where((F.col("distance") <= max_distance) & (F.col("distance") > (0 if ignore_self else -1)))


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(label, ssi, rtprimer) of a whitespace-separated two-column file without header; SSI<n> becomes BC<n>."""
    p = F.split(F.trim("value"), r"\s+")
    out = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.regexp_replace(F.get(p, 0), "^SSI", "BC").alias("label"), F.get(p, 1).alias("ssi"))
    return out.withColumn("rtprimer", F.regexp_replace("label", "^BC", ""))


def read_samples(spark: SparkSession, path: str, target_min: int = 2, injection_min: int = 2) -> DataFrame:
    """Sample sheet under its sheet headers or plain names, with defaults; rows without a primer go.

    A TSV, or a workbook whose sheet "Sample information" has its header in row 2.
    """
    df = read_sheet(spark, path, "Sample information", 2) if path.endswith(".xlsx") else spark.read.csv(path, sep="\t", header=True)
    df = df.toDF(*[SHEET.get(c.strip(), c.strip()) for c in df.columns])
    df = df.withColumns({c: F.trim(F.col(c)) if c in df.columns else F.lit(None).cast("string") for c in SHEET.values()}).where(F.coalesce("rtprimer", F.lit("")) != "")
    least = F.when(F.col("siteinfo").startswith("target"), target_min).when(F.col("siteinfo").startswith("injection"), injection_min).otherwise(1)
    filled = {"samplename": F.coalesce("samplename", "rtprimer"), "brain": F.coalesce("brain", F.lit("")), "region": F.coalesce("region", F.lit("")), "si_ratio": F.coalesce(F.col("si_ratio").try_cast("double"), F.lit(1.0)), "min_reads": F.coalesce(F.col("min_reads").try_cast("double").cast("int"), least)}
    return df.withColumns(filled).withColumn("label", label_of(F.col("rtprimer"))).select(*SHEET.values(), "label")


def read_barseq(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """In-situ barcodes: digit-coded base columns joined into vbc_read."""
    from spindrift.functions.seq import digits_to_bases

    return spark.read.csv(path, header=True).withColumn("vbc_read", digits_to_bases(columns))


def load_config(path: str) -> dict[str, dict[str, str]]:
    """Sections and lower-cased keys of an INI file."""
    cp = configparser.ConfigParser()
    with open(path) as f:
        cp.read_file(f)
    return {s: dict(cp[s]) for s in cp.sections()}


def merge_stats(trees: list[dict]) -> dict:
    """One tree of several; the same leaf with two values is an error."""
    out: dict = {}
    for t in trees:
        for k, v in t.items():
            if isinstance(v, dict) and isinstance(out.get(k, {}), dict):
                out[k] = merge_stats([out.get(k, {}), v])
            elif k in out and out[k] != v:
                raise ValueError(f"conflicting values for {k}: {json.dumps(out[k])}, {json.dumps(v)}")
            else:
                out[k] = v
    return out


#: The columns of both aligners' tables, and the tags of the optional ones.
BOWTIE1 = ("name_read", "strand", "name_align", "offset", "seq", "quals", "ceil", "mm_desc")
BOWTIE2 = ("name_read", "flagsum", "name_align", "offset", "qual", "cigar", "mate", "mate_offset", "fraglen", "seq", "quals")
BOWTIE2_TAGS = {"score": "AS", "next": "XS", "n_amb": "XN", "n_mismatch": "XM", "n_gap": "XO", "n_gapext": "XG", "distance": "NM", "md": "MD", "yt": "YT"}
BOWTIE2_NUMBERS = ("flagsum", "offset", "qual", "mate_offset", "fraglen", "score", "n_amb", "n_mismatch", "n_gap", "n_gapext", "distance")
#: Headers of a qPCR amplification sheet.
AMPLIFICATION = {"Well": "well", "Well Position": "well_pos", "Cycle": "cycle", "Target Name": "target", "Rn": "rn", "Delta Rn": "rn_delta"}


def read_fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence) of a FASTA whose sequences may run over several lines; one row a record, split at ``>`` after a line's end."""
    raw = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(raw, r"^([^\r\n]*)", 1)
    return spark.read.text(path, lineSep="\n>").where(F.trim(raw) != "").select(F.trim(head).alias("name"), F.regexp_replace(F.substr(raw, F.length(head) + 1), r"\s", "").alias("sequence"))


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """SAM records: the eleven fields, the known tags as columns and all tags as a map; numbers that are none are null."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").rlike(r"^@(HD|SQ|PG|RG|CO)\t") & (F.size(p) >= len(BOWTIE2)))
    tags = F.slice(p, F.lit(12), F.greatest(F.size(p) - 11, F.lit(0)))
    entries = F.transform(F.filter(tags, lambda t: t.rlike("^[^:]+:[^:]:")), lambda t: F.struct(F.substring_index(t, ":", 1).alias("k"), F.regexp_replace(t, "^[^:]+:[^:]:", "").alias("v")))
    first = F.filter(entries, lambda e, i: F.get(F.transform(entries, lambda x: x["k"]), i).isNotNull() & (F.array_position(F.transform(entries, lambda x: x["k"]), e["k"]) == i + 1))
    out = rows.select(*[F.trim(F.get(p, i)).alias(c) for i, c in enumerate(BOWTIE2)], F.map_from_entries(first).alias("tags"))
    out = out.withColumns({c: F.try_element_at("tags", F.lit(t)) for c, t in BOWTIE2_TAGS.items()})
    return out.withColumns({c: F.col(c).try_cast("long") for c in BOWTIE2_NUMBERS})


def read_bowtie1(spark: SparkSession, path: str) -> DataFrame:
    """The older aligner's table, which has no header."""
    return spark.read.csv(path, sep="\t", quote="", schema=", ".join(f"{c} {'long' if c in ('offset', 'ceil') else 'string'}" for c in BOWTIE1))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(item): the lines of a list, trimmed, without empty ones and comments."""
    item = F.trim("value")
    return spark.read.text(path).select(item.alias("item")).where((F.col("item") != "") & ~F.col("item").startswith("#"))


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """(items): one list a line, of strings in double or single quotes; read as data, never evaluated."""
    return spark.read.text(path).select(F.from_json(F.trim("value"), "array<string>", {"allowSingleQuotes": "true"}).alias("items")).where("items is not null")


def read_amplification(spark: SparkSession, path: str) -> DataFrame:
    """A qPCR amplification sheet: well_id is the well's position; rows without a cycle go.

    A TSV, or a workbook whose sheet "Amplification Data" has its header in the first row that reaches column 4.
    """
    df = read_sheet(spark, path, "Amplification Data", None, 4) if path.endswith(".xlsx") else spark.read.csv(path, sep="\t", header=True)
    df = df.toDF(*[AMPLIFICATION.get(c.strip(), c.strip()) for c in df.columns])
    return df.withColumns({"cycle": F.col("cycle").try_cast("int"), "rn": F.col("rn").try_cast("double"), "rn_delta": F.col("rn_delta").try_cast("double"), "well_id": F.col("well_pos")}).where("cycle is not null")


def read_matrix(spark: SparkSession, path: str, brain: str) -> DataFrame:
    """A wide matrix TSV, barcodes in its first column, as (brain, vbc_read, label, value); zeros are left out."""
    df = spark.read.csv(path, sep="\t", header=True)
    first, *labels = df.columns
    wide = df.select(F.col(first).alias("vbc_read"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in labels])
    return wide.unpivot(["vbc_read"], labels, "label", "value").where("value <> 0").select(F.lit(brain).alias("brain"), "vbc_read", "label", "value")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop's objects: the same places that Spark's readers and writers see."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a written folder, in order, as URIs."""
    fs, at = hadoop_path(spark, folder)
    found = [x.getPath().toUri().toString() for x in fs.listStatus(at) if x.getPath().getName().startswith("part-")]
    return sorted("file://" + x.removeprefix("file:") if x.startswith("file:/") and not x.startswith("file://") else x for x in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written by the driver."""
    fs, at = hadoop_path(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, at = hadoop_path(spark, path)
    return spark.read.text(path, wholetext=True).first()[0] if fs.exists(at) else None


def matrix_rows(matrices: dict[str, DataFrame], kinds=(("real", "rbcm"), ("spike", "sbcm"), ("normalized", "nbcm"))) -> DataFrame:
    """(brain, kind, vbc_read, cells) of long matrices: one row a barcode, a map with at most one value a sample."""
    parts = [matrices[k].select("brain", F.lit(suffix).alias("kind"), "vbc_read", "label", "value") for k, suffix in kinds]
    long = parts[0]
    for x in parts[1:]:
        long = long.unionByName(x)
    return long.groupBy("brain", "kind", "vbc_read").agg(F.map_from_entries(F.collect_list(F.struct("label", "value"))).alias("cells"))


def _with_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, at, value): the lines in their order, each name's first one after its header."""
    last, at = None, 0
    for b in batches:
        rows = []
        for name, header, line in zip(*(b.column(i).to_pylist() for i in range(3))):
            if name != last:
                rows.append((name, at, header))
                last, at = name, at + 1
            rows.append((name, at, line))
            at += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], names=["name", "at", "value"])


def write_matrices(rows: DataFrame, folder: str) -> list[str]:
    """``<folder>/<brain>.<kind>.tsv`` for every brain and kind of :func:`matrix_rows`, written in one job.

    Each matrix has its own labels as columns, in natural order, 0 where a barcode has
    no value; every part file starts with the header.  A matrix of any size is spread
    over ranges of its barcodes.  All matrices are written beside the folder's own and
    take their names at the end; a matrix that stood there goes.
    """
    spark = rows.sparkSession
    cells = rows.select("brain", "kind", F.explode(F.map_keys("cells")).alias("label")).distinct()
    labels = cells.groupBy("brain", "kind").agg(F.array_sort(F.collect_list(F.struct(natural_key(F.col("label")).alias("k"), "label"))).getField("label").alias("labels"))  # one label a sample
    wide = rows.join(F.broadcast(labels), ["brain", "kind"])
    line = F.concat_ws("\t", F.array(F.col("vbc_read")), F.transform("labels", lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(0.0)).cast("string")))
    lines = wide.select(F.concat_ws(".", "brain", "kind").alias("name"), F.concat_ws("\t", F.array(F.lit("vbc_read")), F.col("labels")).alias("header"), line.alias("line"), "vbc_read")
    dealt = lines.repartitionByRange("name", "vbc_read").sortWithinPartitions("name", "vbc_read").select("name", "header", "line")
    text = dealt.mapInArrow(_with_headers, "name string, at long, value string").sortWithinPartitions("name", "at")
    fresh = f"{folder}/_new"
    text.select("name", "value").write.mode("overwrite").partitionBy("name").text(fresh)
    fs, at = hadoop_path(spark, fresh)
    paths = []
    for x in fs.listStatus(at):  # a folder a matrix: the sheet's brains times kinds
        if x.isDirectory() and x.getPath().getName().startswith("name="):
            path = f"{folder}/{unquote(x.getPath().getName().removeprefix('name='))}.tsv"
            _, to = hadoop_path(spark, path)
            fs.delete(to, True)
            fs.rename(x.getPath(), to)
            paths.append(path)
    fs.delete(at, True)
    return sorted(paths)


def write_frames(frames: dict[str, DataFrame], folder: str) -> None:
    """Reject tables and report sheets: one TSV folder each."""
    for name, df in frames.items():
        df.write.mode("overwrite").csv(f"{folder}/{name}.tsv", sep="\t", header=True)


def write_demultiplexed(df: DataFrame, folder: str, unmatched: str = "unmatched") -> None:
    """FASTA text by label: ``<folder>/label=<label>/``."""
    rows = df.select(F.coalesce("label", F.lit(unmatched)).alias("label"), F.concat(F.lit(">"), "sequence", F.lit("\n"), "sequence").alias("value"))
    rows.write.mode("overwrite").partitionBy("label").text(folder)


def upsert(df: DataFrame, path: str) -> DataFrame:
    """Add rows to a Parquet table as text, each distinct row once and nulls as empty; columns that either side lacks are empty.

    The new table is written beside the old one and takes its name at the end.
    """
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    here, fresh, past = fs_path(path), fs_path(f"{path}.new"), fs_path(f"{path}.old")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(here) and fs.exists(past):  # a run that ended between the two renames
        fs.rename(past, here)
    as_text = lambda x: x.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in x.columns])
    rows = as_text(df)
    if fs.exists(here):
        rows = as_text(spark.read.parquet(path)).unionByName(rows, allowMissingColumns=True)
    rows.na.fill("").distinct().write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(here):
        fs.delete(past, True)
        fs.rename(here, past)
    fs.rename(fresh, here)
    fs.delete(past, True)
    return spark.read.parquet(path)


def add_stat(tree: dict, path: str, key: str, value) -> dict:
    """Set ``key`` under a path such as /a/b, whose parts are made as needed."""
    node = tree
    for part in filter(None, path.split("/")):
        node = node.setdefault(part, {})
    node[key] = value
    return tree


def render_report(template: str, stats: dict, conf: dict) -> str:
    """A Markdown template with ``{{ stats.a.b }}`` and ``{{ conf.section.key }}`` filled in; what is missing is empty."""
    import re

    def fill(m: re.Match) -> str:
        node = {"stats": stats, "conf": conf}
        for part in re.findall(r"[^.\[\]'\"\s]+", m.group(1)):
            node = node.get(part, "") if isinstance(node, dict) else ""
        return str(node)

    return re.sub(r"\{\{\s*(.*?)\s*\}\}", fill, template)


def pair_files(paths: list[str]) -> list[tuple[str, str]]:
    """Consecutive files as pairs; an odd number is an error."""
    if len(paths) % 2:
        raise ValueError("FASTQ files come in pairs")
    return list(zip(paths[::2], paths[1::2]))
