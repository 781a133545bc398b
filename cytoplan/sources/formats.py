"""Text formats of sequencing pipelines as DataFrames, and the sinks for them.

Binary instrument and viewer formats (HDF5, BAM) are out of scope; Parquet takes their place.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

GTF_COLUMNS = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")


def write_parquet(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """Zstandard Parquet, optionally clustered so that row groups prune on the sort columns."""
    (df.sortWithinPartitions(*sort) if sort else df).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_mex(coo: DataFrame, barcodes: DataFrame, features: DataFrame, path: str) -> None:
    """A Matrix Market directory: triples with one-based indices, and both axes in index order.

    barcodes(barcode, idx) and features(feature, idx, name, feature_type); the header is a file of its own."""
    spark = coo.sparkSession
    size = spark.range(1).crossJoin(features.agg(F.count("*").alias("f"))).crossJoin(barcodes.agg(F.count("*").alias("b"))).crossJoin(coo.agg(F.count("*").alias("n")))
    head = size.select(F.concat(F.lit("%%MatrixMarket matrix coordinate integer general\n"), F.concat_ws(" ", "f", "b", "n")).alias("value"))
    head.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    t = coo.join(F.broadcast(features.select("feature", F.col("idx").alias("fi"))), "feature").join(barcodes.select("barcode", F.col("idx").alias("bi")), "barcode")
    t.select(F.concat_ws(" ", F.col("fi") + 1, F.col("bi") + 1, F.col("umi_count"))).write.mode("overwrite").text(f"{path}/triples")
    features.select("idx", "feature", "name", "feature_type").write.mode("overwrite").option("sep", "\t").csv(f"{path}/features")
    barcodes.select("idx", "barcode").write.mode("overwrite").option("sep", "\t").csv(f"{path}/barcodes")


def read_mex(spark: SparkSession, path: str) -> DataFrame:
    """barcode, feature, umi_count of a directory that write_mex made."""
    t = spark.read.csv(f"{path}/triples", sep=" ", schema="fi long, bi long, umi_count long")
    f = spark.read.csv(f"{path}/features", sep="\t", schema="idx long, feature long, name string, feature_type string")
    b = spark.read.csv(f"{path}/barcodes", sep="\t", schema="idx long, barcode long")
    return t.join(F.broadcast(f), t["fi"] == f["idx"] + 1).join(b, t["bi"] == b["idx"] + 1).select("barcode", "feature", "umi_count")


def read_csv_checked(spark: SparkSession, path: str, schema: str, required: list[str], comment: str = "#") -> DataFrame:
    """A CSV with a header: missing and unknown columns are errors, bad fields fail."""
    want = [f.name for f in T.StructType.fromDDL(schema)]
    first = spark.read.option("comment", comment).option("header", True).csv(path)
    missing = [c for c in required if c not in first.columns]
    unknown = [c for c in first.columns if c not in want]
    if missing or unknown:
        raise ValueError(f"{path}: missing columns {missing}, unknown columns {unknown}")
    kept = T.StructType([f for c in first.columns for f in T.StructType.fromDDL(schema) if f.name == c])
    return spark.read.schema(kept).option("comment", comment).option("header", True).option("mode", "FAILFAST").csv(path)


def concat_csv(parts: list[DataFrame], path: str) -> None:
    """One logical CSV of tables with the same columns; each part file has the header."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    whole.write.mode("overwrite").option("header", True).csv(path)


def parse_gtf(lines: DataFrame, column: str = "value") -> DataFrame:
    """Nine columns and a map of attributes; comments and empty lines are skipped."""
    rows = lines.where(~F.startswith(F.col(column), F.lit("#")) & (F.trim(column) != "")).select(F.split(column, "\t").alias("c"))
    keys = F.regexp_extract_all(F.col("c")[8], F.lit(r'([A-Za-z_]\w*) "?([^";]*)"?'), 1)
    values = F.regexp_extract_all(F.col("c")[8], F.lit(r'([A-Za-z_]\w*) "?([^";]*)"?'), 2)
    pairs = F.map_from_arrays(keys, values)
    named = [F.col("c")[i].alias(n) for i, n in enumerate(GTF_COLUMNS[:8])]
    return rows.select(*named, pairs.alias("properties")).withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


def parse_fasta(text: DataFrame, column: str = "value") -> DataFrame:
    """header, sequence of records read with lineSep '>' (one record a row)."""
    body = F.col(column)
    head = F.substring_index(body, "\n", 1)
    return text.where(F.trim(body) != "").select(head.alias("header"), F.regexp_replace(F.substring(body, F.length(head) + 1, F.length(body)), r"\s", "").alias("sequence"))


def parse_vcf(lines: DataFrame, column: str = "value") -> DataFrame:
    """Single-base variants, one row an alternative."""
    c = F.split(column, "\t")
    rows = lines.where(~F.startswith(F.col(column), F.lit("#"))).select(c[0].alias("chrom"), c[1].cast("long").alias("pos"), c[3].alias("ref"), F.explode(F.split(c[4], ",")).alias("alt"))
    return rows.where((F.length("ref") == 1) & (F.length("alt") == 1))


def bed12(tx: DataFrame) -> DataFrame:
    """tx(chrom, name, strand, exons array<struct<start, end>> sorted) as BED12 lines."""
    lo, hi = F.col("exons")[0]["start"], F.element_at("exons", -1)["end"]
    sizes = F.array_join(F.transform("exons", lambda e: (e["end"] - e["start"]).cast("string")), ",")
    starts = F.array_join(F.transform("exons", lambda e: (e["start"] - lo).cast("string")), ",")
    return tx.select(F.concat_ws("\t", "chrom", lo, hi, "name", F.lit("0"), "strand", lo, hi, F.lit("0"), F.size("exons"), sizes, starts).alias("line"))


def fastq_name(path: Column) -> dict[str, Column]:
    """Sample, lane, read and chunk of a file name such as S_S1_L001_R1_001.fastq.gz."""
    part = lambda i: F.regexp_extract(path, r"([^/]+)_S(\d+)_L(\d+)_([RI]\d)_(\d+)\.fastq(\.gz)?$", i)
    return {"sample": part(1), "sample_number": part(2), "lane": part(3), "read": part(4), "chunk": part(5)}


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(self.options["path"]) if "://" in self.options["path"] else (fs.LocalFileSystem(), self.options["path"])
        info = where.get_file_info(path)
        if info.type == fs.FileType.Directory:
            names = self.options.get("names", r"\.fastq(\.gz)?$")
            found = [f.path for f in where.get_file_info(fs.FileSelector(path)) if re.search(names, f.path)]
        else:
            found = [path]
        return [_File(p) for p in sorted(found)]

    def read(self, partition: _File) -> Iterator[tuple]:
        from pyarrow import fs

        where = fs.FileSystem.from_uri(self.options["path"])[0] if "://" in self.options["path"] else fs.LocalFileSystem()
        with where.open_input_stream(partition.path, compression=None) as raw:
            stream = io.BufferedReader(raw)  # type: ignore[arg-type]
            text = io.TextIOWrapper(gzip.GzipFile(fileobj=stream) if partition.path.endswith(".gz") else stream, "ascii")
            n = 0
            while head := text.readline():
                seq, plus, qual = text.readline().rstrip("\n"), text.readline(), text.readline().rstrip("\n")
                if not head.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
                    raise ValueError(f"{partition.path}: bad record {n}")
                yield (partition.path, n, head[1:].rstrip("\n"), seq, qual)
                n += 1


class FastqSource(DataSource):
    """spark.read.format("fastq").load(folder): a task a file, since gzip streams have no splits."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "file string, record long, header string, seq string, qual string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FastqReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)
