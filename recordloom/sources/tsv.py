"""Tab-separated files: discovery, ZIP archives, reading all columns as text, and writing without changing a byte of it."""

from __future__ import annotations

import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
SPLITS = ("train", "test")
FILES = tuple(f"{s}_source{n}.tsv" for s in SPLITS for n in (1, 2, 3)) + ("train_ground_truth.tsv",)


_CSV = {"sep": "\t", "quote": '"', "escape": '"', "header": True}


def _line_by_line(spark: SparkSession, path: str) -> bool:
    """Whether each line is a row: no field that a quote opens goes on in the next line, and lines end with line feeds alone."""
    return spark.read.option("lineSep", "\n").text(path).where("contains(value, '\r') or (length(value) - length(replace(value, '\"', ''))) % 2 = 1").isEmpty()


def read(spark: SparkSession, path: str, columns: list[str], select: list[str] | None = None) -> DataFrame:
    """Every column a string, empty for missing; "NA" is text. Quotes are doubled, fields may hold line ends; columns go by the header.

    Files in which each line is a row (one scan tells) are split among tasks; others are read a file a task."""
    how = _CSV | ({"lineSep": "\n"} if _line_by_line(spark, path) else {"multiLine": True})
    header = [h.lstrip("\ufeff") for h in spark.read.options(**how).csv(path).columns]
    absent = [c for c in select or columns if c not in header]
    if absent:
        raise ValueError(f"{path} lacks {absent}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(schema).options(**how, enforceSchema=True).csv(path).select(select or columns).na.fill("")


def write(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """A folder of files with headers; refuses to overwrite. order: sorted by these; single: one file (after a global sort)."""
    df = df.orderBy(*order) if order else df
    df = df.coalesce(1) if single else df
    df.write.mode("errorifexists").options(sep="\t", header=True, emptyValue="", nullValue="", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def _fs(spark: SparkSession, path: str):
    """The file system that the path lies in, and the path in its terms."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def replace(df: DataFrame, path: str, **options) -> None:
    """Write beside `path` and then swap by renaming, so that a reader sees the old result or the new one."""
    spark = df.sparkSession
    new, old = f"{path}.tmp", f"{path}.old"
    for p in (new, old):
        delete(spark, p)
    write(df, new, **options)
    fs, to = _fs(spark, path)
    for a, b in ([(path, old)] if fs.exists(to) else []) + [(new, path)]:
        if not fs.rename(_fs(spark, a)[1], _fs(spark, b)[1]):
            raise OSError(f"can't rename {a} to {b}")
    delete(spark, old)


def _files(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Each file below root, with its bytes."""
    fs, p = _fs(spark, root)
    out, at = [], fs.listFiles(p, True)
    while at.hasNext():
        f = at.next()
        out.append((f.getPath().toString(), f.getLen()))
    return out


def find(spark: SparkSession, root: str) -> list[str]:
    """TSV files under root (or its dataset folder) in a folder train or test, sorted; files that begin with ._ are skipped."""
    root = f"{root}/dataset" if exists(spark, f"{root}/dataset") else root
    fs, p = _fs(spark, root)
    top = fs.makeQualified(p).toString().rstrip("/")
    found = [f[len(top) + 1 :] for f, _ in _files(spark, root) if f.endswith(".tsv") and not f.rpartition("/")[2].startswith("._")]
    return sorted(f"{root.rstrip('/')}/{f}" for f in found if f.split("/")[0] in SPLITS)


def unzip(spark: SparkSession, archive: str, staging: str) -> list[str]:
    """The known files of a ZIP archive, at .../dataset/<split>/<file>, unpacked to a staging folder that all executors read. The driver reads
    the archive, one file at a time."""
    out = []
    with tempfile.TemporaryDirectory(prefix="recordloom-") as own:
        (fs, p), local = _fs(spark, archive), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{own}/archive")
        fs.copyToLocalFile(False, p, local, True)
        with zipfile.ZipFile(f"{own}/archive") as z:
            for name in sorted(z.namelist()):
                parts = name.split("/")
                if "__MACOSX" in parts or parts[-1].startswith("._") or parts[-1] not in FILES or len(parts) < 3 or parts[-3] != "dataset" or parts[-2] not in SPLITS:
                    continue
                with z.open(name) as a, open(f"{own}/one", "wb") as b:
                    shutil.copyfileobj(a, b)
                to = f"{staging}/{parts[-2]}/{parts[-1]}"
                fs, p = _fs(spark, to)
                fs.copyFromLocalFile(True, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{own}/one"), p)
                out.append(to)
    return out


def cleaned_name(path: str) -> str:
    """<split>/<stem>_cleaned.tsv"""
    split, name = path.split("/")[-2:]
    return f"{split}/{name.removesuffix('.tsv')}_cleaned.tsv"


def preview(df: DataFrame, n: int = 5) -> tuple[list[str], list]:
    return df.columns, df.limit(n).collect()


def by_ids(df: DataFrame, wanted: DataFrame, column: str = "entity_id") -> DataFrame:
    """The rows with the wanted ids; an error if one is missing."""
    absent = wanted.select(column).distinct().join(df.select(column), column, "left_anti").limit(5).collect()
    if absent:
        raise ValueError(f"missing ids: {[r[0] for r in absent]}")
    return df.join(wanted.select(column).distinct(), column, "left_semi")


def records(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """The sources' files as one table with a column src."""
    out = None
    for src, path in paths.items():
        one = read(spark, path, RECORD).withColumn("src", F.lit(src))
        out = one if out is None else out.unionByName(one)
    return out


def check_size(spark: SparkSession, path: str, most: int = 512 << 20) -> None:
    if sum(size for f, size in _files(spark, path) if f.rpartition("/")[2].startswith("part-")) > most:
        raise ValueError(f"{path} has more than {most} bytes")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text file; refuses to overwrite."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
