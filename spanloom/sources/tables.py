"""Assembly tables, lists of files and configurations; these are small and read on the driver."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

KINDS = {"fasta": ("fa", "fasta", "fna"), "fastq": ("fq", "fastq", "fnq"), "gfa": ("gfa",)}


def read_assemblies(spark: SparkSession, path: str) -> DataFrame:
    """(name, config, hap_...) as text: columns HAP_x and HAPn are haplotypes, FILTER_x is left out, others raise, and so do null or repeated names."""
    raw = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, sep="," if re.search(r"\.csv(\.gz)?$", path) else "\t")
    columns = {}
    for c in raw.columns:
        low = c.strip().lower()
        if low in ("name", "config"):
            new = low
        elif m := re.fullmatch(r"hap_(.+)", c.strip(), re.I):
            new = f"hap_{m[1]}"
        elif m := re.fullmatch(r"hap([0-9]+)", low):
            new = f"hap_h{m[1]}"
        elif low.startswith("filter_"):
            continue
        else:
            raise ValueError(f"unknown column: {c}")
        if new in columns:
            raise ValueError(f"column {new} is there twice")
        columns[new] = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(new)
    if "name" not in columns or not any(c.startswith("hap_") for c in columns):
        raise ValueError("an assembly table needs a name and a haplotype")
    rows = raw.select(*columns.values())
    bad = rows.groupBy("name").count().where("name is null or count > 1").limit(3).collect()
    if bad:
        raise ValueError(f"null or repeated names: {[r.name for r in bad]}")
    return rows if "config" in columns else rows.withColumn("config", F.lit(None).cast("string"))


def haplotypes(table: DataFrame) -> DataFrame:
    """(name, hap, path) of the haplotypes that an assembly has."""
    names = [c for c in table.columns if c.startswith("hap_")]
    return table.select("name", *names).unpivot("name", names, "hap", "path").where("path is not null").withColumn("hap", F.substring("hap", 5, 1000))


def expand(files: list[str], seen: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(path, kind) of input files, lists of files (.fofn) opened in turn; a list within itself, a missing file and an unknown ending raise."""
    out = []
    for name in files:
        path = os.path.abspath(name)
        if not os.path.isfile(path):
            raise FileNotFoundError(path)
        low = re.sub(r"\.gz$", "", path.lower())
        if low.endswith(".fofn"):
            if path in seen:
                raise ValueError(f"{path} lists itself")
            inner = [x.strip() for x in Path(path).read_text().splitlines()]
            out += expand([x if os.path.isabs(x) else os.path.join(os.path.dirname(path), x) for x in inner if x and not x.startswith("#")], (*seen, path))
        else:
            kind = next((k for k, ends in KINDS.items() if low.endswith(tuple("." + e for e in ends))), None)
            if kind is None:
                raise ValueError(f"{path}: unknown kind of file")
            out.append((path, kind))
    return out


def find(folder: str, names: tuple[str, ...], variable: str | None = None) -> str | None:
    """The path in an environment variable, or the first of the names that is a file in the folder."""
    if variable and os.environ.get(variable):
        return os.environ[variable]
    return next((os.path.join(folder, n) for n in names if os.path.isfile(os.path.join(folder, n))), None)


def find_config(folder: str = ".") -> str | None:
    return find(folder, ("config.json", "config/config.json"))


def find_assemblies(folder: str = ".") -> str | None:
    return find(folder, tuple(f"{d}assemblies.{e}" for d in ("", "config/") for e in ("tsv", "tsv.gz", "csv", "csv.gz", "parquet")))


def model_config(name: str, folders: list[str], depth: int = 5) -> dict:
    """The model.json of a model by name or path; a model may be an alias of another, ``depth`` times at most, and not of itself."""
    seen: list[str] = []
    while True:
        if name in seen or len(seen) > depth:
            raise ValueError(f"aliases go on too long: {' -> '.join([*seen, name])}")
        seen.append(name)
        path = next((p for p in [*(os.path.join(f, name, "model.json") for f in folders), os.path.join(name, "model.json"), name] if os.path.isfile(p)), None)
        if path is None:
            raise FileNotFoundError(f"model {name}")
        config = json.loads(Path(path).read_text())
        if "alias" not in config:
            return config | {"path": os.path.dirname(path)}
        name = config["alias"]


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    """(field, required, type, name, desc) of a table of track fields; disabled ones are left out."""
    rows = spark.read.csv(path, header=True, sep="\t")
    return rows.select("field", (F.upper("required") == "TRUE").alias("required"), "type", "name", "desc").where(~F.col("field").startswith("DISABLED"))


def data_sources(folders: list[dict]) -> list[tuple[str, str, str]]:
    """(folder, assembly, haplotype) of training data: each folder's alignment tables named assembly_haplotype.parquet, by what it includes and excludes."""
    out = []
    for item in folders:
        for path in sorted(Path(item["path"]).glob("*.parquet")):
            assembly, _, hap = path.stem.rpartition("_")
            names = {assembly, f"{assembly}_{hap}"}
            if assembly and (not item.get("include") or names & set(item["include"])) and not names & set(item.get("exclude", ())):
                out.append((str(item["path"]), assembly, hap))
    return out
