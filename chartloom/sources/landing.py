"""Reading the landed health-record CSV tables and the terminology files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.sources.paths import require_files, versioned_path
from chartloom.sources.quotedcsv import read_quoted_csv

# Landed tables and their files.
RECORD_FILES = {
    "patients": "patients.csv",
    "encounters": "encounters.csv",
    "conditions": "conditions.csv",
    "procedures": "procedures.csv",
    "medications": "medications.csv",
    "observations": "observations.csv",
}
# Terminology tables and their tab-separated files.
VOCABULARY_FILES = {"concept": "CONCEPT.csv", "concept_relationship": "CONCEPT_RELATIONSHIP.csv"}

# Codes are read as text: inference would drop leading zeros.
CONDITIONS_SCHEMA = "START date, STOP date, PATIENT string, ENCOUNTER string, SYSTEM string, CODE string, DESCRIPTION string"


def read_records_csv(
    spark: SparkSession, path: str, schema: str | None = None, *, multi_line: bool = True
) -> DataFrame:
    """CSV with a header.

    Quoted values may span lines with ``multi_line``. Files are split either way; turn it off for
    tables that are known to have no such values, which are then read once.
    Columns are matched to ``schema`` by header name, whatever their order in the file;
    columns the file lacks are null. Without a schema every column is text.
    """
    if multi_line:
        raw = read_quoted_csv(spark, path)
    else:
        raw = spark.read.csv(path, header=True, escape='"', inferSchema=False)
    if schema is None:
        return raw
    wanted = spark.createDataFrame([], schema).schema
    found = set(raw.columns)
    return raw.selectExpr(
        *[
            f"CAST({f'`{field.name}`' if field.name in found else 'NULL'} AS {field.dataType.simpleString()}) AS `{field.name}`"
            for field in wanted.fields
        ]
    )


def land_tables(
    spark: SparkSession,
    base: str,
    version: str,
    *,
    dataset: str = "synthea",
    files: dict[str, str] | None = None,
    multi_line: tuple[str, ...] | None = None,
    out: str | None = None,
) -> dict[str, DataFrame]:
    """Register every landed table as a view; missing files fail the landing as a whole.

    ``multi_line`` names the tables whose values may span lines, by default all. With ``out`` the tables are
    written there once as parquet, replacing what was there, and the views read that.
    """
    files = files or RECORD_FILES
    require_files(spark, versioned_path(base, dataset, version), files.values())
    tables = {}
    for name, file in files.items():
        path = versioned_path(base, dataset, version, file)
        schema = CONDITIONS_SCHEMA if name == "conditions" else None
        table = read_records_csv(spark, path, schema, multi_line=multi_line is None or name in multi_line)
        if out:
            landed = f"{out.rstrip('/')}/{name}"
            table.write.mode("overwrite").parquet(landed)
            table = spark.read.schema(table.schema).parquet(landed)
        tables[name] = table
        tables[name].createOrReplaceTempView(name)
    return tables


CONCEPT_COLUMNS = {"concept_id": "long"}
RELATIONSHIP_COLUMNS = {"concept_id_1": "long", "concept_id_2": "long"}


def read_vocabulary_tsv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Tab-separated file with a header and no quoting: every byte between tabs is data."""
    raw = spark.read.csv(path, header=True, sep="\t", quote="", inferSchema=False)
    return raw.selectExpr(*[f"CAST(`{c}` AS {types[c]}) AS `{c}`" if c in types else f"`{c}`" for c in raw.columns])


def load_vocabularies(
    spark: SparkSession, folder: str, out: str, *, dry_run: bool = False
) -> dict[str, str]:
    """Replace the terminology tables from their files; returns table name to written path.

    All inputs are checked first. A dry run only reports what would be written.
    """
    require_files(spark, folder, VOCABULARY_FILES.values())
    written = {name: f"{out.rstrip('/')}/{name}" for name in VOCABULARY_FILES}
    if not dry_run:
        for name, file in VOCABULARY_FILES.items():
            types = CONCEPT_COLUMNS if name == "concept" else RELATIONSHIP_COLUMNS
            read_vocabulary_tsv(spark, f"{folder.rstrip('/')}/{file}", types).write.mode("overwrite").parquet(written[name])
    return written
