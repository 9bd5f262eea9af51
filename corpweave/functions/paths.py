"""Folder conventions of ingestion runs, derived from path columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names used in run folders.
METADATA_FILE = "metadata.json"
ERRORS_FOLDER = "errors"


def run_folder(error_path: Column) -> Column:
    """``…/run/errors/chunk.parquet`` → ``…/run``."""
    tail = F.substring_index(error_path, "/", -2)
    return F.left(error_path, F.length(error_path) - F.length(tail) - 1)


def parent_metadata_path(error_path: Column) -> Column:
    """The manifest of the run an error file belongs to."""
    return F.concat(run_folder(error_path), F.lit("/" + METADATA_FILE))


def error_path(archived_folder: Column, chunk_path: Column) -> Column:
    """Where the rejected rows of a chunk go."""
    return F.concat(archived_folder, F.lit(f"/{ERRORS_FOLDER}/"), F.substring_index(chunk_path, "/", -1))


def processed_path(chunk_path: Column) -> Column:
    """Where the accepted rows of a chunk go: the file name gets a ``_processed`` suffix."""
    return F.regexp_replace(chunk_path, r"\.([A-Za-z0-9]+)$", r"_processed.$1")


def is_error_file(path: Column) -> Column:
    return F.lower(path).rlike(r"/errors/[^/]+\.parquet$")


def table_root(path: Column, marker: str = "_version=") -> Column:
    """Folder of the keyed table a data file belongs to."""
    return F.regexp_extract(path, "^(.*?)/" + marker, 1)
