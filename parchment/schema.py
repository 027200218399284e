"""Declared schemas; they are closed, and every writer emits every column in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOCUMENTS = (
    "id string, partition string, url string, term int, date string, docket string, title string, entries string, listed boolean, media_type string, file binary, file_sha256 string, file_size bigint, "
    "etag string, last_modified string, pages int, image_pages int, ocr_pages int, text_source string, text string, ocr_text string, extractor string, xcheck_extractor string, xcheck_equal boolean, "
    "xcheck_equal_nfkd boolean, xcheck_delta bigint, metadata string, first_seen_at string, fetched_at string, checked_at string, delisted_at string"
)
_CASES = (
    "term int, docket string, case_name string, case_name_source string, sources string, docket_url string, docket_format string, docket_found boolean, docket_fetched_at string, docket_etag string, "
    "docket_last_modified string, docket_html binary, docket_text string, docketed_date string, linked_with string, lower_court string, lower_court_case_numbers string, lower_court_decision_date string, "
    "questions_presented_url string, proceedings string, attorneys string, opinions string, transcripts string, audio string, source_rows string"
)
_KINDS = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "boolean": T.BooleanType, "binary": T.BinaryType}


def _struct(ddl: str) -> T.StructType:
    """A flat schema, without a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]()) for name, kind in (x.split() for x in ddl.split(", "))])


DOCUMENTS, CASES = _struct(_DOCUMENTS), _struct(_CASES)
#: text is only born-digital or HTML text, ocr_text only recognized text.
TEXT_SOURCES, OCR_SOURCES = ("born_digital", "html"), ("scanned", "mixed")
ALL_SOURCES = (*TEXT_SOURCES, *OCR_SOURCES, "no_text")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns, cast; columns it lacks are null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def differences(have: T.StructType, want: T.StructType) -> list[str]:
    """How a schema differs, by name, type and order; nullability doesn't count."""
    mine, theirs = {f.name: f.dataType.simpleString() for f in have}, {f.name: f.dataType.simpleString() for f in want}
    out = [f"has no column {n}" for n in theirs if n not in mine] + [f"has a column {n} the schema does not have" for n in mine if n not in theirs]
    out += [f"has {n} as {mine[n]}, the schema says {theirs[n]}" for n in theirs if n in mine and mine[n] != theirs[n]]
    return out if out or list(mine) == list(theirs) else ["has the schema's columns in another order"]
