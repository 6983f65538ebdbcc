"""The column functions as SQL: scalar functions and a table function for a session."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .alignment import edit_script


class DiffWords:
    """Rows (op, original_index, patched_index, word) of the edit script of two texts."""

    def eval(self, a: str, b: str):
        yield from edit_script((a or "").split(), (b or "").split())


#: SQL functions without Python: name, parameters, type, body.
SCALARS = (
    ("vtt_timestamp", "s DOUBLE", "STRING", "format_string('%02d:%02d:%02d.%03d', floor(s / 3600), floor((s % 3600) / 60), floor(s % 60), floor((s - floor(s)) * 1000 + 0.5))"),
    ("srt_timestamp", "s DOUBLE", "STRING", "format_string('%02d:%02d:%02d,%03d', floor(s / 3600), floor((s % 3600) / 60), floor(s % 60), floor((s - floor(s)) * 1000 + 0.5))"),
    ("escape_html", "t STRING", "STRING", "replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"),
    ("norm_edit_distance", "a STRING, b STRING", "DOUBLE", "CASE WHEN a = b THEN 0D WHEN length(a) = 0 OR length(b) = 0 THEN 1D ELSE levenshtein(a, b) / greatest(length(a), length(b)) END"),
    ("word_timing_valid", "s DOUBLE, e DOUBLE", "BOOLEAN", "coalesce(s >= 0 AND e > s, false)"),
    ("segment_timing_valid", "s DOUBLE, e DOUBLE", "BOOLEAN", "coalesce(e > 0 AND e > s, false)"),
)


def register(spark: SparkSession) -> None:
    """Make the functions known to spark.sql in this session."""
    for name, parameters, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    udtf = F.udtf(DiffWords, returnType="op: string, original_index: int, patched_index: int, word: string")
    spark.udtf.register("diff_words", udtf)
