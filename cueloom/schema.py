"""Row shapes: a transcript is a table of segments, each with its timed words."""

from pyspark.sql import types as T

WORD = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SEGMENT = T.StructType(
    [
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("words", T.ArrayType(WORD)),
    ]
)
TRANSCRIPT = T.StructType([T.StructField("segments", T.ArrayType(SEGMENT))])
SEGMENTS = T.StructType([T.StructField("transcript_id", T.LongType()), T.StructField("seg_idx", T.LongType()), *SEGMENT.fields])
UPDATES = T.StructType(
    [T.StructField("transcript_id", T.LongType()), T.StructField("ord", T.LongType()), T.StructField("idx", T.LongType()), T.StructField("text", T.StringType())]
)
EVENTS = "key string, status string, error_type string, error string, bus string, source string, detail_type string, detail string, run string"
WORDS_SQL = "array<struct<word:string,start:double,end:double,speaker:string,score:double>>"
# Step names and states of timing records.
STEPS = (
    "download_s3",
    "validate_audio",
    "convert_to_wav",
    "load_whisper_model",
    "load_audio",
    "transcription",
    "load_align_model",
    "alignment",
    "load_diarize_model",
    "diarization",
    "caption_conversion",
    "upload_raw_transcript",
    "upload_clean_captions",
)
STATUSES = ("success", "error", "skipped")
