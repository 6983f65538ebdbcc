"""Transcript documents in, caption documents out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import output_base
from ..schema import SEGMENT, SEGMENTS, TRANSCRIPT
from .runs import RunLog


def key_below(spark: SparkSession, path: str) -> Column:
    """For a file source: the file's path below the folder that is read, as a name (not percent-encoded)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/") + "/"
    # a plus sign is no space in a file's path
    whole = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z0-9+.-]+:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    return F.when(whole.startswith(root), F.substr(whole, F.lit(len(root) + 1))).otherwise(F.col("_metadata.file_name"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document in the folder and those below: key (the path below it), output_base, extra (the whole text), segments. A malformed or empty one fails the read."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return parse_transcripts(raw.select(key_below(spark, path).alias("key"), F.col("value").alias("extra")))


def parse_transcripts(raw: DataFrame) -> DataFrame:
    strict = F.from_json("extra", TRANSCRIPT, {"mode": "FAILFAST"})
    body = F.when(F.col("extra").rlike(r"^\s*$"), F.raise_error(F.concat(F.lit("empty document: "), "key"))).otherwise(F.col("extra"))
    return raw.withColumn("extra", body).select("key", output_base("key").alias("output_base"), "extra", strict["segments"].alias("segments"))


def set_aside(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transcripts, failed) of documents (key, extra): one that is no JSON or has no segments costs only itself."""
    made = raw.withColumn("segments", F.from_json("extra", TRANSCRIPT)["segments"])
    good = F.try_parse_json("extra").isNotNull() & F.col("segments").isNotNull()
    transcripts = made.where(good).select("key", output_base("key").alias("output_base"), "extra", "segments")
    return transcripts, made.where(~F.coalesce(good, F.lit(False))).select("key", "extra")


def to_segments(transcripts: DataFrame) -> DataFrame:
    """Transcripts as segment rows, keyed by a hash of their key; place in the list becomes seg_idx."""
    each = transcripts.select(F.xxhash64("key").alias("transcript_id"), F.posexplode("segments").alias("seg_idx", "s"))
    return each.select("transcript_id", F.col("seg_idx").cast("long").alias("seg_idx"), "s.*")


def to_transcripts(segments: DataFrame) -> DataFrame:
    """Segment rows back as one JSON text a transcript."""
    fields = [f.name for f in SEGMENT.fields]
    rows = segments.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", F.struct(*fields).alias("s")))).alias("x"))
    return rows.select("transcript_id", F.to_json(F.struct(F.transform("x", lambda r: r["s"]).alias("segments"))).alias("json"))


def refined_documents(transcripts: DataFrame, segments: DataFrame, same_segments: bool = False) -> DataFrame:
    """(transcript_id, document): each transcript (transcript_id, extra) as the JSON it came as, with these segments in place of its own.

    All other fields stay as they were, whatever they hold. With same_segments, where segments were not cut
    anew, fields of a segment that are not known here stay too.
    """
    fields = [f.name for f in SEGMENT.fields]
    own = segments.select("transcript_id", "seg_idx", F.parse_json(F.to_json(F.struct(*fields))).alias("s"))
    if same_segments:
        known = F.array(*(F.lit(f) for f in fields))
        came = transcripts.select("transcript_id", F.posexplode(F.try_variant_get(F.parse_json("extra"), "$.segments", "array<map<string,variant>>")).alias("seg_idx", "m"))
        came = came.select("transcript_id", F.col("seg_idx").cast("long").alias("seg_idx"), F.map_filter("m", lambda k, v: ~F.array_contains(known, k)).alias("m"))
        own = own.join(came, ["transcript_id", "seg_idx"], "left")
        both = F.map_concat(F.try_variant_get("s", "$", "map<string,variant>"), F.coalesce("m", F.create_map().cast("map<string,variant>")))
        own = own.select("transcript_id", "seg_idx", F.parse_json(F.to_json(both)).alias("s"))
    # variants have no order: they travel as text
    rows = own.select("transcript_id", F.struct("seg_idx", F.to_json("s").alias("s")).alias("x")).groupBy("transcript_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: r["s"]), ","), F.lit("]"))
    others = F.map_filter(F.try_variant_get(F.parse_json("extra"), "$", "map<string,variant>"), lambda k, v: k != "segments")
    made = transcripts.join(rows, "transcript_id", "left").select("transcript_id", others.alias("m"), F.parse_json(F.coalesce(listed, F.lit("[]"))).alias("v"))
    return made.select("transcript_id", F.to_json(F.map_concat("m", F.create_map(F.lit("segments"), F.col("v")))).alias("document"))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def output_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(output_base, transcript_id, key, run, seq) of what finished runs did under a folder; empty before the first one."""
    shape = "output_base string, transcript_id long, key string, run string"
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    there = top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top)
    rows = spark.read.schema(shape).parquet(f"{path}/manifest") if there else spark.createDataFrame([], shape)
    return RunLog(spark, path).whole(rows).select("output_base", "transcript_id", "key", "run", "seq")


def current(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows of a table (segments, stats/...) of the finished run that last wrote each transcript, in the order of the log."""
    last = output_manifest(spark, path).groupBy("transcript_id").agg(F.max_by("run", "seq").alias("run"))
    return spark.read.parquet(f"{path}/{table}").join(last, ["transcript_id", "run"], "left_semi")
