"""License scans by sentence rules, in built-in DataFrame functions only.

Texts are cut into sentences, each sentence is normalised (lower case, one space
for any run of other characters, years as ``<year>``, line breaks kept) and searched for
known licence sentences, each a run of whole lines of it: notices may be wrapped, and may
stand among lines without a full stop. That gives each document a sequence of sentence
identifiers. Ordered rules are then matched against the sequence; the first that fits
wins and takes its sentences away, and matching goes on until no rule fits.

All happens inside one row: nothing is shuffled or joined. Documents without any
of the trigger words that every known sentence contains are settled by one
search. Null and empty texts have no sentences. Repeated sentences count as often
as they occur. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Who or what is licensed: anything up to the verb.
SUBJECT = r"(.* (is|are) )?"
# Sentence identifier, and the normalised sentence as a pattern. A space also stands for a line break, ".*" ends with
# its line, and "[^~]*" goes on over lines.
SENTENCES = (
    ("MitName", SUBJECT + r"(released|licensed|distributed|available) under the (terms of the )?mit licen[cs]e( mit)?( see .*)?"),
    ("MitGrant", r"permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("MitCondition", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("AsIs", r"th(e|is) software is provided( by [^~]*)? as is [^~]*without warranty.*|this software is provided by [^~]* as is and any express or implied warranties.*"),
    ("ApacheName", SUBJECT + r"(released |)licensed under the apache licen[cs]e version ([0-9.]+)( the license)?.*|" + SUBJECT + r"released under the apache licen[cs]e version ([0-9.]+)"),
    ("ApacheCondition", r"you may not use this (file|work) except in compliance with the license"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license.*"),
    ("GplName", SUBJECT + r"(released|licensed|distributed) under (the )?(terms of )?(the )?gnu general public licen[cs]e( version ([0-9.]+))?.*"),
    ("GplGrant", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e( as published by [^~]* version ([0-9.]+) of the licen[cs]e.*)?.*"),
    ("GplAsIs", r"this program is distributed in the hope that it will be useful but without any warranty.*"),
    ("LgplName", r".*gnu lesser general public licen[cs]e.*"),
    ("AgplName", r".*gnu affero general public licen[cs]e.*"),
    ("MplName", r".*mozilla public licen[cs]e.*"),
    ("CcName", SUBJECT + r"(released|licensed|available) under (a |the )?(cc|creative commons) (by( nc)?( sa| nd)?|zero|0|attribution.*)( ([0-9.]+))?( international| unported)?( licen[cs]e)?( see .*)?"),
    ("BsdGrant", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("BsdSource", r".*redistributions of source code must retain the above copyright notice.*"),
    ("BsdBinary", r".*redistributions in binary form must reproduce the above copyright notice.*"),
    ("BsdEndorse", r".*neither the name of [^~]* nor the names of its contributors may be used to endorse.*"),
    ("Reserved", r"(copyright .*\x20)?all rights reserved"),
    ("Copyright", r"(c )?copyright .*(<year>).*"),
)
# Licence, and the identifier sequence as a pattern over "Id;Id;...", most specific first.
RULES = (
    ("BSD-3-Clause", r"BsdGrant;(BsdSource;)(BsdBinary;)(BsdEndorse;)(AsIs;)?"),
    ("BSD-2-Clause", r"BsdGrant;(BsdSource;)(BsdBinary;)(AsIs;)?"),
    ("MIT", r"(MitName;)?MitGrant;(MitCondition;)?(AsIs;)?"),
    ("MIT", r"MitName;(AsIs;)?"),
    ("Apache", r"ApacheName;(ApacheCondition;)?(ApacheAsIs;)?"),
    ("LGPL", r"LgplName;"),
    ("AGPL", r"AgplName;"),
    ("GPL", r"(GplGrant;|GplName;)(GplAsIs;)?"),
    ("MPL", r"MplName;"),
    ("CC", r"CcName;"),
    ("Proprietary", r"(Copyright;)?Reserved;"),
)
# Every known sentence has one of these in it.
TRIGGERS = r"(?i)licen[cs]|permi(ssion|tted)|warrant|redistribut|copyright|all\W+rights|software|endorse|creative\W+commons|under\W+((a|the)\W+)?cc\b"
VERSION = r"(?:licen[cs]e|version|by(?: nc)?(?: sa| nd)?|attribution) (?:version )?([0-9]+(?:\.[0-9]+)*)"


def normalised(sentence: Column) -> Column:
    """Lower case; anything but letters, digits and dots inside numbers is one space, or one line break if it has any; years become <year>."""
    s = F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}.\n]+|\.(?![0-9])|(?<![0-9])\.", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"\b(19|20)[0-9]{2}\b", "<year>"), " *\n[ \n]*", "\n")
    return F.regexp_replace(F.regexp_replace(s, " +", " "), "^[ \n]+|[ \n]+$", "")


def sentences(text: Column) -> Column:
    """Sentences end at a line break followed by another, or at . ! ? ; : before white space or the end. Wrapped lines are one.

    The mark after "free software", at which the GPL's sentence goes on, ends none.
    """
    return F.split(text, r"(?<=[.!?])\s+|(?<=[;:])(?<!(?i:free)\W{1,9}(?i:software)[;:])\s+|\r?\n[ \t]*\r?\n")


def _lines(pattern: str) -> str:
    """The pattern over whole lines of a normalised sentence."""
    return pattern.replace(".*", r"[^\n]*").replace(" ", r"[ \n]")


def known(sentence: Column) -> Column:
    """The known sentences of a normalised sentence, in order; the first in SENTENCES of those that begin at a line."""
    every = "|".join(f"(?:{_lines(p)})" for _, p in SENTENCES)
    return F.regexp_extract_all(sentence, F.lit(rf"(?m)^(?:{every})$"), F.lit(0))


def identifier(sentence: Column) -> Column:
    """The known sentence's identifier, or null."""
    out = F.when(~sentence.rlike(TRIGGERS), F.lit(None))
    for name, pattern in SENTENCES:
        out = out.when(sentence.rlike(rf"\A(?:{_lines(pattern)})\z"), F.lit(name))
    return out


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_known (known sentences), sentence_ids (joined by ;), licenses (joined by ,), version."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    likely = F.coalesce(F.col("text").rlike(TRIGGERS), F.lit(False))
    found = F.filter(
        F.transform(F.flatten(F.transform(F.filter(sentences(F.col("text")), lambda s: s.rlike(TRIGGERS)), lambda s: known(normalised(s)))), _known),
        lambda x: x["id"].isNotNull(),
    )
    nothing = F.array().cast("array<struct<id:string,version:string>>")
    docs = docs.select("doc_id", F.when(likely, found).otherwise(nothing).alias("found"))
    docs = docs.select("doc_id", "found", F.concat_ws("", F.transform("found", lambda x: F.concat(x["id"], F.lit(";")))).alias("ids"))
    # each rule takes its sentences away, so that a sentence is evidence once
    rest, hits = F.col("ids"), []
    steps = {"r0": rest}
    docs = docs.withColumns(steps)
    for i, (name, pattern) in enumerate(RULES):
        whole = f"(?:(?<=;)|^){pattern}"
        docs = docs.withColumn(f"h{i}", F.when(F.col(f"r{i}").rlike(whole), F.lit(name))).withColumn(f"r{i + 1}", F.regexp_replace(f"r{i}", whole, ""))
        hits.append(F.col(f"h{i}"))
    licenses = F.array_distinct(F.array_compact(F.array(*hits)))
    versions = F.array_distinct(F.filter(F.transform("found", lambda x: x["version"]), lambda v: v != ""))
    return docs.select(
        "doc_id",
        F.size("found").cast("long").alias("n_known"),
        F.regexp_replace("ids", ";$", "").alias("sentence_ids"),
        F.array_join(licenses, ",").alias("licenses"),
        F.array_join(versions, ",").alias("versions"),
    )


def _known(sentence: Column) -> Column:
    return F.struct(identifier(sentence).alias("id"), F.regexp_extract(F.translate(sentence, "\n", " "), VERSION, 1).alias("version"))
