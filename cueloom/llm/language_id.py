"""Language identification by compression.

Each language has a raw-content zstandard dictionary: text of a bounded sample of
its labelled rows. A text is encoded, in pieces, once with every dictionary; the
language whose dictionary gives the fewest bytes wins. Where the saving over the
runner-up is a smaller share than ``margin`` of the bytes, the text is rejected:
``accepted`` is false.

The sample is the only bounded part: ``sample_rows`` distinct texts a language, those of the
smallest hash, ``sample_chars`` characters of each spread over its length, at most
``dictionary_bytes`` bytes a language, at most ``most_languages`` languages.
Predictions read whole texts.

Whole bytes do not tell short texts apart. Where the fewest bytes are alike and the
text is so short that one byte is more than the margin, the tied languages are measured
in bits, under character trigrams of the same dictionaries; a saving under one bit is none.

Null text, or one without a letter, is ``und`` with score 0 and not accepted.
Ties that are left go to the language first in order of name. Null ``lang`` is never learned
from. Without any labelled row all is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import fresh, tidy

PIECE = 1 << 12
MARGIN = 0.002
SHORT = int(1 / MARGIN)
_LETTER = re.compile(r"[^\W\d_]")


def learn(
    docs: DataFrame,
    where: Column,
    sample_rows: int = 200,
    sample_chars: int = 600,
    dictionary_bytes: int = 64 << 10,
    most_languages: int = 256,
) -> dict[str, bytes]:
    """Dictionary text by language, from the rows that the condition picks."""
    rows = docs.where(where).where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    step = F.greatest(F.lit(1), (F.length("text") - sample_chars / 3).cast("int") / 2).cast("int")
    third = sample_chars // 3
    some = F.concat_ws(" ", *(F.substring("text", 1 + i * step, F.lit(third)) for i in range(3)))
    languages = rows.select("lang").distinct().limit(most_languages + 1).collect()
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages")
    rows = rows.select("lang", F.xxhash64("text").alias("h"), F.when(F.length("text") <= sample_chars, F.col("text")).otherwise(some).alias("part"))
    # copies count once, whatever their number; they are combined before they travel
    rows = rows.groupBy("lang", "h").agg(F.min("part").alias("part"))
    # each task keeps its own smallest hashes first, so that no task reads all rows of a language
    near = Window.partitionBy("lang", "s").orderBy("h", "part")
    far = Window.partitionBy("lang").orderBy("h", "part")
    rows = rows.withColumn("s", F.pmod("h", F.lit(64))).withColumn("r", F.row_number().over(near)).where(F.col("r") <= sample_rows)
    rows = rows.withColumn("r", F.row_number().over(far)).where(F.col("r") <= sample_rows)
    got: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "r").select("lang", "part").collect():
        got.setdefault(r["lang"], []).append(r["part"])
    return {lang: "\n".join(dict.fromkeys(parts)).encode()[:dictionary_bytes] for lang, parts in got.items()}


class Bits:
    """Code length of short texts under the character trigrams of a dictionary, backed off to bigrams and single bytes."""

    def __init__(self, dictionary: bytes):
        a, b, c = self._codes(dictionary)
        self.one = np.bincount(c, minlength=1 << 8)
        self.two = np.bincount(b << 8 | c, minlength=1 << 16)
        self.three, self.n = np.unique(a << 16 | b << 8 | c, return_counts=True)

    @staticmethod
    def _codes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.frombuffer(b"  " + data + b" ", np.uint8).astype(np.int64)
        return x[:-2], x[1:-1], x[2:]

    def __call__(self, data: bytes) -> float:
        a, b, c = self._codes(data)
        key = a << 16 | b << 8 | c
        at = np.minimum(np.searchsorted(self.three, key), len(self.three) - 1)
        seen = np.where(self.three[at] == key, self.n[at], 0)
        p = (self.one[c] + 1) / (self.one.sum() + 256)
        p = (self.two[b << 8 | c] + 8 * p) / (self.one[b] + 8)
        p = (seen + 8 * p) / (self.two[a << 8 | b] + 8)
        return float(-np.log2(p).sum())


class Classifier:
    """Per-language compressors; built once in each worker."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6):
        import zstandard

        self.languages = sorted(dictionaries)
        self.bits = [Bits(dictionaries[lang]) for lang in self.languages]
        self.encoders = []
        for lang in self.languages:  # each at its own size: a rare language does not shorten the others
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level)
            self.encoders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False).compress)

    def sizes(self, text: str) -> list[int]:
        data = text.encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(encode(x)) for x in pieces) for encode in self.encoders]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the winner's saving over the runner-up, as a share of the runner-up's bytes, or bits in short ties (1: no other language)."""
        if text is None or not self.encoders or not _LETTER.search(text):
            return "und", 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        tied = [i for i, s in enumerate(sizes) if s == sizes[best]]
        data = text.encode()
        if len(tied) > 1 and len(data) < SHORT:
            (least, best), (rest, _) = sorted((self.bits[i](data), i) for i in tied)[:2]
            return self.languages[best], (rest - least) / rest if rest - least >= 1 else 0.0
        rest = min((s for i, s in enumerate(sizes) if i != best), default=None)
        return self.languages[best], 1.0 if rest is None else (rest - sizes[best]) / rest


def _predictions(docs: DataFrame, dictionaries: dict[str, bytes], margin: float) -> tuple[DataFrame, Column]:
    """docs with one more column, whose name clashes with none, and that column: struct(lang_pred, score, accepted)."""
    model: list[Classifier] = []

    def predict(batches):
        for texts in batches:
            if not model:
                model.append(Classifier(dictionaries))
            got = [model[0].predict(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in got], pa.string()), pa.array([y for _, y in got], pa.float64())], ["lang_pred", "score"]
            )

    work = tidy(predict, model)
    work.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    call = F.arrow_udf(work, "lang_pred string, score double")
    (name,) = fresh(docs.columns, "prediction")
    docs = docs.withColumn(name, call(F.col("text").cast("string")))
    accepted = (F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= margin)
    return docs.withColumn(name, F.col(name).withField("accepted", accepted)), F.col(name)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred, score and accepted appended; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score", "accepted")
    made, prediction = _predictions(docs, dictionaries, margin)
    return made.select(*docs.columns, *(prediction[x].alias(x) for x in ("lang_pred", "score", "accepted")))


def keep_identified(docs: DataFrame, train: Column | None = None, margin: float = MARGIN) -> DataFrame:
    """The rows whose language is identified, with the columns of docs, whatever their names."""
    dictionaries = learn(docs, F.lit(True) if train is None else train)
    made, prediction = _predictions(docs, dictionaries, margin)
    return made.where(prediction["accepted"]).select(*docs.columns)
