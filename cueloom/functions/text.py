"""Text columns: words, escaping, tags, rules, keys. All are built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rule
from .script_regex import Pattern, replacement

# The white-space characters of ECMAScript's \s.
SPACE = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
DEFAULT_SPEAKER = "SPEAKER_00"
TAGS = {"underline": "u", "bold": "b", "italic": "i"}


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_to_words(text: Column | str) -> Column:
    """Words between runs of white space; none for null."""
    return F.filter(F.split(F.coalesce(col(text), F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def trim(text: Column | str) -> Column:
    return F.regexp_replace(col(text), f"^[{SPACE}]+|[{SPACE}]+$", "")


def join_words(words: Column | str) -> Column:
    return trim(F.array_join(col(words), " "))


def words_text(words: Column | str = "words", text: Column | str = "text") -> Column:
    """A segment's text from its words, or its own text where it has none."""
    w = col(words)
    return F.when(F.size(w) > 0, F.array_join(F.transform(w, lambda x: x["word"]), " ")).otherwise(F.coalesce(col(text), F.lit("")))


def escape_html(text: Column | str) -> Column:
    """& < > as entities; quotes stay."""
    out = col(text)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def highlight(text: Column | str, how: str = "underline") -> Column:
    tag = TAGS.get(how, "u")
    return F.concat(F.lit(f"<{tag}>"), col(text), F.lit(f"</{tag}>"))


def effective_speaker(speaker: Column | str = "speaker", words: Column | str = "words") -> Column:
    """The segment's speaker, else its first word's, else the default; an empty name is none."""
    return F.coalesce(F.nullif(col(speaker), F.lit("")), F.nullif(F.get(col(words), F.lit(0))["speaker"], F.lit("")), F.lit(DEFAULT_SPEAKER))


def labelled_line(seg_idx: Column | str, speaker: Column | str, text: Column | str) -> Column:
    """``[index] [speaker] text``: the line a language model gets."""
    return F.format_string("[%d] [%s] %s", col(seg_idx), F.coalesce(col(speaker), F.lit(DEFAULT_SPEAKER)), col(text))


def speaker_prefix(speaker: Column | str, previous: Column | str, mode: str = "when-changes") -> Column:
    """``name: `` always, never, or where the speaker is not the one before. The name is not escaped."""
    named = F.concat(col(speaker), F.lit(": "))
    if mode == "never":
        return F.lit("")
    return named if mode == "always" else F.when(col(speaker).eqNullSafe(col(previous)), F.lit("")).otherwise(named)


def rule_key(rule: Rule) -> str:
    return f"r'{rule.search}'->{rule.replacement}" if rule.type == "regex" else f"{rule.search}->{rule.replacement}"


def literal_replacement(search: str, replacement: str) -> str:
    """What a literal rule puts in place of each match: $$ and $& are special there too."""
    return re.sub(r"\$\$|\$&", lambda m: "$" if m[0] == "$$" else search, replacement)


def count_matches(text: Column | str, rule: Rule) -> Column:
    if rule.type == "regex":
        return F.regexp_count(col(text), F.lit(Pattern(rule.search).java))
    t = col(text)
    return ((F.length(t) - F.length(F.replace(t, F.lit(rule.search), F.lit("")))) / len(rule.search)).cast("int")


def replace_all(text: Column | str, rule: Rule) -> Column:
    if rule.type == "regex":
        return F.regexp_replace(col(text), *replacement(rule.replacement, Pattern(rule.search)))
    return F.replace(col(text), F.lit(rule.search), F.lit(literal_replacement(rule.search, rule.replacement)))


def output_base(key: Column | str) -> Column:
    """Object key without the leading ``input/`` and the last extension; sub-folders stay."""
    return F.regexp_replace(F.regexp_replace(col(key), "^input/", ""), r"\.[^.]+$", "")


def worker_base(key: Column | str) -> Column:
    """The worker's form: file name alone, without the last extension."""
    name = F.regexp_extract(col(key), "([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def decoded_key(key: Column | str) -> Column:
    return F.url_decode(col(key))


def region_of(profile: Column | str, fallback: str = "us-east-1") -> Column:
    """The region that a profile id's prefix stands for."""
    p = col(profile)
    out = F.when(p.startswith("eu."), F.lit("eu-west-1")).when(p.startswith("us."), F.lit("us-east-1"))
    return out.when(p.startswith("apac."), F.lit("ap-northeast-1")).when(p.startswith("global."), F.lit("us-east-1")).otherwise(F.lit(fallback))


def model_of(profile: Column | str) -> Column:
    return F.regexp_replace(col(profile), r"^(eu|us|apac|global)\.", "")


def bracketed_json(text: Column | str) -> Column:
    """From the first opening brace to the last closing one; empty where there is none."""
    return F.regexp_extract(col(text), r"(?s)\{.*\}", 0)


def fill_template(template: str, transcript: Column | str, context: str | None = None) -> Column:
    """A prompt with {{transcript}} and {{additionalContext}} filled in literally."""
    out = F.replace(F.lit(template), F.lit("{{additionalContext}}"), F.lit(context or ""))
    return F.replace(out, F.lit("{{transcript}}"), col(transcript))


def byte_size(n: Column | str) -> Column:
    """A number of bytes with binary units and one decimal."""
    v = col(n).cast("double")
    out = None
    for i, unit in enumerate(["", "Ki", "Mi", "Gi", "Ti", "Pi", "Ei", "Zi"]):
        here = F.format_string(f"%.1f{unit}B", F.bround(v / 1024.0**i, 1))  # ties go to the even digit
        out = F.when(F.abs(v) < 1024.0 ** (i + 1), here) if out is None else out.when(F.abs(v) < 1024.0 ** (i + 1), here)
    return out.otherwise(F.format_string("%.1fYiB", v / 1024.0**8))


def utf16_length(text: Column | str) -> Column:
    """Length in UTF-16 units, for parity with engines that count those."""
    return (F.octet_length(F.encode(col(text), "UTF-16BE")) / 2).cast("int")


def json_number(x: Column | str) -> Column:
    """A double as JSON text without a needless fraction."""
    v = col(x)
    plain = F.regexp_replace(F.regexp_replace(v.cast("decimal(38,16)").cast("string"), "0+$", ""), r"\.$", "")
    return F.when(v.isNull(), F.lit("null")).when(v == F.floor(v), v.cast("decimal(38,0)").cast("string")).when((F.abs(v) >= 1e-3) & (F.abs(v) < 1e7), v.cast("string")).otherwise(plain)


def json_string(x: Column | str) -> Column:
    quoted = F.to_json(F.array(col(x)))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)
