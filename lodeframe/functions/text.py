"""Text expressions. All stay in the JVM; white space classes follow the two conventions of the inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java classes for the white space and line breaks that text normalization recognises (fixed values).
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
PARSER_SPACE = r"[\s\x1C-\x1F\x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
UNICODE_SPACE = r"(?U)\s+"


def unicode_trim(c: Column) -> Column:
    """Without white space at the ends. Each pattern is anchored by possessive runs, so inner white space is passed once."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s++", ""), r"(?U)(?<!\s)\s++$", "")


def words(c: Column) -> Column:
    """Maximal runs without Unicode white space."""
    return F.filter(F.split(c, UNICODE_SPACE), lambda w: w != "")


def plain_words(c: Column) -> Column:
    """Maximal runs without tab, line feed, form feed, return and space, the white space of the queries' SQL."""
    return F.filter(F.split(c, r"[\t\n\f\r ]+"), lambda w: w != "")


def plain_lines(c: Column) -> Column:
    """Lines between the line breaks of ASCII, without spaces of any width at their ends; blank ones stay, as empty."""
    trimmed = lambda x: F.regexp_replace(F.regexp_replace(x, r"\A[\s\p{Zs}]++", ""), r"(?<![\s\p{Zs}])[\s\p{Zs}]++\z", "")
    return F.transform(F.split(c, r"\r\n|[\n\r\x0B\x0C]"), trimmed)


def lower_each(c: Column) -> Column:
    """Lower case, each code point by itself: no final sigma, no dot above beside an i."""
    return F.lower(F.translate(c, "\u0130\u03A3", "i\u03C3"))


def normal_lines(c: Column) -> Column:
    lines = F.transform(F.split(c, LINE_BREAK), lambda x: F.trim(F.regexp_replace(x, PARSER_SPACE, " ")))
    return F.filter(lines, lambda x: x != "")


def normalize_text(c: Column) -> Column:
    """Lines with single spaces and without blank ones, joined by a line feed."""
    return F.array_join(normal_lines(c), "\n")


def title_of(c: Column) -> Column:
    """The first line, without one leading '# '; null if there is none."""
    return F.trim(F.regexp_replace(F.get(normal_lines(c), F.lit(0)), r"^# ", ""))


def token_estimate(c: Column) -> Column:
    return F.when(F.length(c) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(c) / 4))).cast("int")


def preview(c: Column, size: int = 500) -> Column:
    return F.substring(unicode_trim(c), 1, size)


def auto_title(c: Column) -> Column:
    return F.substring(unicode_trim(c), 1, 40)


def file_name(c: Column, most: int = 255) -> Column:
    """The last part of a path with either separator."""
    return F.substring(F.element_at(F.split(F.translate(unicode_trim(c), "\\", "/"), "/"), -1), 1, most)


def truncate_bytes(c: Column, most: int, suffix: str = "") -> Column:
    """At most `most` bytes of UTF-8, cut between characters, with a suffix if cut."""
    cut = F.regexp_replace(F.decode(F.substring(F.encode(c, "UTF-8"), 1, most), "ISO-8859-1"),
                           "(?:[\\xC0-\\xDF]|[\\xE0-\\xEF][\\x80-\\xBF]?|[\\xF0-\\xF7][\\x80-\\xBF]{0,2})$", "")
    return F.when(F.octet_length(c) <= most, c).otherwise(F.concat(F.decode(F.encode(cut, "ISO-8859-1"), "UTF-8"), F.lit(suffix)))


def hash_id(prefix: str, *keys: Column) -> Column:
    """prefix + the first 24 hex digits of SHA-256 over the keys, joined by NUL."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\0", *keys).cast("binary"), 256), 1, 24))


def point_id(c: Column) -> Column:
    """The first 16 bytes of SHA-256 as 8-4-4-4-12."""
    h = F.sha2(c.cast("binary"), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def checksum(c: Column) -> Column:
    """A SHA-256 in lower case, or null if it is none."""
    clean = F.lower(unicode_trim(c))
    return F.when(clean.rlike("^[0-9a-f]{64}$"), clean)


def distinct_trimmed(c: Column) -> Column:
    """Elements trimmed, blanks dropped, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(c, unicode_trim), lambda x: x != ""))


def table_row(c: Column) -> Column:
    """A map as 'key: value' pairs in key order, joined by '; '."""
    pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return F.array_join(pairs, "; ")


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n"), unicode_trim), lambda x: x != "")


def rounded_long(c: Column) -> Column:
    return F.round(c).cast("long")


def share_percent(part: Column, total: Column) -> Column:
    """Percent with one decimal, half away from zero; 0 of nothing."""
    return F.when(total > 0, F.round(part.cast("double") * 1000 / total) / 10).otherwise(0.0)


def latency_ms(start: Column, end: Column) -> Column:
    """Milliseconds, rounded."""
    return rounded_long((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000)


# Labels of intents, and what a message's status means for its block and its run.
INTENT_LABELS = {"knowledge_qa": "知识问答", "general_chat": "一般对话", "report_generation": "报告生成", "data_analysis": "数据分析"}
UNKNOWN_LABEL = "未知"
BLOCK_STATUS = {"queued": "queued", "generating": "streaming", "streaming": "streaming", "failed": "failed", "stopped": "stopped", "cancelled": "cancelled"}
RUN_STATUS = {"generating": "running", "queued": "running", "streaming": "running", "stopped": "cancelled", "cancelled": "cancelled", "failed": "failed"}
NAME_BYTES, TAG_BYTES, QUERY_BYTES, TITLE_CHARS, QUESTION_CHARS = 120, 64, 2000, 200, 32_000


def mapped(c: Column, names: dict[str, str], otherwise: str) -> Column:
    """The value that the fixed table has for c."""
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(otherwise))


def intent_label(c: Column) -> Column:
    return mapped(c, INTENT_LABELS, UNKNOWN_LABEL)


def block_status(message_status: Column) -> Column:
    return mapped(message_status, BLOCK_STATUS, "completed")


def run_status(message_status: Column) -> Column:
    return mapped(message_status, RUN_STATUS, "completed")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def within_bytes(c: Column, most: int, least: int = 0) -> Column:
    """Whether the UTF-8 length is in range; null is not."""
    return F.coalesce(F.octet_length(c).between(least, most), F.lit(False))


def within_chars(c: Column, most: int, least: int = 0) -> Column:
    """Whether the number of code points is in range; null is not."""
    return F.coalesce(F.length(c).between(least, most), F.lit(False))


def json_is_array(c: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("ARRAY"), F.lit(False))


def json_is_object(c: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))


def attempt_id(job: Column, attempt: Column) -> Column:
    return F.concat_ws(":", job.cast("string"), attempt.cast("string"))


def random_id() -> Column:
    """A random identifier; differs from run to run, so it is never part of a comparison."""
    return F.expr("uuid()")


def media_types(c: Column) -> Column:
    """Lower-cased, trimmed, without blanks and repeats, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: F.lower(unicode_trim(x))), lambda x: x != "")))


def citation_columns(document: Column, text: Column, context: Column) -> list[Column]:
    """preview, content (the context, else the text), available, endpoint, reason of a citation."""
    there = F.coalesce(document.cast("string") != "", F.lit(False))
    return [text.alias("preview"), F.coalesce(empty_to_null(context), text).alias("content"), there.alias("available"),
            F.when(there, F.concat(F.lit("/api/v1/documents/"), document.cast("string"), F.lit("/content"))).alias("endpoint"),
            F.when(~there, "source_unavailable").alias("reason")]
