"""String, date, binary and line functions used by the labs' shell pipelines.

All are compositions of built-in expressions, so they stay inside
whole-stage codegen and process whole texts (no prefixes, no Python).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def regex_match(col: Column, pattern: str) -> Column:
    """grep -E: does the text match the (Java) regular expression?"""
    return col.rlike(pattern)


def zone_to_region(zone: Column) -> Column:
    """${ZONE%-*}: drop the last '-' segment (us-east1-b -> us-east1)."""
    return F.regexp_replace(zone, r"-[^-]*\z", "")


def nth_field(col: Column, sep: str, n: int) -> Column:
    """cut -d<sep> -f<n> (1-based; '' when there are fewer fields)."""
    return F.split_part(col, F.lit(sep), F.lit(n))


def nth_word(col: Column, n: int) -> Column:
    """awk '{print $n}': whitespace-separated field n, '' when absent."""
    words = F.split(F.regexp_replace(col, r"^\s+|\s+$", ""), r"\s+")
    return F.coalesce(F.try_element_at(words, F.lit(n)), F.lit(""))


def default_if_empty(col: Column, default: str) -> Column:
    """${VAR:-default}: the default when the value is NULL or empty."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def timestamp_key(ts: Column) -> Column:
    """date "+%Y%m%d-%H%M%S"."""
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def base64_key(seed: Column) -> Column:
    """A 32-byte key as trimmed base64; bytes derived from the seed by SHA-256."""
    return F.trim(F.base64(F.unhex(F.sha2(seed.cast("string"), 256))))


def replace_at_start(col: Column, prefix: str, replacement: str) -> Column:
    """sed 's/^prefix/replacement/'."""
    return F.regexp_replace(col, "^" + re.escape(prefix), _lit_repl(replacement))


def replace_at_end(col: Column, suffix: str, replacement: str) -> Column:
    """sed 's/suffix$/replacement/' on one line (a final carriage return is part of it)."""
    return F.regexp_replace(col, re.escape(suffix) + r"\z", _lit_repl(replacement))


def replace_rest(col: Column, prefix: str, replacement: str) -> Column:
    """sed 's/prefix.*/replacement/' — greedy to the end of the line."""
    return F.regexp_replace(col, re.escape(prefix) + r"[^\n]*", _lit_repl(replacement))


def _lit_repl(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def byte_size(col: Column) -> Column:
    """Size in bytes of the UTF-8 text."""
    return F.octet_length(col)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def first_line(text: Column) -> Column:
    """head -n 1."""
    return F.substring_index(text, "\n", 1)


def drop_last_lines(text: Column, n: int) -> Column:
    """head -n -N: all but the last N lines."""
    ls = lines(text)
    return F.array_join(F.slice(ls, 1, F.greatest(F.size(ls) - n, F.lit(0))), "\n")


def last_line_rows(df, text: str, n: int, *keep: str):
    """tail -N as rows (kept columns, line_no 1-based, line): the lines are cut before they are
    exploded, so only the rows asked for are made."""
    counted = df.select(*keep, lines(F.col(text)).alias("__lines"))
    first = F.greatest(F.size("__lines") - n, F.lit(0))
    return (counted.select(*keep, first.alias("__first"),
                           F.posexplode(F.slice("__lines", first + 1, F.lit(n))).alias("__pos", "line"))
            .select(*keep, (F.col("__first") + F.col("__pos") + 1).cast("bigint").alias("line_no"), "line"))


def last_lines(text: Column, n: int) -> Column:
    """tail -N as one text."""
    ls = lines(text)
    k = F.least(F.size(ls), F.lit(n))
    return F.array_join(F.slice(ls, -k, k), "\n")
