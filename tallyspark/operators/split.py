"""Several values packed in one field (problem 4): one row per value, with its position.

Quoted spans and protected names are replaced by indexed placeholders, the rest is split at the delimiters, the spans
are put back by array lookup, and the parts are exploded with their positions. All of it is built-in expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions.text import let

#: Delimit a placeholder's index; where a text holds them itself, they are protected as spans of their own.
OPEN, CLOSE = "\ue000", "\ue001"
DOUBLE = r'"(?:""|\\.|[^"\\])*+"'
SINGLE = r"(?<![^\s,;|/\[\](){}\-])'(?:''|\\.|[^'\\])*?'(?=\s*(?:[,;|/\])}\r\n\t]|$|and\s|\(?\d{1,3}\)\s))"
#: A list mark: a number in or before a parenthesis, or a bullet at the start of a line.
MARK = r"(?:(?:^|(?<=\s))\(?\d{1,3}\)(?=\s)|(?:^|(?<=[\r\n]))[ \t]*[-*\u2022](?=\s))"
DELIMITER = rf"(?:[,;|/\r\n\t]|{MARK}|(?<=\s)and(?=\s)|(?<=\s)AND(?=\s))"
#: White space of any kind.
SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Names longer in number than this are not put into one pattern but several, tried one after the other.
NAMES_PER_PATTERN = 500


def span_patterns(names: Sequence[str]) -> list[str]:
    """Patterns of what must not be split: quoted spans, and those names that hold a delimiter or a quote (any case)."""
    risky = sorted({n.strip() for n in names if n and re.search(r"""[,;|/\r\n\t"']|\sand\s|\d\)""", n, re.I)}, key=lambda n: (-len(n), n))
    quoted = ["(?i:" + r"\s+".join(map(_quote, n.split())) + ")" for n in risky]
    chunks = [quoted[i : i + NAMES_PER_PATTERN] for i in range(0, len(quoted), NAMES_PER_PATTERN)] or [[]]
    return [rf"[{OPEN}{CLOSE}]|{DOUBLE}|{SINGLE}" + "".join("|" + q for q in chunks[0])] + ["|".join(c) for c in chunks[1:]]


def _quote(s: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", s)


def split_packed(text: Column, names: Sequence[str] = ()) -> Column:
    """array<string> of the values packed in text, trimmed, without enclosing quotes, brackets, list marks and escapes; empty values left out.

    Null and blank give an empty array. names: values known to hold delimiters (a list of proven, small size).
    """

    def masked(rest: list[tuple[int, str]], x: Column, layers: list[Column]) -> Column:
        """x with the spans of the remaining patterns replaced, split and put back."""
        if not rest:
            return let(_body(x), lambda body: parts(body, layers))
        (k, pattern), later = rest[0], rest[1:]
        spans = F.regexp_extract_all(x, F.lit(pattern), F.lit(0))

        def replaced(own: Column) -> Column:
            between = F.transform(F.split(x, pattern, -1), _marker(k, F.size(own)))
            return let(F.when(F.size(own) == 0, x).otherwise(F.array_join(between, "")), lambda y: masked(later, y, [*layers, own]))

        return let(spans, replaced)

    def parts(body: Column, layers: list[Column]) -> Column:
        out = F.filter(F.transform(F.split(body, DELIMITER, -1), _trim), lambda p: (p != "") & (F.lower(p) != "and"))
        for k, own in reversed(list(enumerate(layers))):
            out = F.transform(out, _restorer(k, own))
        return F.filter(F.transform(out, _trim), lambda p: p != "")

    return let(_trim(F.coalesce(text, F.lit(""))), lambda x: masked(list(enumerate(span_patterns(names))), x, []))


def _body(x: Column) -> Column:
    """x without brackets around the whole."""
    return F.when(F.substring(x, 1, 1).isin("[", "{", "("), F.regexp_replace(x, r"^[\[{(](?!\d{1,3}\)\s)((?s:.*))[\]})]$", "$1")).otherwise(x)


def _marker(k: int, n: Column) -> Callable[[Column, Column], Column]:
    return lambda x, i: F.when(i < n, F.concat(x, F.lit(OPEN), i.cast("string"), F.lit(f".{k}{CLOSE}"))).otherwise(x)


def _restorer(k: int, spans: Column) -> Callable[[Column], Column]:
    return lambda x: F.when(x.contains(OPEN), _restore(x, spans, k)).otherwise(x)


def _trim(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACE))


def _restore(x: Column, spans: Column, k: int) -> Column:
    """x with its placeholders of layer k replaced by their spans; a part that is one quoted span loses its quotes and escapes."""
    pattern = f"{OPEN}(\\d+)\\.{k}{CLOSE}"
    indexes = F.regexp_extract_all(x, F.lit(pattern), F.lit(1))
    between = F.split(x, pattern, -1)
    span = lambda i: F.get(spans, F.get(indexes, i).cast("int"))
    whole = F.array_join(F.transform(between, lambda s, i: F.when(i < F.size(indexes), F.concat(s, span(i))).otherwise(s)), "")
    only = span(F.lit(0))
    inner = F.substring(only, F.lit(2), F.length(only) - 2)
    bare = F.when(only.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).when(only.startswith("'"), F.replace(inner, F.lit("''"), F.lit("'")))
    bare = F.regexp_replace(bare, r"\\(.)", "$1")
    return F.when((F.size(indexes) == 1) & x.rlike(f"^{pattern}$") & bare.isNotNull(), bare).when(F.size(indexes) > 0, whole).otherwise(x)


def explode_packed(df: DataFrame, id_col: str, text_col: str, names: Sequence[str] = ()) -> DataFrame:
    """Rows (id, pos from 1, part_text), one per value packed in text_col; rows without a value give none. Other columns are not read."""
    parts = df.select(F.col(id_col).alias("id"), split_packed(F.col(text_col), names).alias("parts"))
    return parts.select("id", F.posexplode("parts").alias("p", "part_text")).select("id", (F.col("p") + 1).alias("pos"), "part_text")
